"""The substring-key join against a brute-force reading of LIKE."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_text
from postlens.operators import link_pairs, matching

KEYS = ["A_1", "AX1", "e%l/A", "p_/", "_", "%", "__", "%%", "reel", "abcdefghijklmnopqrstuvwxyz0123456789", "ww", "w",
        "nothing", r"a\_b", "é", "www.instagram.com", r"x\y", "end\\"]
LINKS = ["https://www.instagram.com/reel/A_1/", "https://www.instagram.com/p/AX1/", "https://x/a_b", "https://x/aXb", "", "w",
         "wwww", None, "https://x/abcdefghijklmnopqrstuvwxyz0123456789", "café", "xy", "end%", "https://www.instagram.com/reel/A_1/"]


def like(link: str, key: str) -> bool:
    pattern, text, i = "", f"%{key}%", 0
    while i < len(text):
        if text[i] == "\\" and i + 1 < len(text):
            i += 1
            pattern += re.escape(text[i])
        else:
            pattern += {"%": ".*", "_": "."}.get(text[i], re.escape(text[i]))
        i += 1
    return re.fullmatch(pattern, link, re.S) is not None


def expected(links, keys):
    return sorted((k, f"p{i}") for i, l in enumerate(links) if l is not None for k in set(keys) if like(l, k))


def matched(spark, links, keys, **options):
    posts = spark.createDataFrame([(f"p{i}", l) for i, l in enumerate(links)], "post_id string, source_link string")
    key_table = spark.createDataFrame([(k,) for k in sorted(set(keys))], "key string")
    return link_pairs(posts, key_table, **options)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_same_pairs_as_like(spark, broadcast_bytes):
    got = matched(spark, LINKS, KEYS, broadcast_bytes=broadcast_bytes)
    assert sorted(map(tuple, got.collect())) == expected(LINKS, KEYS)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("ab_%/", max_size=12), min_size=1, max_size=8),
    st.lists(st.text("ab_%/\\", min_size=1, max_size=6), min_size=1, max_size=8),
)
def test_random_keys(spark, links, keys):
    assert sorted(map(tuple, matched(spark, links, keys).collect())) == expected(links, keys)


def test_no_keys(spark):
    posts = spark.createDataFrame([("p", "x")], "post_id string, source_link string")
    assert link_pairs(posts, spark.createDataFrame([], "key string")).count() == 0


def test_large_key_tables_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(matching, "COMMON_SHARE", 2)  # no gram counts as common
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(matched(spark, LINKS, KEYS, broadcast_bytes=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # what is broadcast is the filter of fixed size, and no link is dealt with the substrings
    assert "SortMergeJoin" in plan and plan.count("BroadcastExchange") == 1 == plan.count("bitmap_construct_agg") // 2
    dealt = [line for line in plan.splitlines() if "Generate explode" in line and "__hash" in line]
    assert dealt and all("__link" not in line.split("[", 2)[2] for line in dealt)
    plan = plan_text(matched(spark, LINKS, KEYS))
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_hot_link_and_hot_gram(spark):
    """A third of all posts carry one link, and many keys end alike."""
    links = ["https://x/HOTCODE1/"] * 300 + [f"https://x/{i}/" for i in range(600)]
    keys = ["HOTCODE1"] + [f"K{i}CODE1" for i in range(50)]
    for budget in (0, 1 << 20):
        assert matched(spark, links, keys, broadcast_bytes=budget).count() == 300


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_common_endings_and_single_letters(spark, broadcast_bytes):
    """Runs whose last characters stand in all links take others; keys that have no rare gram match all the same."""
    links = [f"https://x.com/{k:05d}/reel/" for k in range(400)]
    keys = [f"{k:05d}/reel/" for k in range(0, 400, 5)] + ["a", "e", "_", "%", "/", "0", "reel", "https", "none/reel/"]
    got = matched(spark, links, keys, broadcast_bytes=broadcast_bytes)
    assert sorted(map(tuple, got.collect())) == expected(links, keys)


def test_the_gram_is_the_rarest_of_the_run(spark):
    links = spark.createDataFrame([(f"p{k}", f"/{k:04d}abcdwxyz") for k in range(3000)], "post_id string, __link string")
    runs = matching._with_run(spark.createDataFrame([("0042abcdwxyz",), ("xyz",)], "key string"))
    grams = {r["key"]: r for r in matching._with_gram(runs, matching._common_grams(links, [2, 8])).collect()}
    assert "0042" in grams["0042abcdwxyz"]["__gram"] and grams["0042abcdwxyz"]["__share"] == 0
    assert grams["xyz"]["__share"] == 1


def test_no_task_holds_a_common_gram(spark):
    """A key of one letter among many keys: its links are dealt out."""
    links = spark.range(40_000).select(F.col("id").alias("__row"), F.format_string("%08x-a", F.col("id") * 2_654_435_761 % 2**32).alias("__link"))
    runs = matching._with_run(spark.range(500).select(F.format_string("%08x", F.col("id") * 2_654_435_761 % 2**32).alias("key")).union(spark.createDataFrame([("a",)], "key string")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = [1, 8]
        grams = matching._with_gram(runs, matching._common_grams(links, sizes))
        pieces = links.select("__row", F.explode(matching._hashes(sizes)).alias("__hash")).join(grams.select("__hash").distinct(), "__hash", "left_semi")
        dealt, probes = matching._in_blocks(pieces, grams)
        tasks = sorted(r["count"] for r in dealt.repartition(16, "__hash", "__block").groupBy(F.spark_partition_id()).count().collect())
        assert tasks[-1] <= 5 * tasks[len(tasks) // 2] and sum(tasks) >= 40_000
        assert probes.where("key = 'a'").count() == 16 and probes.where("key <> 'a'").count() == 500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
