from __future__ import annotations

import math
import zlib
from collections import Counter
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from postlens.llm.sharding import assign_shards, number_slots, shard_documents, write_shards


def bids(key: str, weights: list[float]) -> int:
    found = {}
    for k, w in enumerate(weights):
        u = (int(md5(f"{key}@{k}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        if w:
            found[k] = w / -math.log(u)
    return max(found, key=lambda k: (found[k], -k))


def key_of(value: object) -> str:
    return "-" if value is None else f"{len(str(value))}:{value}"


def test_against_plain_bids(spark):
    weights, grown = [1.0, 2.0, 0.0, 0.5], [1.0, 2.0, 0.0, 0.5, 3.0]
    df = spark.range(500).withColumn("part", F.when(F.col("id") % 7 > 0, F.concat(F.lit("é"), F.col("id") % 3)))
    for r in assign_shards(df, ["part", "id"], weights, grown).collect():
        key = f"{key_of(r['part'])},{key_of(r['id'])}"
        assert (r["__shard"], r["__grown_shard"]) == (bids(key, weights), bids(key, grown))


def test_shares_follow_weights_and_few_rows_move(spark):
    n, weights = 40_000, [1.0, 3.0, 2.0]
    moved = assign_shards(spark.range(n), ["id"], weights, [1.0, 3.0, 2.0, 2.0]).collect()
    count = Counter(r["__shard"] for r in moved)
    for k, w in enumerate(weights):
        assert abs(count[k] / n - w / 6) < 0.01
    assert all(r["__grown_shard"] in (r["__shard"], 3) for r in moved)
    assert abs(sum(r["__grown_shard"] == 3 for r in moved) / n - 0.25) < 0.01
    closed = assign_shards(spark.range(n), ["id"], weights, [1.0, 0.0, 2.0]).collect()
    assert all(r["__grown_shard"] == r["__shard"] for r in closed if r["__shard"] != 1) and not any(r["__grown_shard"] == 1 for r in closed)


@pytest.mark.parametrize("weights", [[], [0.0], [1.0, -1.0], [math.nan], [math.inf]])
def test_weights_must_mean_something(spark, weights):
    with pytest.raises(ValueError):
        assign_shards(spark.range(1), ["id"], weights)


def test_odd_rows(spark):
    rows = [(None, None, 1), (None, "", 2), (None, "", 2), (3, "é" * 200_000, 3), (3, "b", 4), (4, "b", 5)] + [(9, "same", 0)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    found = shard_documents(docs).collect()
    assert len(found) == len(rows)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    slots = {}
    for r in found:
        assert r["law"] == "key" and r["shard"] == bids(key_of(r["doc_id"]), [1.0] * 8) and r["grown_shard"] in (r["shard"], 8)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard_documents(docs.limit(0)).count() == 0
    assert set(shard_documents(docs).columns) == {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}


def test_slots_do_not_depend_on_how_rows_lie(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    assert sorted(shard_documents(docs).collect()) == sorted(shard_documents(docs.repartition(13)).collect())


def test_equal_rows_of_one_shard_are_cut_into_many_ranges(spark):
    rows = spark.range(40_000).select(F.lit(0).alias("shard"), F.lit("same").alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = number_slots(rows, "shard", [F.col("x")])
        assert found.agg(F.min("__slot"), F.max("__slot"), F.countDistinct("__slot")).first() == (0, 39_999, 40_000)
        ranged = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("shard", "x", "row")
        sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * 40_000 / len(sizes) and len(sizes) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_written_shards_hold_every_row_once(spark, tmp_path):
    df = spark.range(1000).withColumn("text", F.lit("x"))
    write_shards(df, str(tmp_path / "out"), ["id"], [1.0, 1.0, 1.0])
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["id"] for r in back.collect()) == list(range(1000))
    assert {r["shard"] for r in back.collect()} == {0, 1, 2}
    with pytest.raises(ValueError):
        write_shards(back, str(tmp_path / "again"), ["id"], [1.0])


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert "Python" not in (plan := shard_documents(docs)._jdf.queryExecution().executedPlan().toString()) and "Pandas" not in plan
