"""Snapshot series and per-post marts."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.catalog import metrics, performance
from checks.fixtures import SETTINGS
from conftest import plan_text
from postlens.operators import keep_latest, with_deltas
from postlens.plans import posts

SF = "/root/testdata/sf0.001"
D = dt.date


def test_keep_latest_breaks_ties_the_same_way_each_time(spark):
    rows = [("p", 1, 5, "a"), ("p", 1, 9, "b"), ("p", 1, 9, "c"), ("q", 1, None, "d"), (None, 1, 1, "e"), (None, 1, 2, "f")]
    schema = "post string, day int, at int, v string"
    picks = {
        tuple(sorted(r["v"] for r in keep_latest(
            spark.createDataFrame(order, schema).repartition(n), ["post", "day"], "at").collect()))
        for order in (rows, rows[::-1]) for n in (1, 3)
    }
    assert len(picks) == 1
    assert picks.pop() in [("b", "d", "f"), ("c", "d", "f")]


def test_deltas_compare_with_the_previous_day_kept(spark, rows):
    df = spark.createDataFrame(
        [("p", D(2024, 1, 1), 10), ("p", D(2024, 1, 4), 15), ("p", D(2024, 1, 5), None), ("p", D(2024, 1, 6), 7)],
        "post string, day date, likes bigint")
    got = with_deltas(df, "post", "day", ["likes"]).select("day", "prev_day", "likes_delta")
    assert rows(got) == [
        (D(2024, 1, 1), None, None), (D(2024, 1, 4), D(2024, 1, 1), 5),
        (D(2024, 1, 5), D(2024, 1, 4), None), (D(2024, 1, 6), D(2024, 1, 5), None)]


def test_one_row_per_post_and_day_and_deltas_add_up(spark):
    series = metrics(spark, SF).cache()
    assert series.count() == series.select("post_id", "ingest_date").distinct().count()
    ends = series.groupBy("post_id").agg(
        F.min_by("likes", "ingest_date").alias("first"), F.max_by("likes", "ingest_date").alias("last"),
        F.sum(F.coalesce("likes_delta", F.lit(0))).alias("gained"))
    assert ends.where(F.col("first") + F.col("gained") != F.col("last")).count() == 0
    assert series.where("is_initial_snapshot").where("likes_delta is not null or days_since_prev is not null").count() == 0


def test_platform_posts_equal_distinct_posts(spark):
    series = metrics(spark, SF).cache()
    keys = ["fact_date", "network", "country", "region", "campaign_tag"]
    exact = series.groupBy(*keys, "username").agg(F.count_distinct("post_id").alias("n")).agg(F.sum("n")).first()[0]
    assert posts.platform_summary(series, SETTINGS).agg(F.sum("posts")).first()[0] == exact


def test_null_delta_counts_the_cumulative_value(spark):
    """A reach that was missing yesterday counts in full today."""
    base = metrics(spark, SF).where("likes is not null").limit(1)
    row = base.withColumns({"reach": F.lit(50).cast("bigint"), "reach_delta": F.lit(None).cast("bigint"),
                            "views": F.lit(70).cast("bigint"), "views_delta": F.lit(3).cast("bigint")})
    got = posts.platform_summary(row, SETTINGS).select("reach_gained", "views_gained").first()
    assert tuple(got) == (50, 3)


def test_performance_schema(spark):
    df = performance(spark, SF)
    assert len(df.columns) == 52 and df.columns == posts.PERFORMANCE_COLUMNS
    assert set(posts.network_slices(df)) == {f"dw_{n}" for n in ["instagram", "facebook", "twitter", "tiktok", "youtube"]}


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = plan_text(metrics(spark, SF))
    lines = [l for l in plan.splitlines() if "WindowGroupLimit" in l or "Exchange hashpartitioning" in l]
    limits = ["Final" if "Final" in l else "Partial" if "Partial" in l else "Exchange" for l in lines]
    # Read from the scan upwards: limit, shuffle by (post, day), limit, shuffle by post.
    assert limits[::-1] == ["Partial", "Exchange", "Final", "Exchange"]


def test_network_filter_reaches_the_scan(spark, tmp_path):
    performance(spark, SF).write.parquet(str(tmp_path / "t"))
    view = posts.network_slices(spark.read.parquet(str(tmp_path / "t")))["dw_tiktok"]
    assert "EqualTo(network,TIKTOKBUSINESS)" in plan_text(view)


@pytest.mark.parametrize("n", [1, 2])
def test_hot_post_day(spark, n):
    """A third of all records are copies of one post and day."""
    copies = [("hot", D(2024, 1, 1), i, f"v{i}") for i in range(500)]
    others = [(f"p{i}", D(2024, 1, 1), 0, "x") for i in range(1000)]
    df = spark.createDataFrame(copies + others, "post string, day date, at int, v string").repartition(4 * n)
    got = keep_latest(df, ["post", "day"], "at")
    assert got.count() == 1001 and got.where("post = 'hot'").first()["v"] == "v499"


def test_a_record_with_a_hole_never_replaces_a_whole_one(spark, rows):
    at = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [("p", at, None, 5, "a"), ("p", at, 7, 5, "z"), ("p", at, 7, None, None), ("q", at, None, None, "b"), ("q", at, None, 1, None),
         ("r", at, 3, 3, None), ("r", at, 3, 3, "x"), ("s", at, 1, 1, "m"), ("s", dt.datetime(2024, 1, 3), None, None, None)],
        "post string, at timestamp, likes bigint, shares bigint, note string")
    for part in (df, df.orderBy(F.desc("note")), df.repartition(5)):
        got = keep_latest(part, ["post"], "at", whole=["likes", "shares"]).select("post", "likes", "shares", "note")
        assert rows(got) == [("p", 7, 5, "z"), ("q", None, 1, None), ("r", 3, 3, "x"), ("s", None, None, None)]
