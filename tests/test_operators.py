"""Sums and distinct counts that add up, and days filled without a join."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from checks.catalog import listening, matched, metrics, sov, targets
from checks.fixtures import SETTINGS
from conftest import plan_text
from postlens.operators import distinct_bitmaps, distinct_counts, exact_avg, exact_sum, fill_days, numbered
from postlens.plans import content, posts, scorecard
from postlens.sources import stage

SF = "/root/testdata/sf0.001"
D = dt.date


def test_sums_have_the_same_bits_however_rows_are_dealt(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), (F.rand(5) * F.pow(F.lit(10.0), F.col("id") % 13)).alias("x"))
    df = stage(df, "doubles")
    got = [{r["k"]: (r["s"], r["a"]) for r in df.repartition(n).groupBy("k").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).collect()} for n in (1, 7, 200)]
    assert got[0] == got[1] == got[2]
    rows = df.collect()
    for k, (s, a) in got[0].items():
        values = [r["x"] for r in rows if r["k"] == k]
        assert s == pytest.approx(math.fsum(values), rel=1e-15) and a == pytest.approx(math.fsum(values) / len(values), rel=1e-15)


def test_values_beyond_the_fixed_point(spark):
    def total(values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(exact_sum("x")).first()[0]

    assert total([]) is None and total([None, None]) is None
    assert total([1.5, None, -0.25]) == 1.25 and total([1e300, 1.0]) == 1e300 and total([2e15, 0.5, None]) == 2e15 + 0.5
    assert math.isnan(total([1.0, math.nan])) and total([math.inf, 1.0]) == math.inf


def test_models_have_the_same_bits_however_rows_are_dealt(spark):
    series, own = stage(metrics(spark, SF), "series"), stage(matched(spark, SF), "content")
    other = [stage(df, "other") for df in (targets(spark, SF), listening(spark, SF), sov(spark, SF))]
    before = None
    for n in (1, 7, 200):
        dealt = own.repartition(n)
        got = [
            sorted(map(repr, df.collect())) for df in (
                posts.platform_summary(series.repartition(n), SETTINGS), content.format_performance(dealt),
                scorecard.executive_scorecard(dealt, *other, SETTINGS))]
        assert before is None or got == before
        before = got


def test_days_are_filled_like_a_spine(spark, rows):
    df = spark.createDataFrame(
        [(D(2024, 1, 2), "a", 1, 5), (D(2024, 1, 5), "a", 2, None), (D(2024, 1, 1), "b", 3, 7), (D(2024, 1, 3), None, 4, 8)],
        "day date, k string, n bigint, m bigint")
    got = rows(fill_days(df, ["k"], "day"))
    known = {(r["day"], r["k"]): (r["n"], r["m"]) for r in df.collect()}
    want = [(D(2024, 1, d), k, *known.get((D(2024, 1, d), k), (None, None))) for d in range(1, 6) for k in ("a", "b", None)]
    assert got == sorted(want, key=repr)
    assert fill_days(df.limit(0), ["k"], "day").count() == 0


def test_the_daily_series_needs_one_shuffle_and_no_join(spark):
    plan = plan_text(content.content_timeseries(stage(matched(spark, SF), "content")))
    # the bounds of all days come from two aggregates of one row each
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange") - plan.count("SinglePartition") == 1


def test_distinct_counts_add_up(spark):
    df = spark.range(100_000).select(
        F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 20).cast("int")).alias("day"), F.concat(F.lit("n"), F.col("id") % 3).alias("network"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("p"), F.xxhash64("id") % 40_000)).alias("value"))
    df = stage(df, "rows")
    numbers = numbered(df, "value", "day", stage)
    n, least, most = numbers.agg(F.count("*"), F.min("number"), F.max("number")).first()
    assert (least, most) == (1, n) and n == df.select(F.countDistinct("value")).first()[0]
    days = stage(distinct_bitmaps(df, ["day", "network"], "value", numbers), "bitmaps")
    span = "day BETWEEN DATE '2024-01-03' AND DATE '2024-01-12'"
    for by in (["network"], ["day"], []):
        got = distinct_counts(days.where(span), by, "n").collect()
        want = df.where(span).groupBy(*by).agg(F.countDistinct("value").alias("n")).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_posts_of_a_range_without_the_content(spark):
    own = stage(matched(spark, SF), "content")
    days = stage(content.content_posts(own), "content_posts")
    counted = content.own_content(own).where("published_date IS NOT NULL")
    for first, last in ((None, None), (D(2023, 11, 1), D(2023, 12, 5)), (D(2030, 1, 1), None)):
        got = {r["network"]: r["posts"] for r in content.posts_in_range(days, ["network"], first, last).collect()}
        rows = counted.where((F.col("published_date") >= F.lit(first or D(1900, 1, 1))) & (F.col("published_date") <= F.lit(last or D(2100, 1, 1))))
        assert got == {r["network"]: r["posts"] for r in rows.groupBy("network").agg(F.countDistinct("post_id").alias("posts")).collect()}
