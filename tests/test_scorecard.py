"""Targets, brand listening and the scorecard."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.catalog import full_scorecard, listening, sov
from checks.fixtures import SETTINGS
from conftest import plan_text
from postlens.plans import brand, scorecard
from postlens.sources import stage

SF = "/root/testdata/sf0.001"
SF_TRENDS = "/root/testdata/sf0.01"
D = dt.date

TARGET_COLUMNS = ("pais region kpi reach views_platform impressions ave_impressions ave_views comments likes share saves "
                  "vtr50 engagement_rate share_rate save_rate").split()
TARGETS = [
    ("MX", "Mexico", "Organico", "1,000", "2,000", "3,000", "100", "50", "10", "20", "30", "40", "12.5%", "2.5%", "1%", "0.5%"),
    ("CO", "Andino", "Organico", "500", "700", "900", "80", "40", "5", "6", "7", "8", "25%", "5%", "2%", "1%"),
    ("PE", " andino ", "Organico", "300", "100", "200", "60", "20", "1", "2", "3", "4", "50%", "7.5%", "3%", ""),
    ("CR", "CarCam", "Organico", "n/a", "10", "20", "30", "40", "50", "60", "70", "80", "", "", "", ""),
    ("MX", "MEXICO", "Pagado") + ("",) * 13,
    ("-", "TOTAL", "Organico", "1,800", "2,810", "4,120", "90", "45", "66", "88", "110", "132", "20%", "4%", "1.5%", "1%"),
    ("BR", "Brasil", "Organico") + ("9",) * 13,
    ("-", " ", "Organico") + ("1",) * 13,
]


@pytest.fixture(scope="module")
def small_targets(spark):
    return scorecard.kpi_targets(spark.createDataFrame(TARGETS, ", ".join(f"{c} string" for c in TARGET_COLUMNS)))


def test_targets_roll_up(spark, small_targets):
    got = {(r["metric_id"], r["market"], r["pauta"]): r["target_value"] for r in small_targets.collect()}
    assert got["reach", "andino", "organic"] == 800.0  # countries add up
    assert got["vtr", "andino", "organic"] == 0.375  # rates are plain means
    assert got["ave_views", "andino", "organic"] == 30.0
    assert got["saves_rate", "andino", "organic"] == 0.01  # the empty cell does not count
    assert got["reach", "carcam", "organic"] is None
    assert got["reach", "mexico", "paid"] is None  # empty targets keep their row
    assert got["reach", "total", "organic"] == 1800.0
    assert got["total_mentions", "total", "total"] == 86938.0
    assert len(got) == 5 * 13 + 4 == small_targets.count()
    assert sorted(r[0] for r in small_targets.select("display_order").distinct().collect()) == list(range(1, 18))


def cells(spark, rows):
    """Content rows as (post_id, published_date, network, market, pauta, likes, reach, vtr_50)."""
    df = spark.createDataFrame(
        rows, "post_id string, published_date date, network string, market string, pauta string, likes bigint, reach bigint, vtr_50 double")
    rest = {c: F.lit(0).cast("bigint") for c in ["views", "video_views", "comments", "shares", "saves", "engagement"]}
    return df.withColumns(rest | {"tipo_contenido": F.lit("Video")})


def test_totals_keep_what_detail_loses(spark, small_targets):
    content = cells(spark, [
        ("a", D(2024, 1, 1), "TikTok", "mexico", "Orgánico", 1, 10, 0.5), ("b", D(2024, 1, 1), "TikTok", None, "otro", 2, 20, None),
        ("c", D(2024, 1, 1), "TikTok", "andino", "Pagado", 4, 40, 0.25), ("d", None, "TikTok", "mexico", "Pagado", 8, 80, None),
    ]).unionByName(cells(spark, [("e", D(2024, 1, 1), "X", "mexico", "Pagado", 16, 0, None)]).withColumn("tipo_contenido", F.lit("Colaboración")))
    rolled = {(r["market"], r["pauta"]): (r["likes"], r["posts"], r["rated"])
              for r in scorecard.rollup_cells(scorecard.content_cells(content)).collect()}
    assert rolled == {
        ("mexico", "organic"): (1, 1, 1), (None, "organic"): (2, 1, 0), ("andino", "paid"): (4, 1, 1),
        ("mexico", "total"): (1, 1, 1), (None, "total"): (2, 1, 0), ("andino", "total"): (4, 1, 1),
        ("total", "organic"): (3, 2, 1), ("total", "paid"): (4, 1, 1), ("total", "total"): (7, 3, 2)}
    voice = spark.createDataFrame([], "fecha date, scope string, brand_key string, brand_label string, mentions bigint, share_pct double")
    heard = spark.createDataFrame([], "fecha date, total_mentions bigint, men_pos bigint, sentiment_total bigint")
    got = scorecard.executive_scorecard(content, small_targets, heard, voice, SETTINGS)
    likes = {(r["market"], r["pauta"]): r["num"] for r in got.where("metric_id = 'total_likes'").collect()}
    # Neither (andino, paid) nor (total, total) has a target row for likes; NULL markets never match.
    assert likes == {("mexico", "organic"): 1.0, ("total", "organic"): 3.0}
    vtr = got.where("metric_id = 'vtr' and market = 'total'").first()
    assert (vtr["num"], vtr["den"], vtr["is_ratio"]) == (0.5, 1.0, 1)


@pytest.mark.parametrize("first_day, old, new, change", [
    (D(2024, 1, 1), 10, 15, 0.5), (D(2024, 1, 1), 10, 60, 5.0), (D(2024, 1, 1), 10, 61, None), (D(2024, 1, 1), 0, 5, None),
    (D(2024, 1, 2), 10, 15, None),  # a span of 59 days has no earlier period
])
def test_trend(spark, first_day, old, new, change):
    content = cells(spark, [
        ("a", first_day, "TikTok", "mexico", "Pagado", 999, 1, None),
        ("b", D(2024, 1, 31), "TikTok", "mexico", "Pagado", old, 1, None),  # day -30: still the earlier period
        ("c", D(2024, 2, 1), "TikTok", "mexico", "Pagado", new, 1, None),
        ("d", D(2024, 3, 1), "TikTok", "mexico", "Pagado", 0, 1, None),
    ])
    got = scorecard.trend(scorecard.content_cells(content), SETTINGS)
    assert got.count() == 10
    assert got.where("metric_id = 'total_likes'").first()["trend_pct"] == change


def test_trend_only_joins_real_markets(spark):
    card = stage(full_scorecard(spark, SF_TRENDS), "scorecard")
    assert card.where("trend_pct is not null").count() > 0
    assert card.where("trend_pct is not null and (market = 'total' or network is null)").count() == 0


def test_rollup_recomputes_ratios(spark):
    card = spark.createDataFrame([
        (D(2024, 1, 1), "X", "total", "total", "er", 1, 1.0, 10.0, 0.1), (D(2024, 1, 2), "TikTok", "total", "total", "er", 1, 3.0, 10.0, 0.1),
        (D(2024, 1, 2), "X", "mexico", "total", "er", 1, 9.0, 9.0, 0.2), (D(2024, 1, 2), "X", "total", "total", "reach", 0, 5.0, 0.0, 7.0),
        (D(2024, 1, 3), "X", "total", "total", "reach", 0, 6.0, 0.0, 7.0),
    ], "published_date date, network string, market string, pauta string, metric_id string, is_ratio bigint, num double, den double, target_value double")
    card = card.selectExpr("*", "'s' section", "'l' metric_label", "1L display_order", "'f' format_type", "CAST(NULL AS DOUBLE) trend_pct")

    def read(**picked):
        return {r["metric_id"]: (r["actual"], r["target_value"]) for r in scorecard.scorecard_rollup(card, **picked).collect()}

    assert read() == {"er": (0.2, 0.1), "reach": (11.0, 7.0)}
    assert read(market="mexico") == {"er": (1.0, 0.2)}
    assert read(first=D(2024, 1, 3)) == {"reach": (6.0, 7.0)}
    assert read(network="X", last=D(2024, 1, 2)) == {"er": (0.1, 0.1), "reach": (5.0, 7.0)}


def test_long_form_scans_the_content_once(spark):
    content = cells(spark, [("a", D(2024, 1, 1), "TikTok", "mexico", "Pagado", 1, 1, None)])
    path = stage(content, "content")
    plan = plan_text(scorecard.content_metrics(scorecard.rollup_cells(scorecard.content_cells(path))))
    assert plan.count("FileScan") == 1 and "Expand" in plan


def test_unused_share_costs_nothing(spark):
    plan = plan_text(scorecard.voice_by_day(sov(spark, SF), SETTINGS.focus_brand))
    assert "Join" not in plan


def test_shares_of_a_day_add_up(spark):
    voice = sov(spark, SF).cache()
    sums = voice.groupBy("fecha", "scope").agg(F.sum("share_pct").alias("s"), F.sum("mentions").alias("m"))
    assert sums.where("m > 0 and abs(s - 1) > 1e-9").count() == 0
    assert voice.where("mentions is null").count() > 0  # a dash keeps its row
    assert voice.where("mentions is null and share_pct is not null").count() == 0


def test_listening_edge_days(spark):
    raw = spark.createDataFrame(
        [(D(2024, 1, 1), "1", "2", "3", "n/d", "4", "6"), (D(2024, 1, 2), "1", "2", "3", "1", "1", "2"), (None, "1", "1", "1", "1", "1", "1"),
         (D(2024, 1, 3), "1", "2", "3", "0", "0", "0")],
        "fecha date, reach string, total_mentions string, menciones_efectivas string, men_pos string, men_neg string, men_neu string")
    daily = brand.listening(raw)
    got = {r["fecha"].day: (r["sentiment_total"], r["pct_pos"], r["pct_neu"]) for r in daily.collect()}
    assert got == {1: (10, None, None), 2: (4, 0.25, 0.5), 3: (0, None, None)}
    assert brand.sentiment(daily).count() == 8  # the day without a positive count has two rows
    ranged = brand.sentiment_range(daily, D(2024, 1, 1), D(2024, 1, 2)).first()
    assert (ranged["pct_pos"], ranged["pct_neu"]) == (1 / 14, 8 / 14)


def test_sov_range_sums_before_dividing(spark):
    voice = spark.createDataFrame(
        [(D(2024, 1, 1), "competitor", "a", "A", 1, 1.0), (D(2024, 1, 2), "competitor", "a", "A", 1, 0.1),
         (D(2024, 1, 2), "competitor", "b", "B", 8, 0.9), (D(2024, 1, 9), "competitor", "b", "B", 90, 1.0)],
        "fecha date, scope string, brand_key string, brand_label string, mentions bigint, share_pct double")
    got = {r["brand_key"]: r["share_pct"] for r in brand.sov_range(voice, D(2024, 1, 1), D(2024, 1, 2)).collect()}
    assert got == {"a": 0.2, "b": 0.8}


def test_listening_needs_no_join(spark):
    assert "Join" not in plan_text(listening(spark, SF))
