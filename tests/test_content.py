"""Register matching, coverage and content marts on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.fixtures import SETTINGS, fixture
from conftest import plan_text
from postlens.plans import content, posts
from postlens.sources import stage

SF = "/root/testdata/sf0.001"
D = dt.date

REGISTER = "market string, fecha string, nombre string, link_ig string, link_tiktok string, tipo_contenido string, pauta_ig string, pauta_tiktok string"
PAID = ("published_date string, name string, creador string, format string, url string, inversion_ejecutada string, reach string, "
        "impressions string, views string, vtr_50 string, likes string, comments string, shares string, engagement string, post_id string")


def performance_rows(spark, rows):
    """Posts as (post_id, network, source_link, published_date, market, reach, likes)."""
    df = spark.createDataFrame(
        rows, "post_id string, network string, source_link string, published_date date, market string, reach bigint, likes bigint")
    types = {"published_at": "timestamp", "fact_date": "date"} | {
        c: "double" for c in ["engagement_rate", "roi", "frequency", "share_rate", "save_rate", "ig_reels_avg_watch_time",
                              "ig_reels_video_view_total_time", "average_time_watched", "total_time_watched",
                              "full_video_watched_rate", "vtr_50"]
    } | {c: "string" for c in ["profile_id", "username", "country", "region", "format", "campaign_tag", "copy", "thumbnail_url"]}
    missing = {c: F.lit(None).cast(types.get(c, "bigint")) for c in posts.PERFORMANCE_COLUMNS if c not in df.columns}
    return stage(df.withColumns(missing).select(*posts.PERFORMANCE_COLUMNS), "posts")


@pytest.fixture(scope="module")
def small(spark):
    own = performance_rows(spark, [
        ("p1", "INSTAGRAMBUSINESS", "https://www.instagram.com/reel/A_1/", D(2024, 1, 1), "mexico", 10, 1),
        ("p2", "INSTAGRAMBUSINESS", "https://www.instagram.com/p/AX1/", D(2024, 1, 3), None, 20, 2),
        ("777", "TIKTOKBUSINESS", "https://tiktok.com/v/777", D(2024, 1, 2), "andino", 30, 3),
        (None, "NEW_NET", "https://www.instagram.com/reel/NOID/", D(2024, 1, 2), "mexico", 40, 4),
    ])
    register = spark.createDataFrame([
        ("mexico", "d", "wild", "https://www.instagram.com/reel/A_1/?x", None, None, "Orgánico", None),
        ("mexico", "d", "twice", "https://www.instagram.com/reel/A_1/?x", None, None, "Orgánico", None),
        ("mexico", "d", "both", "https://www.instagram.com/p/AX1", "https://www.tiktok.com/@a/video/777", "Video", "otro", "Pagado"),
        ("mexico", "d", "noid", "https://www.instagram.com/tv/NOID", " ", "Video", None, None),
        ("mexico", "d", "story", "https://www.instagram.com/s/abc", "https://www.tiktok.com/t/ZM1", None, None, None),
        ("mexico", "d", "late", "https://www.instagram.com/p/LATER", "https://www.tiktok.com/@a/video/999", None, None, None),
        ("mexico", "d", "odd", "see brief", "tbd", "Colaboración", None, None),
        (None, None, None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None),
    ], REGISTER)
    http = "https://x/c"
    paid = spark.createDataFrame([
        ("June 8", "n1", "c1", "REEL", http, "$1,000.50", "5", "50", "7", "25%", "1", "2", "3", "4", "AX1"),
        ("June 9", "n2", "c2", "REEL", http, "$ 300", "9", "50", "7", "25%", "1", "2", "3", "4", "AX1"),
        ("June 9", "n3", "c3", "REEL", http, "7", "1", "50", "7", "25%", "1", "2", "3", "4", "777"),
        ("soon", "n4", "c4", "REEL", http, "-", "0", "50", "7", "12.5 %", "1", "2", "3", "4", "ZZ9"),
        ("June 1", "n5", "c5", "REEL", http, "-", "8", "50", "7", "na", "1", "2", "3", "4", "12345"),
        ("June 1", "n6", "c6", "REEL", "pending", "-", "8", "50", "7", "na", "1", "2", "3", "4", "54321"),
        ("June 1", "n7", "c7", "REEL", http, "-", "8", "50", "7", "na", "1", "2", "3", "4", " "),
    ], PAID)
    return own, register, paid


def test_match_content(spark, small, rows):
    own, register, paid = small
    got = content.match_content(register, paid, own, SETTINGS)
    assert len(got.columns) == 56
    assert rows(got.select("post_id", "network", "tipo_contenido", "pauta", "spend", "spend_reach")) == sorted([
        # 'A_1' also matches 'AX1', whose post carries a spend; the repeated register row adds nothing.
        ("p1", "Instagram", None, "Orgánico", None, None),
        ("p2", "Instagram", None, "Orgánico", 1000.5, 9),
        ("p2", "Instagram", "Video", "otro", 1000.5, 9),
        ("777", "TikTok", "Video", "Pagado", 7.0, 1),
        (None, "New_Net", "Video", None, None, None),
        ("ZZ9", "Instagram", "Colaboración", "Pagado", None, 0),
        ("12345", "TikTok", "Colaboración", "Pagado", None, 8),
    ], key=repr)
    other = got.where("post_id = 'ZZ9'").select("published_date", "views", "video_views", "frequency", "vtr_50", "market", "region")
    assert tuple(other.first()) == (None, 50, 7, None, 0.125, "mexico", "latam")


def test_match_coverage(spark, small, rows):
    own, register, _ = small
    got = content.match_coverage(register, own, SETTINGS)
    assert got.count() == 2 * register.count()
    assert rows(got.select("content_name", "platform", "matched_post_id", "match_status", "reason")) == sorted([
        ("wild", "instagram", "p1", "matched", "ok"), ("wild", "tiktok", None, "unmatched", "no_link"),
        ("twice", "instagram", "p1", "matched", "ok"), ("twice", "tiktok", None, "unmatched", "no_link"),
        ("both", "instagram", "p2", "matched", "ok"), ("both", "tiktok", "777", "matched", "ok"),
        # The post has no id: it sorts first and leaves the row unmatched.
        ("noid", "instagram", None, "unmatched", "not_yet_ingested"), ("noid", "tiktok", None, "unmatched", "no_link"),
        ("story", "instagram", None, "unmatched", "ig_story"), ("story", "tiktok", None, "unmatched", "tiktok_shortlink"),
        ("late", "instagram", None, "unmatched", "not_yet_ingested"), ("late", "tiktok", None, "unmatched", "not_yet_ingested"),
        ("odd", "instagram", None, "unmatched", "unparseable"), ("odd", "tiktok", None, "unmatched", "unparseable"),
        (None, "instagram", None, "unmatched", "no_link"), (None, "tiktok", None, "unmatched", "no_link"),
        (None, "instagram", None, "unmatched", "no_link"), (None, "tiktok", None, "unmatched", "no_link"),
    ], key=repr)


def test_several_spends_fan_out(spark, small):
    own, register, _ = small
    sheet = spark.createDataFrame([
        ("June 8", "n", "c", "REEL", "http", "1", "5", "", "", "", "", "", "", "", "AX1"),
        ("June 8", "n", "c", "REEL", "http", "2", "6", "", "", "", "", "", "", "", "X1"),
    ], PAID)
    got = content.match_content(register, sheet, own, SETTINGS).where("post_id = 'p2' and tipo_contenido = 'Video'")
    assert sorted(r["spend"] for r in got.collect()) == [1.0, 2.0]


def timeseries_input(spark, own, register, paid):
    return stage(content.match_content(register, paid, own, SETTINGS), "content")


def test_timeseries_has_every_day_of_every_combination(spark, small):
    matched = timeseries_input(spark, *small)
    got = content.content_timeseries(matched)
    dims = ["network", "region", "market", "pauta"]
    combos = got.select(*dims).distinct().count()
    assert got.count() == 3 * combos == got.select("published_date", *dims).distinct().count()
    day = got.where("published_date = DATE '2024-01-02' and network = 'Instagram'")
    assert {(r["posts"], r["engagement_rate"]) for r in day.collect()} == {(0, None)}


def test_combinations_with_null_keys_stay_zero(spark):
    own = performance_rows(spark, [
        ("p1", None, "l", D(2024, 1, 1), "mexico", 10, 1), ("p2", "TWITTER", "l", D(2024, 1, 2), "mexico", 20, 2),
        ("p3", "TWITTER", "l", D(2024, 1, 2), None, 5, 2), ("p4", "TWITTER", "l", D(2024, 1, 4), None, 5, 2),
    ]).withColumn("region", F.when(F.col("post_id") != "p4", "latam").otherwise("latam"))
    matched = own.withColumns({"tipo_contenido": F.lit("Video"), "pauta": F.lit("Pagado")})
    got = content.content_timeseries(matched)
    assert got.count() == 4 * 3
    assert got.where("network is null").agg(F.sum("posts")).first()[0] == 0
    assert got.where("market = 'sin_market'").agg(F.sum("posts")).first()[0] == 2


def test_empty_content_has_no_days(spark, small):
    matched = timeseries_input(spark, *small).where("post_id = 'none'")
    assert content.content_timeseries(matched).count() == 0


def test_no_nested_loops_and_no_cross_joins(spark):
    own = stage(posts.post_performance(posts.post_metrics(
        posts.post_metrics_raw(fixture(spark, SF, "fx_post_metrics")), SETTINGS), SETTINGS), "posts")
    register, paid = fixture(spark, SF, "fx_register"), fixture(spark, SF, "fx_paid")
    matched = stage(content.match_content(register, paid, own, SETTINGS), "content")
    frames = [
        content.match_content(register, paid, own, SETTINGS), content.match_coverage(register, own, SETTINGS),
        content.content_timeseries(matched), content.format_performance(matched),
    ]
    for df in frames:
        plan = plan_text(df)
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_register_key(spark, small):
    """A third of the register is one link; the owned row appears once, coverage keeps every row."""
    own, _, paid = small
    register = spark.range(900).select(
        F.lit("mexico").alias("market"), F.lit("d").alias("fecha"), F.concat(F.lit("n"), "id").alias("nombre"),
        F.when(F.col("id") % 3 == 0, "https://www.instagram.com/p/AX1").otherwise(
            F.concat(F.lit("https://www.instagram.com/p/Q"), "id")).alias("link_ig"),
        F.lit(None).cast("string").alias("link_tiktok"), F.lit("Video").alias("tipo_contenido"),
        F.lit("Pagado").alias("pauta_ig"), F.lit(None).cast("string").alias("pauta_tiktok"))
    assert content.match_content(register, paid, own, SETTINGS).where("post_id = 'p2'").count() == 1
    covered = content.match_coverage(register, own, SETTINGS)
    assert covered.count() == 1800 and covered.where("reason = 'ok'").count() == 300
