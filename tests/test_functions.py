"""Parsing, clean-up and dimension helpers on hand-made values."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from postlens.functions import (
    clean_number,
    engagement_rate,
    extract,
    initcap_words,
    is_blank,
    is_collaboration,
    market_of,
    network_name,
    parse_month_day,
    pauta_of,
    region_of,
    safe_divide,
    safe_double,
    safe_long,
    share_rate,
    trim_all,
    view_through_rate,
)


def one_column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", expr.alias("out"))
    return [r["out"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def test_safe_long(spark):
    given = ["12", " 12 ", "+7", "-3", "1.5", "1e3", "", None, "0x1F", "1,200", "9223372036854775807",
             "9223372036854775808", "0000000000000000000000012", "n/a", "-"]
    assert one_column(spark, given, safe_long("v")) == [
        12, 12, 7, -3, None, None, None, None, None, None, 2**63 - 1, None, 12, None, None]


def test_safe_double(spark):
    given = ["1.5", " 2 ", "1e-3", "-.5", "7.", "1.5d", "2f", "0x1p3", "1,5", "", None, "inf", "-Infinity", "e5"]
    assert one_column(spark, given, safe_double("v")) == [
        1.5, 2.0, 0.001, -0.5, 7.0, None, None, None, None, None, None, math.inf, -math.inf, None]
    assert math.isnan(one_column(spark, ["NaN"], safe_double("v"))[0])


def test_clean_number_strips_only_what_is_named(spark):
    assert one_column(spark, ["$1,250.50", "$ 300", "3 400"], safe_double(clean_number("v", "$, "))) == [1250.5, 300.0, 3400.0]
    assert one_column(spark, ["12.5 %", "1,5%"], safe_double(clean_number("v", "% "))) == [12.5, None]


def test_trim_all_takes_every_white_space(spark):
    assert one_column(spark, [" a b ", "\ta\n", " a　", None], trim_all("v")) == ["a b", "a", "a", None]
    assert one_column(spark, ["", " \t", " ", None, "x"], is_blank("v")) == [True, True, True, True, False]


def test_extract_is_null_without_match(spark):
    given = ["https://www.instagram.com/reel/A_1/?x", "https://www.instagram.com/tv/Bc", "https://www.instagram.com/s/x", None]
    assert one_column(spark, given, extract("v", r"instagram\.com/(?:reel|p|tv)/([^/?]+)")) == ["A_1", "Bc", None, None]


@pytest.mark.parametrize("text, out", [
    ("GOOGLE_MY", "Google_My"), ("snapchat", "Snapchat"), ("a-b c.d/e", "A-B C.D/E"), ("x2y", "X2y"), (None, None),
    ("it's", "It's"), ("[ab](cd)", "[Ab](Cd)"), ("a\tb", "A\tB"),
])
def test_initcap_words(spark, text, out):
    assert one_column(spark, [text], initcap_words("v")) == [out]


def test_parse_month_day(spark):
    given = ["June 8", " July 14 ", "june 08", "Jun 3", "soon", "February 30", None]
    assert one_column(spark, given, parse_month_day("v", 2026)) == [
        dt.date(2026, 6, 8), dt.date(2026, 7, 14), dt.date(2026, 6, 8), None, None, None, None]


def test_safe_divide(spark):
    got = spark.sql("SELECT 1L a, 0L b, CAST(NULL AS BIGINT) c, 0.0D z").select(
        safe_divide("a", "b"), safe_divide("a", "c"), safe_divide("z", "z"), safe_divide("a", F.lit(4)))
    assert tuple(got.first()) == (None, None, None, 0.25)


def test_dimensions(spark):
    df = spark.createDataFrame(
        [("mx", "u"), ("CO", "u"), ("TT", "u"), ("AR", "u"), ("US", "u"), ("es", "u"), (None, "u"), ("MX", "Isles"), (None, "Isles")],
        "country string, username string")
    got = df.select(region_of("country"), market_of("country", "username", {"Isles": "carcam"})).collect()
    assert [tuple(r) for r in got] == [
        ("latam", "mexico"), ("latam", "andino"), ("latam", "carcam"), ("latam", None), ("namer", None), ("emea", None),
        (None, None), ("latam", "carcam"), (None, "carcam")]


def test_labels(spark):
    assert one_column(spark, ["TWITTERV2", "LINKEDINCOMPANY", "TIKTOKBUSINESS", "NEW_NET", None], network_name("v")) == [
        "X", "LinkedIn", "TikTok", "New_Net", None]
    assert one_column(spark, ["Pagado", "Orgánico", "pagado", None], pauta_of("v")) == ["paid", "organic", "organic", "organic"]
    assert one_column(spark, ["Colaboración", "Video", None], is_collaboration("v")) == [True, False, False]


def test_platform_rates(spark):
    base = dict(reactions=1, comments=2, shares=3, link_clicks=4, likes=5, saves=6, retweets=7, replies=8,
                post_reach=100, reach=50, post_impressions=200, video_views_50pct=20)
    names = ["facebook", "instagram", "x", "twitter", "tiktok", "youtube", "linkedin", "other"]
    df = spark.createDataFrame([(n, *base.values()) for n in names], "platform string, " + ", ".join(f"{c} bigint" for c in base))
    got = {r[0]: tuple(r)[1:] for r in df.select(
        "platform", engagement_rate("platform"), share_rate("platform"), view_through_rate("platform")).collect()}
    assert got == {
        "facebook": (0.1, 0.03, 0.2), "instagram": (0.26, 0.03, 0.2), "x": (0.12, 0.015, 0.1), "twitter": (0.12, 0.015, 0.1),
        "tiktok": (0.2, 0.03, 0.2), "youtube": (0.05, 0.015, 0.1), "linkedin": (0.05, 0.015, 0.1), "other": (None, 0.015, 0.1)}
    gap = df.withColumn("comments", F.lit(None).cast("bigint")).select(engagement_rate("platform")).collect()
    assert [r[0] is None for r in gap] == [True, True, False, False, True, True, True, True]
