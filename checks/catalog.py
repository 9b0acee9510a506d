"""Registered queries: each reads the provided tables and has SQL to compare with."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import SETTINGS, fixture, table
from checks.oracle import market as sql_market
from checks.oracle import statement
from postlens.functions import engagement_rate, market_of, region_of, share_rate, view_through_rate
from postlens.plans import brand, content, posts, scorecard
from postlens.sources import stage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` and, when given, the SQL that must agree with it."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = statement(sql, extra)
        return fn
    return add


# Models chained over the source tables.

def source(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A source table as files, for those that several models read.

    Landed records come as many files; the provided table is a single one.
    """
    df = fixture(spark, sf, name)
    if name == "fx_post_metrics":
        df = df.repartition(spark.sparkContext.defaultParallelism)
    return stage(df, name)


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return posts.post_metrics_raw(source(spark, sf, "fx_post_metrics"))


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    return posts.post_metrics(raw(spark, sf), SETTINGS)


def performance(spark: SparkSession, sf: str) -> DataFrame:
    return posts.post_performance(metrics(spark, sf), SETTINGS)


def staged_performance(spark: SparkSession, sf: str) -> DataFrame:
    """As in production, where this mart is a table."""
    return stage(performance(spark, sf), "dm_post_performance")


def register(spark: SparkSession, sf: str) -> DataFrame:
    return source(spark, sf, "fx_register")


def paid(spark: SparkSession, sf: str) -> DataFrame:
    return source(spark, sf, "fx_paid")


def matched(spark: SparkSession, sf: str) -> DataFrame:
    return content.match_content(register(spark, sf), paid(spark, sf), staged_performance(spark, sf), SETTINGS)


def staged_content(spark: SparkSession, sf: str) -> DataFrame:
    """Computed once per run, since several marts read it."""
    return stage(matched(spark, sf), "dm_match_content")


def targets(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard.kpi_targets(fixture(spark, sf, "fx_targets"))


def listening(spark: SparkSession, sf: str) -> DataFrame:
    return brand.listening(fixture(spark, sf, "fx_listening"))


def sov(spark: SparkSession, sf: str) -> DataFrame:
    return brand.share_of_voice(fixture(spark, sf, "fx_competitors"), fixture(spark, sf, "fx_sponsors"), SETTINGS)


def full_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard.executive_scorecard(
        staged_content(spark, sf), targets(spark, sf), listening(spark, sf), sov(spark, sf), SETTINGS
    )


query("m01_post_metrics_raw", "SELECT * FROM m01")(raw)
query("m02_post_metrics", "SELECT * FROM m02")(metrics)
query("m03_post_performance", "SELECT * FROM m03")(performance)
query("m06_match_content", "SELECT * FROM m06")(matched)
query("m10_kpi_targets", "SELECT * FROM m10")(targets)
query("m11_listening", "SELECT * FROM m11")(listening)
query("m13_share_of_voice", "SELECT * FROM m13")(sov)
query("m14_executive_scorecard", "SELECT * FROM m14")(full_scorecard)


def _slice(view: str, code: str) -> None:
    @query(f"m04_{view}", f"SELECT * FROM m03 WHERE network = '{code}'")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return posts.network_slices(performance(spark, sf))[view]


for _code, _view in {
    "INSTAGRAMBUSINESS": "dw_instagram", "FACEBOOKPAGE": "dw_facebook", "TWITTER": "dw_twitter",
    "TIKTOKBUSINESS": "dw_tiktok", "YOUTUBECHANNEL": "dw_youtube",
}.items():
    _slice(_view, _code)


@query("m05_platform_summary", "SELECT * FROM m05")
def platform_summary(spark: SparkSession, sf: str) -> DataFrame:
    return posts.platform_summary(metrics(spark, sf), SETTINGS)


@query("m07_match_coverage", "SELECT * FROM m07")
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return content.match_coverage(register(spark, sf), staged_performance(spark, sf), SETTINGS)


@query("m08_format_performance", "SELECT * FROM m08")
def format_performance(spark: SparkSession, sf: str) -> DataFrame:
    return content.format_performance(matched(spark, sf))


@query("m09_content_timeseries", "SELECT * FROM m09")
def timeseries(spark: SparkSession, sf: str) -> DataFrame:
    return content.content_timeseries(staged_content(spark, sf))


@query("m12_sentiment", "SELECT * FROM m12")
def sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return brand.sentiment(listening(spark, sf))


FIRST, LAST = dt.date(2024, 1, 5), dt.date(2024, 1, 20)


@query("m15_scorecard_rollup", (
    "SELECT metric_id, section, metric_label, display_order, format_type, "
    "CASE WHEN bool_or(is_ratio = 1) THEN sum(num) / nullif(sum(den), 0) ELSE sum(num) END AS actual, "
    "max(target_value) AS target_value, max(trend_pct) AS trend_pct FROM m14 "
    "WHERE market = 'total' AND pauta = 'total' GROUP BY ALL"
))
def rollup(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard.scorecard_rollup(full_scorecard(spark, sf))


@query("m15_scorecard_rollup_market", (
    "SELECT metric_id, section, metric_label, display_order, format_type, "
    "CASE WHEN bool_or(is_ratio = 1) THEN sum(num) / nullif(sum(den), 0) ELSE sum(num) END AS actual, "
    "max(target_value) AS target_value, max(trend_pct) AS trend_pct FROM m14 "
    "WHERE market = 'mexico' AND pauta = 'organic' AND network = 'Instagram' "
    "AND published_date BETWEEN DATE '2023-10-10' AND DATE '2023-12-20' GROUP BY ALL"
))
def rollup_market(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard.scorecard_rollup(
        full_scorecard(spark, sf), dt.date(2023, 10, 10), dt.date(2023, 12, 20), "Instagram", "mexico", "organic"
    )


@query("m16_sentiment_range", (
    "SELECT s.*, men_pos::DOUBLE / nullif(sentiment_total, 0) AS pct_pos, men_neu::DOUBLE / nullif(sentiment_total, 0) AS pct_neu, "
    "men_neg::DOUBLE / nullif(sentiment_total, 0) AS pct_neg FROM (SELECT sum(men_pos)::BIGINT AS men_pos, "
    "sum(men_neu)::BIGINT AS men_neu, sum(men_neg)::BIGINT AS men_neg, sum(sentiment_total)::BIGINT AS sentiment_total "
    "FROM m11 WHERE fecha BETWEEN DATE '2024-01-05' AND DATE '2024-01-20') s"
))
def sentiment_range(spark: SparkSession, sf: str) -> DataFrame:
    return brand.sentiment_range(listening(spark, sf), FIRST, LAST)


@query("m17_sov_range", (
    "SELECT scope, brand_key, brand_label, mentions, mentions::DOUBLE / nullif(sum(mentions) OVER (PARTITION BY scope), 0)::DOUBLE "
    "AS share_pct FROM (SELECT scope, brand_key, brand_label, sum(mentions)::BIGINT AS mentions FROM m13 "
    "WHERE fecha BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY ALL)"
))
def sov_range(spark: SparkSession, sf: str) -> DataFrame:
    return brand.sov_range(sov(spark, sf), FIRST, LAST)


def _kpi_sql() -> str:
    def case(options: dict[str, str]) -> str:
        arms = " ".join(f"WHEN platform IN ({names}) THEN {expr}" for names, expr in options.items())
        return f"CASE {arms} END"

    def ratio(top: str, base: str) -> str:
        return f"({top})::DOUBLE / nullif({base}, 0)"

    rate = case({
        "'facebook'": ratio("reactions + comments + shares + link_clicks", "post_reach"),
        "'instagram'": ratio("likes + comments + saves", "reach"),
        "'x', 'twitter'": ratio("likes + retweets + replies + link_clicks", "post_impressions"),
        "'tiktok'": ratio("likes + comments + shares", "reach"),
        "'youtube', 'linkedin'": ratio("likes + comments + shares", "post_impressions"),
    })
    base = "if(platform IN ('facebook', 'instagram', 'tiktok'), post_reach, post_impressions)"
    return (
        f"SELECT event_id, platform, {rate} AS engagement_rate, {ratio('shares', base)} AS share_rate, "
        f"{ratio('video_views_50pct', base)} AS view_through_rate FROM fx_platform_posts"
    )


@query("m18_platform_kpis", _kpi_sql())
def platform_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_platform_posts").select(
        "event_id", "platform",
        engagement_rate("platform").alias("engagement_rate"),
        share_rate("platform").alias("share_rate"),
        view_through_rate("platform").alias("view_through_rate"),
    )


# Every pair of letters turns up as a country, so every listed code does, and many that are not.
_CODES = "SELECT event_id, chr((65 + event_id % 26)::INT) || chr((65 + event_id // 26 % 26)::INT) AS country, 'acct_' || (event_id % 5) AS username FROM events"


def country_codes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        F.expr("chr(65 + event_id % 26) || chr(65 + event_id div 26 % 26)").alias("country"),
        F.expr("'acct_' || (event_id % 5)").alias("username"),
    )


@query("m19_region_of", (
    "SELECT event_id, country, CASE WHEN country IN ('US', 'CA') THEN 'namer' WHEN country IN "
    "('MX','GT','HN','SV','NI','CR','PA','CO','VE','EC','PE','BO','CL','AR','PY','UY','BR','DO','PR','JM','TT','HT') THEN 'latam' "
    "WHEN country IN ('ES','GB','UK','FR','DE','IT','PT','NL','BE','CH','AT','IE','SE','NO','DK','FI','PL','CZ','RO','GR','TR','IL',"
    "'AE','SA','EG','ZA','NG','KE','MA') THEN 'emea' END AS business_region FROM codes"
), {"codes": _CODES})
def regions(spark: SparkSession, sf: str) -> DataFrame:
    return country_codes(spark, sf).select("event_id", "country", region_of("country").alias("business_region"))


@query("m20_market_of", f"SELECT event_id, country, username, {sql_market()} AS market FROM codes", {"codes": _CODES})
def markets(spark: SparkSession, sf: str) -> DataFrame:
    return country_codes(spark, sf).select(
        "event_id", "country", "username",
        market_of("country", "username", SETTINGS.market_overrides).alias("market"),
    )
