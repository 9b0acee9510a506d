"""From landed snapshot records to per-post KPIs and daily platform gains."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.fixed_values import COUNTERS, DELTA_COUNTERS, IDENTITY, NETWORK_VIEWS, POST_FIELDS, RATES
from postlens.functions import extract, market_of, safe_divide, safe_double, safe_long
from postlens.operators import keep_latest, with_deltas
from postlens.settings import Settings

DELTAS = [f"{c}_delta" for c in DELTA_COUNTERS]

# Column of the written series only: whether the row is the newest of its post.
NEWEST = "_is_newest"

# Column order of the per-post mart.
PERFORMANCE_COLUMNS = [
    "post_id", "profile_id", "username", "network", "country", "region", "market", "published_at",
    "published_date", "fact_date", "format", "campaign_tag", "source_link", "copy", "thumbnail_url", "reach",
    "views", "video_views", "comments", "likes", "shares", "saves", "engagement", "follows", "profile_visits",
    "profile_activity", "exits", "taps_back", "taps_forward",
    *DELTAS,
    "days_since_prev", "engagement_rate", "roi", "frequency", "share_rate", "save_rate",
    "ig_reels_avg_watch_time", "ig_reels_video_view_total_time", "average_time_watched", "total_time_watched",
    "full_video_watched_rate", "vtr_50",
]


def post_metrics_raw(landed: DataFrame, *also: str) -> DataFrame:
    """Typed copy of the landed records, with the columns ``also`` as they are; nothing is dropped."""
    return landed.select(
        *IDENTITY,
        *POST_FIELDS,
        *[safe_long(c).alias(c) for c in COUNTERS],
        *[safe_double(c).alias(c) for c in RATES],
        "region",
        F.col("dt").alias("ingest_date"),
        F.col("_ingested_at").cast("timestamp").alias("_ingested_at"),
        *also,
    )


def latest_records(raw: DataFrame) -> DataFrame:
    """The newest record of each post and day; of those sent at the same moment the one that lacks the fewest counters."""
    return keep_latest(raw, ["post_id", "ingest_date"], "_ingested_at", whole=COUNTERS)


def post_metrics(raw: DataFrame, settings: Settings) -> DataFrame:
    """One row per (post, day) with gains since the post's previous snapshot."""
    return post_series(raw, settings).drop(NEWEST)


def post_series(raw: DataFrame, settings: Settings) -> DataFrame:
    """``post_metrics`` as it is written: with a mark on the newest row of each post.

    A post has one row per day after the first step, so the second window's
    groups are bounded by the number of days, however often a post was sent. The
    mark comes from that same window and saves readers from finding the row again.
    """
    daily = latest_records(raw)
    next_day = F.lead("ingest_date").over(Window.partitionBy("post_id").orderBy("ingest_date"))
    series = with_deltas(daily, "post_id", "ingest_date", DELTA_COUNTERS).withColumn(NEWEST, next_day.isNull())
    return series.select(
        "post_id", "profile_id", "social_network_id", "username", "country", "network", "region",
        "created_at",
        F.to_date("created_at").alias("published_date"),
        "ingest_date",
        F.col("ingest_date").alias("fact_date"),
        "prev_ingest_date",
        F.datediff("ingest_date", "prev_ingest_date").cast("bigint").alias("days_since_prev"),
        F.col("prev_ingest_date").isNull().alias("is_initial_snapshot"),
        "format", "copy", "source_link", "thumbnail_url",
        extract("copy", settings.tag_pattern).alias("campaign_tag"),
        *COUNTERS,
        *DELTAS,
        *RATES,
        NEWEST,
    )


def post_performance(metrics: DataFrame, settings: Settings) -> DataFrame:
    """Newest snapshot of each post with its market and ratios.

    The written table marks that row, so a filter that reaches the scan is all it
    takes. Without the mark, rows chained after ``post_metrics`` already lie by post.
    """
    marked = NEWEST in metrics.columns
    newest = metrics.where(NEWEST) if marked else keep_latest(metrics, ["post_id"], "ingest_date", ties=False)
    return (
        newest
        .withColumns({
            "market": market_of("country", "username", settings.market_overrides),
            "published_at": F.col("created_at"),
            "frequency": safe_divide("views", "reach"),
            "share_rate": safe_divide("shares", "reach"),
            "save_rate": safe_divide("saves", "reach"),
            "vtr_50": F.when(F.col("network") == "TIKTOKBUSINESS", F.col("full_video_watched_rate")),
        })
        .select(*PERFORMANCE_COLUMNS)
    )


def network_slices(performance: DataFrame) -> dict[str, DataFrame]:
    """One filtered DataFrame per network; the filter reaches the table scan."""
    return {f"dw_{name}": performance.where(F.col("network") == code) for code, name in NETWORK_VIEWS.items()}


def platform_summary(metrics: DataFrame, settings: Settings) -> DataFrame:
    """Gains per ingest day, network, country, market and tag.

    Where no delta exists the cumulative value counts. ``metrics`` has one row per
    (post, day) and the day is a key, so counting rows with a post id counts
    distinct posts and needs no distinct stage.
    """
    gained = [F.sum(F.coalesce(f"{c}_delta", c)).alias(f"{c}_gained") for c in DELTA_COUNTERS]
    keys = ["fact_date", "network", "country", "region", "market", "campaign_tag"]
    return (
        metrics.withColumn("market", market_of("country", "username", settings.market_overrides))
        .groupBy(*keys)
        .agg(F.count("post_id").alias("posts"), *gained, F.avg("days_since_prev").alias("avg_window_days"))
        .select(
            *keys,
            "posts",
            *[f"{c}_gained" for c in DELTA_COUNTERS],
            safe_divide("engagement_gained", "reach_gained").alias("engagement_rate"),
            "avg_window_days",
        )
    )
