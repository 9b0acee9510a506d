"""KPI targets and the executive scorecard."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.fixed_values import (
    BRAND_METRICS,
    RATIO_METRICS,
    SHEET_METRICS,
    TARGET_MARKETS,
    TARGET_PAUTAS,
)
from postlens.functions import clean_number, is_blank, safe_divide, safe_double, trim_all, within_limit
from postlens.operators import exact_avg, exact_sum, long_pairs
from postlens.plans.content import Keep, own_content
from postlens.settings import Settings
from postlens.sources.session import stage

# Published metric column -> column of the target sheet, by roll-up rule.
ADDITIVE = {
    "reach": "reach", "views_platform": "views_platform", "impressions": "impressions",
    "comments": "comments", "likes": "likes", "shares": "share", "saves": "saves",
}
AVERAGED = {"ave_impressions": "ave_impressions", "ave_views": "ave_views"}
AVERAGED_PERCENT = {"vtr": "vtr50", "er": "engagement_rate", "shares_rate": "share_rate", "saves_rate": "save_rate"}

TOTAL = "total"
SUMS = ["views", "reach", "video_views", "comments", "likes", "shares", "saves", "engagement", "vtr_50"]
# Of these the sums of rates, which are doubles; counters are whole numbers.
RATE_SUMS = {"vtr_50"}
# Sums of the cells, and with them the number of rates and of posts behind them.
CELL_SUMS = [*SUMS, "rated", "posts"]


def _label(c: str, names: dict[str, str]) -> Column:
    text = F.upper(trim_all(c))
    return F.coalesce(*[F.when(text == raw, F.lit(name)) for raw, name in names.items()])


def _clean_targets(raw: DataFrame) -> DataFrame:
    numbers = {m: safe_double(clean_number(c, ",")) for m, c in (ADDITIVE | AVERAGED).items()}
    numbers |= {m: safe_divide(safe_double(clean_number(c, "%,")), F.lit(100)) for m, c in AVERAGED_PERCENT.items()}
    return raw.where(~is_blank("region") & F.col("kpi").isNotNull()).select(
        _label("region", TARGET_MARKETS).alias("market"),
        _label("kpi", TARGET_PAUTAS).alias("pauta"),
        *[value.alias(m) for m, value in numbers.items()],
    )


def kpi_targets(raw: DataFrame, brand_targets: Sequence[tuple] = BRAND_METRICS) -> DataFrame:
    """Targets by metric, market and pauta.

    Countries roll up to their market (sums, or simple means for rates and
    averages); the sheet's own total rows pass as they are. Empty targets keep
    their row. ``brand_targets`` are the few targets that the sheet does not hold.
    """
    spark = raw.sparkSession
    metrics = [row[0] for row in SHEET_METRICS]
    clean = _clean_targets(raw)
    rolled = (
        clean.where(F.col("market") != TOTAL)
        .groupBy("market", "pauta")
        .agg(*[(exact_sum(m) if m in ADDITIVE else exact_avg(m)).alias(m) for m in metrics])
    )
    totals = clean.where(F.col("market") == TOTAL).select("market", "pauta", *metrics)
    long = rolled.unionByName(totals).unpivot(["market", "pauta"], metrics, "metric_col", "target_value")
    # Thirteen constant rows.
    meta = spark.createDataFrame(
        SHEET_METRICS,
        "metric_col string, metric_id string, section string, metric_label string, display_order bigint, format_type string",
    )
    columns = ["metric_id", "market", "pauta", "section", "metric_label", "display_order", "target_value", "format_type"]
    brand = spark.createDataFrame(
        [(i, TOTAL, TOTAL, s, label, n, value, f) for i, s, label, n, value, f in brand_targets],
        "metric_id string, market string, pauta string, section string, metric_label string, "
        "display_order bigint, target_value double, format_type string",
    )
    return long.join(F.broadcast(meta), "metric_col").select(*columns).unionByName(brand)


def content_cells(content: DataFrame) -> DataFrame:
    """Sums per publishing day, network, market and pauta: all the scorecard reads of the content."""
    return (
        own_content(content.where(F.col("published_date").isNotNull()))
        .groupBy("published_date", "network", "market", "pauta")
        .agg(
            *[(exact_sum(c) if c in RATE_SUMS else F.sum(c)).alias(c) for c in SUMS],
            F.count("vtr_50").alias("rated"),
            F.count("*").alias("posts"),
        )
    )


def rollup_cells(cells: DataFrame) -> DataFrame:
    """Market and pauta, each also as 'total'.

    The grouping sets run over the cells, not over the content, so the fourfold
    expansion touches few rows. A NULL market stays NULL in the detail.
    """
    day, network, market, pauta = (F.col(c) for c in ["published_date", "network", "market", "pauta"])
    rolled = cells.groupingSets(
        [[day, network, market, pauta], [day, network, market], [day, network, pauta], [day, network]],
        day, network, market, pauta,
    ).agg(
        F.grouping("market").alias("all_markets"),
        F.grouping("pauta").alias("all_pautas"),
        *[(exact_sum(c) if c in RATE_SUMS else F.sum(c).cast("double")).alias(c) for c in CELL_SUMS],
    )
    return rolled.select(
        "published_date", "network",
        F.when(F.col("all_markets") == 1, TOTAL).otherwise(market).alias("market"),
        F.when(F.col("all_pautas") == 1, TOTAL).otherwise(pauta).alias("pauta"),
        *CELL_SUMS,
    )


def content_metrics(rolled: DataFrame) -> DataFrame:
    """The thirteen content metrics as (metric_id, num, den)."""
    c, zero = F.col, F.lit(0.0)
    return long_pairs(rolled, ["published_date", "network", "market", "pauta"], {
        "views_2_3s": (c("video_views"), zero),
        "impressions": (c("views"), zero),
        "reach": (c("reach"), zero),
        "ave_impressions": (c("views"), c("posts")),
        "ave_views": (c("video_views"), c("posts")),
        "total_comments": (c("comments"), zero),
        "vtr": (c("vtr_50"), c("rated")),
        "er": (c("engagement"), c("reach")),
        "shares": (c("shares"), zero),
        "shares_rate": (c("shares"), c("reach")),
        "saves": (c("saves"), zero),
        "saves_rate": (c("saves"), c("reach")),
        "total_likes": (c("likes"), zero),
    })


def _as_brand_rows(df: DataFrame, metrics: dict[str, tuple[Column, Column]]) -> DataFrame:
    keyed = df.withColumns({
        "network": F.lit(None).cast("string"), "market": F.lit(TOTAL), "pauta": F.lit(TOTAL),
    }).withColumnRenamed("fecha", "published_date")
    return long_pairs(keyed, ["published_date", "network", "market", "pauta"], metrics)


def voice_by_day(sov: DataFrame, focus_brand: str) -> DataFrame:
    """Mentions of the focus brand and of all brands, per day and scope."""
    def mentions(scope: str, brand: str | None = None) -> Column:
        wanted = F.col("scope") == scope
        if brand is not None:
            wanted = wanted & (F.col("brand_key") == brand)
        return F.sum(F.when(wanted, F.col("mentions")).otherwise(0))

    return sov.groupBy("fecha").agg(
        mentions("competitor", focus_brand).alias("focus_competitor"),
        mentions("competitor").alias("all_competitor"),
        mentions("sponsor", focus_brand).alias("focus_sponsor"),
        mentions("sponsor").alias("all_sponsor"),
    )


def brand_metrics(daily: DataFrame, sov: DataFrame, focus_brand: str) -> DataFrame:
    """The four brand metrics; they belong to no network, market or pauta."""
    c = F.col
    heard = _as_brand_rows(daily, {
        "total_mentions": (c("total_mentions"), F.lit(0.0)),
        "positive_sentiment": (c("men_pos"), c("sentiment_total")),
    })
    voice = _as_brand_rows(voice_by_day(sov, focus_brand), {
        "sov": (c("focus_competitor"), c("all_competitor")),
        "sov_sponsors": (c("focus_sponsor"), c("all_sponsor")),
    })
    return heard.unionByName(voice)


def trend(cells: DataFrame, settings: Settings) -> DataFrame:
    """Change of the last period against the one before, per network and market.

    The earlier period only counts when the content spans both. Changes beyond
    the limit, either way, are noise and become NULL.
    """
    days = settings.trend_days
    newest = cells.agg(F.max("published_date")).scalar()
    oldest = cells.agg(F.min("published_date")).scalar()
    age = F.datediff(newest, "published_date")
    span = F.datediff(newest, oldest)
    period = F.when(age < days, "last").when((age < 2 * days) & (span >= 2 * days), "prev")

    def total(when: str, c: str) -> Column:
        value = F.when(F.col("period") == when, F.col(c))
        return exact_sum(value) if c in RATE_SUMS else F.sum(value)

    sums = (
        cells.withColumn("period", period)
        .where(F.col("period").isNotNull())
        .groupBy("network", "market")
        .agg(*[total(p, c).alias(f"{p}_{c}") for p in ["last", "prev"] for c in CELL_SUMS])
    )

    def values(p: str) -> dict[str, Column]:
        c = {name: F.col(f"{p}_{name}") for name in CELL_SUMS}
        return {
            "views_2_3s": c["video_views"],
            "impressions": c["views"],
            "reach": c["reach"],
            "total_comments": c["comments"],
            "vtr": safe_divide(c["vtr_50"], c["rated"]),
            "er": safe_divide(c["engagement"], c["reach"]),
            "shares_saves": c["shares"] + c["saves"],
            "total_likes": c["likes"],
            "total_mentions": F.lit(None),
            "sov": F.lit(None),
        }

    last, prev = values("last"), values("prev")
    cells_out = []
    for metric in last:
        now, before = last[metric].cast("double"), prev[metric].cast("double")
        change = safe_divide(now - before, before)
        kept = within_limit(change, settings.trend_limit)
        cells_out.append(F.struct(F.lit(metric).alias("metric_id"), kept.alias("trend_pct")))
    return sums.select(F.inline(F.array(*cells_out)), "network", "market")


def executive_scorecard(
    content: DataFrame,
    targets: DataFrame,
    daily: DataFrame,
    sov: DataFrame,
    settings: Settings,
    keep: Keep = stage,
) -> DataFrame:
    """Every KPI by day, network, market and pauta with its target and trend.

    Cells whose (metric, market, pauta) has no target row are left out, as are
    cells with a NULL market; the totals still contain them.
    """
    cells = keep(content_cells(content), "content_cells")
    metrics = content_metrics(rollup_cells(cells)).unionByName(brand_metrics(daily, sov, settings.focus_brand))
    return (
        metrics.join(targets, ["metric_id", "market", "pauta"])
        .join(trend(cells, settings), ["metric_id", "network", "market"], "left")
        .select(
            "published_date", "network", "market", "pauta",
            "metric_id", "section", "metric_label", "display_order", "format_type",
            F.when(F.col("metric_id").isin(RATIO_METRICS), 1).otherwise(0).cast("bigint").alias("is_ratio"),
            "num", "den", "target_value", "trend_pct",
        )
    )


def scorecard_rollup(
    scorecard: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
    network: str | None = None,
    market: str = TOTAL,
    pauta: str = TOTAL,
) -> DataFrame:
    """One figure per KPI for a date range, network, market and pauta.

    Exactly one market and one pauta are picked, since totals lie beside their
    detail; ratios are recomputed from the sums.
    """
    picked = (F.col("market") == market) & (F.col("pauta") == pauta)
    if network is not None:
        picked = picked & (F.col("network") == network)
    if first is not None:
        picked = picked & (F.col("published_date") >= F.lit(first))
    if last is not None:
        picked = picked & (F.col("published_date") <= F.lit(last))
    ratio = F.max("is_ratio") == 1
    return (
        scorecard.where(picked)
        .groupBy("metric_id", "section", "metric_label", "display_order", "format_type")
        .agg(
            F.when(ratio, safe_divide(exact_sum("num"), exact_sum("den"))).otherwise(exact_sum("num")).alias("actual"),
            F.max("target_value").alias("target_value"),
            F.max("trend_pct").alias("trend_pct"),
        )
    )
