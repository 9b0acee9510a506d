"""Brand listening: daily mentions, sentiment and share of voice."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions import safe_divide, safe_long
from postlens.operators import share_within, unpivot_present
from postlens.settings import Settings

# Sentiment column -> printed name.
SENTIMENTS = {"men_pos": "Positive", "men_neu": "Neutral", "men_neg": "Negative"}


def listening(raw: DataFrame) -> DataFrame:
    """Typed daily counts. The total takes a bad count as 0, the shares do not."""
    counts = ["reach", "total_mentions", "menciones_efectivas", "men_pos", "men_neg", "men_neu"]
    typed = raw.where(F.col("fecha").isNotNull()).select("fecha", *[safe_long(c).alias(c) for c in counts])
    classed = F.col("men_pos") + F.col("men_neg") + F.col("men_neu")
    total = F.coalesce("men_pos", F.lit(0)) + F.coalesce("men_neg", F.lit(0)) + F.coalesce("men_neu", F.lit(0))
    return typed.select(
        "*",
        total.alias("sentiment_total"),
        *[safe_divide(f"men_{s}", classed).alias(f"pct_{s}") for s in ["pos", "neg", "neu"]],
    )


def sentiment(daily: DataFrame) -> DataFrame:
    """Counts by day and sentiment; days without a count have no row for it."""
    long = unpivot_present(daily.where(F.col("fecha").isNotNull()), ["fecha"], list(SENTIMENTS), "kind", "mentions")
    label = F.coalesce(*[F.when(F.col("kind") == k, F.lit(name)) for k, name in SENTIMENTS.items()])
    return long.select("fecha", label.alias("sentiment"), "mentions")


def _brands(raw: DataFrame, scope: str, brands: Sequence[str]) -> DataFrame:
    """Empty cells go before the cast, so a cell that is no number stays as NULL mentions."""
    long = unpivot_present(raw.where(F.col("fecha").isNotNull()), ["fecha"], brands, "brand_key", "cell")
    return long.select("fecha", F.lit(scope).alias("scope"), "brand_key", safe_long("cell").alias("mentions"))


def share_of_voice(competitors: DataFrame, sponsors: DataFrame, settings: Settings) -> DataFrame:
    """Mentions and daily share by day, scope and brand."""
    long = _brands(competitors, "competitor", settings.competitor_brands).unionByName(
        _brands(sponsors, "sponsor", settings.sponsor_brands)
    )
    labels = [F.when(F.col("brand_key") == k, F.lit(name)) for k, name in settings.brand_labels.items()]
    return share_within(long, "mentions", ["fecha", "scope"], "share_pct").select(
        "fecha", "scope", "brand_key",
        F.coalesce(*labels, "brand_key").alias("brand_label"),
        "mentions", "share_pct",
    )


def sentiment_range(daily: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Sentiment shares of a period: sums over sums, never a mean of daily shares."""
    sums = daily.where(F.col("fecha").between(first, last)).agg(
        *[F.sum(c).alias(c) for c in [*SENTIMENTS, "sentiment_total"]]
    )
    return sums.select(
        "*", *[safe_divide(c, "sentiment_total").alias(c.replace("men_", "pct_")) for c in SENTIMENTS]
    )


def sov_range(sov: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Share of voice of a period: mentions per brand first, then the share within the scope."""
    brands = (
        sov.where(F.col("fecha").between(first, last))
        .groupBy("scope", "brand_key", "brand_label")
        .agg(F.sum("mentions").alias("mentions"))
    )
    return share_within(brands, "mentions", ["scope"], "share_pct")
