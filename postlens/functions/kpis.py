"""Ratios and per-platform KPI formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Platform -> (numerator terms, denominator) of the engagement rate.
ENGAGEMENT_TERMS = {
    "facebook": (["reactions", "comments", "shares", "link_clicks"], "post_reach"),
    "instagram": (["likes", "comments", "saves"], "reach"),
    "x": (["likes", "retweets", "replies", "link_clicks"], "post_impressions"),
    "twitter": (["likes", "retweets", "replies", "link_clicks"], "post_impressions"),
    "tiktok": (["likes", "comments", "shares"], "reach"),
    "youtube": (["likes", "comments", "shares"], "post_impressions"),
    "linkedin": (["likes", "comments", "shares"], "post_impressions"),
}

# Platforms whose share and view-through rates are per reached account.
REACH_PLATFORMS = ["facebook", "instagram", "tiktok"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def within_limit(change: Column, limit: float) -> Column:
    """The change, or NULL where it is beyond the limit either way and so noise."""
    return F.when(F.abs(change) <= limit, change)


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """a / b as a double, NULL when b is zero or either side is NULL."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def engagement_rate(platform: Column | str) -> Column:
    """Engagement rate by platform; a NULL term makes the rate NULL, as does an unknown platform."""
    rates = []
    for name, (terms, base) in ENGAGEMENT_TERMS.items():
        total = F.col(terms[0])
        for term in terms[1:]:
            total = total + F.col(term)
        rates.append(F.when(_col(platform) == name, safe_divide(total, base)))
    return F.coalesce(*rates)


def _per_audience(platform: Column | str, top: str) -> Column:
    base = F.when(_col(platform).isin(REACH_PLATFORMS), F.col("post_reach")).otherwise(F.col("post_impressions"))
    return safe_divide(top, base)


def share_rate(platform: Column | str) -> Column:
    return _per_audience(platform, "shares")


def view_through_rate(platform: Column | str) -> Column:
    return _per_audience(platform, "video_views_50pct")
