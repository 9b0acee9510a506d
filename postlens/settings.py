"""What differs from one brand or campaign to the next."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from postlens.fixed_values import BRAND_METRICS


@dataclass(frozen=True)
class Settings:
    """Parameters of one region's models.

    ``market_overrides`` maps an account name to a market and wins over the
    country. ``brand_labels`` maps a brand column to its printed name; a brand
    without an entry keeps its column name. ``brand_targets`` are the targets that
    no sheet holds, as (metric_id, section, label, display order, target, format).
    """

    region: str = "latam"
    tag_prefix: str = "TAG"
    market_overrides: Mapping[str, str] = field(default_factory=dict)
    paid_year: int = 2026
    collaboration_market: str = "mexico"
    competitor_brands: Sequence[str] = ()
    sponsor_brands: Sequence[str] = ()
    brand_labels: Mapping[str, str] = field(default_factory=dict)
    focus_brand: str = ""
    brand_targets: Sequence[tuple] = tuple(BRAND_METRICS)
    trend_days: int = 30
    trend_limit: float = 5.0

    @property
    def tag_pattern(self) -> str:
        return f"#({self.tag_prefix}[A-Z0-9_]+)"
