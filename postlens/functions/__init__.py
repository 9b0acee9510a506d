"""Column-to-Column helpers; everything stays inside Catalyst expressions."""

from postlens.functions.dimensions import (
    is_collaboration,
    market_of,
    network_name,
    pauta_of,
    region_of,
)
from postlens.functions.kpis import engagement_rate, safe_divide, share_rate, view_through_rate, within_limit
from postlens.functions.text import (
    clean_number,
    extract,
    initcap_words,
    is_blank,
    parse_month_day,
    safe_double,
    safe_long,
    trim_all,
)

__all__ = [
    "clean_number", "engagement_rate", "extract", "initcap_words", "is_blank",
    "is_collaboration", "market_of", "network_name", "parse_month_day", "pauta_of",
    "region_of", "safe_divide", "safe_double", "safe_long", "share_rate", "trim_all",
    "view_through_rate", "within_limit",
]
