"""Reusable DataFrame operators."""

from postlens.operators.distinct import distinct_bitmaps, distinct_counts, numbered
from postlens.operators.filters import likely_in, split_likely
from postlens.operators.matching import link_pairs
from postlens.operators.reshape import date_spine, fill_days, long_pairs, share_within, unpivot_present, zero_fill
from postlens.operators.snapshots import keep_latest, with_deltas
from postlens.operators.sums import exact_avg, exact_sum

__all__ = [
    "date_spine", "distinct_bitmaps", "distinct_counts", "exact_avg", "exact_sum", "fill_days", "keep_latest", "likely_in",
    "link_pairs", "long_pairs", "numbered", "share_within", "split_likely", "unpivot_present", "with_deltas", "zero_fill",
]
