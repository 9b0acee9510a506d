"""Sums of doubles that don't depend on the order in which tasks add."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits behind the point, and the size up to which a value is added as a fixed-point number. 15 digits
# before the point and 16 behind it leave seven of 38 for the sum.
FRACTION_DIGITS = 16
FIXED_BELOW = 1e15


def exact_sum(value: Column | str) -> Column:
    """The sum of a numeric column as a double, with the same bits however rows are dealt to tasks.

    Values are added as decimals with 16 digits behind the point, so partial sums are exact. NULLs count for
    nothing, and no value gives NULL. Values of 1e15 and more, infinities and NaN are
    added as doubles beside them; only a sum of several such values may depend on the order.
    """
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    fixed = F.abs(x) < FIXED_BELOW
    exact = F.sum(F.when(fixed, x.cast(f"decimal(31,{FRACTION_DIGITS})"))).cast("double")
    rest = F.sum(F.when(~fixed, x))
    return F.when(rest.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + rest)


def exact_avg(value: Column | str) -> Column:
    """The mean over ``exact_sum``; NULL where there is no value."""
    return F.try_divide(exact_sum(value), F.count(value))
