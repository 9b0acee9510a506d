"""Wide to long, date spines, zero filling and shares."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.kpis import safe_divide


def unpivot_present(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide to long without the NULL cells, which ``DataFrame.unpivot`` would keep."""
    return df.unpivot(list(ids), list(values), name, value).where(F.col(value).isNotNull())


def long_pairs(df: DataFrame, ids: Sequence[str], metrics: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """One row per input row and metric as (metric_id, num, den), in a single pass."""
    cells = [
        F.struct(F.lit(m).alias("metric_id"), num.cast("double").alias("num"), den.cast("double").alias("den"))
        for m, (num, den) in metrics.items()
    ]
    return df.select(*ids, F.inline(F.array(*cells)))


def date_spine(df: DataFrame, dims: Sequence[str], day: str) -> DataFrame:
    """Every day between the first and last day of ``df`` for every existing ``dims``.

    The overall bounds come from the small per-combination bounds through scalar
    subqueries, so nothing is cross joined.
    """
    combos = df.groupBy(*dims).agg(F.min(day).alias("__lo"), F.max(day).alias("__hi"))
    first = combos.agg(F.min("__lo")).scalar()
    last = combos.agg(F.max("__hi")).scalar()
    return combos.select(F.explode(F.sequence(first, last)).alias(day), *dims)


def fill_days(df: DataFrame, dims: Sequence[str], day: str) -> DataFrame:
    """``df`` with a row for every day between its first and last one in every combination of ``dims``; the other columns are NULL there.

    Expects one row per combination and day. Each row finds the next day of its
    combination in a window and stands for the days up to it, so only the missing days are made and
    nothing is joined. The first row also stands for the days before it, from the first day of all.
    """
    first, last = df.agg(F.min(day)).scalar(), df.agg(F.max(day)).scalar()
    by_day = Window.partitionBy(*dims).orderBy(day)
    rows = df.withColumns({"__head": F.lag(day).over(by_day).isNull(), "__next": F.lead(day).over(by_day)})
    start = F.when(F.col("__head"), first).otherwise(F.col(day))
    end = F.when(F.col("__next").isNull(), last).otherwise(F.date_sub("__next", 1))
    filled = rows.withColumn("__day", F.explode(F.sequence(start, end)))
    own = F.col("__day") == F.col(day)
    return filled.select(*[
        F.col("__day").alias(c) if c == day else F.col(f"`{c}`") if c in dims else F.when(own, F.col(f"`{c}`")).alias(c) for c in df.columns
    ])


def zero_fill(columns: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in columns]


def share_within(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    name: str,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Add ``value`` over its sum across ``keys``; a NULL key has a NULL share.

    For keys without NULLs this equals a sum over the whole window partition, but
    the totals are aggregated before the shuffle and no task holds a whole
    partition. Being unique by key and joined from the left, the totals drop out
    of the plan of a reader that does not use the share. Over large input pass
    ``stage`` as ``keep``: with the size of the totals known, small totals are
    broadcast and the rows are not shuffled at all.
    """
    totals = df.groupBy(*keys).agg(F.sum(value).alias("__total"))
    if keep is not None:
        totals = keep(totals, "totals")
    return df.join(totals, list(keys), "left").withColumn(name, safe_divide(value, "__total")).drop("__total")
