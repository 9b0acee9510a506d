"""Snapshot series: keep the newest record, compare with the previous one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def keep_latest(df: DataFrame, keys: Sequence[str], newest: str, ties: bool = True, whole: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the greatest ``newest``.

    Among ties the row with the fewest NULLs in ``whole`` wins, so a record that was sent
    again with a hole never replaces the whole one. What is left falls to the other columns in
    turn, least first and NULL last, so only rows that are equal throughout are interchangeable
    and a re-run task picks the same one; pass ``ties=False`` where (keys, newest) is unique. Spark
    keeps the best row of each key before the shuffle too, so many copies of one key do not travel.
    """
    order = [F.col(newest).desc_nulls_last()]
    if ties:
        if whole:
            order.append(reduce(add, [F.col(c).isNull().cast("int") for c in whole]).asc())
        order += [F.col(c).asc_nulls_last() for c in df.columns if c not in {*keys, newest}]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def with_deltas(df: DataFrame, key: str, day: str, counters: Sequence[str]) -> DataFrame:
    """Add the previous day and ``<counter>_delta`` against the previous snapshot.

    Expects one row per (key, day); the first row of a key has NULL deltas. All
    lags share one window, hence one shuffle and one sort.
    """
    window = Window.partitionBy(key).orderBy(day)
    previous = F.lag(day).over(window)
    deltas = {f"{c}_delta": F.col(c) - F.lag(c).over(window) for c in counters}
    return df.withColumns({f"prev_{day}": previous, **deltas})
