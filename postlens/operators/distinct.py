"""Distinct counts that add up: exact, from bitmaps over numbered values."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Low bits of Spark's row numbers that count the rows of one task.
_ROW_BITS = 33


def numbered(df: DataFrame, value: str, near: str, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """(value, number): the distinct values of a column, NULL left out, numbered from 1 without a gap.

    Values are in the order of their least ``near``, a day for instance, so those of one day
    have numbers next to each other and their bitmaps are few and full. A sort by
    ranges deals them out; a number is the place in the written range plus what lies in the ranges before,
    one row each.
    """
    at = F.monotonically_increasing_id()
    found = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.min(near).alias("__near"))
    placed = keep(found.orderBy("__near", "value").select("value", F.shiftright(at, _ROW_BITS).alias("__range"),
                                                           at.bitwiseAND(2**_ROW_BITS - 1).alias("__place")), "numbered")
    sizes = placed.groupBy(F.col("__range").alias("__of")).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = keep(sizes.select("__of", before.alias("__before")), "ranges")
    return placed.join(starts, F.col("__range") == F.col("__of")).select("value", (F.col("__before") + F.col("__place") + 1).alias("number"))


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], value: str, numbers: DataFrame) -> DataFrame:
    """(keys, bucket, bits): which values each key has, as bitmaps of 4 KB over the numbers.

    A NULL value counts for nothing, but its key stays, with a NULL bucket.
    """
    of = numbers.select(F.col("value").alias("__value"), F.col("number").alias("__number"))
    joined = df.select(*keys, F.col(value).alias("__own")).join(of, F.col("__own") == F.col("__value"), "left")
    bucket = F.when(F.col("__number").isNotNull(), F.bitmap_bucket_number("__number")).alias("bucket")
    return joined.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("__number")).alias("bits"))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many different values each of fewer keys has, from bitmaps of more keys."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits")).otherwise(0)).alias(name))
