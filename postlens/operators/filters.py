"""A filter of fixed size in front of a join that would deal many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of the filter that goes to all executors, 4 MB.
FILTER_BITS = 2**25


def likely_in(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose id is in the one column of ``ids``, and few others; null ids stay.

    Ids are whole numbers. The filter has a fixed size, at most 1,024 bitmaps of
    4 KB; with very many ids it lets more rows pass, never fewer.
    """
    return split_likely(df, column, ids)[0]


def split_likely(df: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows as in ``likely_in``, and the others, whose id is surely not in ``ids``."""
    def bit(c: Column) -> Column:
        return F.pmod(F.xxhash64(c.cast("long")), F.lit(FILTER_BITS)) + 1

    name = ids.columns[0]
    bitmaps = (
        ids.where(F.col(name).isNotNull())
        .select(bit(F.col(name)).alias("__bit"))
        .groupBy(F.bitmap_bucket_number("__bit").alias("__bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__bit")).alias("__bits"))
    )
    key = bit(F.col(column))
    place = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    marked = (
        df.join(F.broadcast(bitmaps), F.bitmap_bucket_number(key) == F.col("__bucket"), "left")
        .withColumn("__byte", byte.cast("int"))
        .withColumn("__place", (place % 8).cast("int"))
    )
    inside = F.coalesce(F.expr("shiftright(__byte, __place) & 1") == 1, F.lit(False)) | F.col(column).isNull()
    ours = ["__bucket", "__bits", "__byte", "__place"]
    return marked.where(inside).drop(*ours), marked.where(~inside).drop(*ours)
