"""Sharding by rendezvous hashing: each record goes to the shard that bids most for its key."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import staged

#: Hex digits of an md5 that make a number; 52 bits, which a double holds exactly.
DIGITS = 13
#: Low bits of Spark's row numbers that count the rows of one task.
ROW_BITS = 33


def record_key(*columns: str) -> Column:
    """The text by which a record is known: its columns as text with their lengths, so no two keys run together.

    A null column is unlike every text, the empty one too.
    """
    def part(name: str) -> Column:
        text = F.col(f"`{name}`").cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.concat_ws(",", *[part(c) for c in columns])


def draw(key: Column, shard: int) -> Column:
    """A number between 0 and 1, both excluded, that key and shard alone decide."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"@{shard}"))), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16 ** DIGITS))


def bid(key: Column, shard: int, weight: float) -> Column:
    """How much a shard bids for a key: the weight over an exponential draw, so the chance to win is in proportion to the weight."""
    return F.lit(float(weight)) / -F.log(draw(key, shard))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest bid, the lower number if two bid alike.

    ``weights[k]`` is the weight of shard k; 0 closes a shard without renumbering
    the others. A shard's bid depends on nothing but key, number and weight. So a
    new shard, or more weight for one, moves records into that shard alone, and a
    closed one moves only its own records.
    """
    if not any(w > 0 for w in weights) or any(w < 0 or not math.isfinite(w) for w in weights):
        raise ValueError("weights are finite and not negative, and one at least is above 0")
    bids = [F.struct(bid(key, k, w).alias("bid"), F.lit(-k).alias("number")) for k, w in enumerate(weights) if w > 0]
    best = F.greatest(*bids) if len(bids) > 1 else bids[0]
    return -best["number"]


def assign_shards(df: DataFrame, key: Sequence[str], weights: Sequence[float], grown: Sequence[float] | None = None) -> DataFrame:
    """``df`` with ``__shard`` and, where ``grown`` weights are given, ``__grown_shard``, the shard under those.

    Row by row, without a shuffle. Rows of equal key share a shard, so a key that
    holds a third of all rows brings them all into one; the number of shards doesn't
    change that, and no task but the reader of that shard sees it. Null keys are a
    key like any other. Texts are not looked at unless they are the key. No rows
    give no rows; columns that start with two underscores are ours.
    """
    name = record_key(*key)
    out = df.withColumn("__shard", shard_of(name, weights).cast("int"))
    return out if grown is None else out.withColumn("__grown_shard", shard_of(name, grown).cast("int"))


def number_slots(df: DataFrame, shard: str, order: Sequence[Column]) -> DataFrame:
    """``df`` with ``__slot``: 0, 1, ... without a gap in each shard, in the given order.

    Rows are dealt by ranges of (shard, order, row), the row being a number that each
    has from a staged table, so a range is cut inside a shard, and inside rows that are equal in
    every column, as easily as between them: no task holds a whole shard. What
    is numbered is the place in the written ranges; one row for each range and
    shard says where its numbers start. Staged tables make the numbers those of
    one writing, whatever is read again later.
    """
    rows = staged(df.withColumn("__row", F.monotonically_increasing_id()), "shard-rows")
    place = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange(F.col(shard), *order, F.col("__row")).sortWithinPartitions(F.col(shard), *order, F.col("__row"))
    laid = staged(ranged.withColumn("__range", F.shiftright(place, ROW_BITS)).withColumn("__place", place.bitwiseAND(2**ROW_BITS - 1)), "shard-slots")
    starts = laid.groupBy(F.col(shard).alias("__of"), F.col("__range").alias("__in")).agg(F.min("__place").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("__of").orderBy("__in").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(starts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"), "shard-starts")
    found = laid.join(starts, F.col(shard).eqNullSafe(F.col("__of")) & (F.col("__range") == F.col("__in")))
    return found.withColumn("__slot", F.col("__place") - F.col("__first") + F.col("__before")).drop(
        "__row", "__range", "__place", "__of", "__in", "__first", "__before")


def write_shards(df: DataFrame, path: str, key: Sequence[str], weights: Sequence[float]) -> None:
    """Write ``df`` as one folder per shard, ``shard=0`` and so on; a large shard becomes several files."""
    if "shard" in df.columns:
        raise ValueError("a column named shard is in the way of the folders")
    out = assign_shards(df, key, weights).withColumnRenamed("__shard", "shard")
    out.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document, by its id alone.

    Shards weigh alike; ``grown_shard`` is the shard among one more. size is the
    number of UTF-8 bytes of the text plus 1; a null text has no bytes. The slot
    follows a hash of the id, then id, crc32 and size, so it doesn't depend on how
    files lie. Rows that repeat an id share the shard and have a slot each.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = assign_shards(docs, ["doc_id"], [1.0] * shards, [1.0] * (shards + 1)).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"), F.col("__shard").alias("shard"), F.col("__grown_shard").alias("grown_shard"))
    order = [draw(record_key("doc_id"), -1), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return number_slots(narrow, "shard", order).withColumnRenamed("__slot", "slot")
