"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import WORDS, staged, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
#: Hex digits of the seeded hash that name a bucket of a source; one bucket of each source is sorted.
BUCKET_DIGITS = 3


def _with_size(docs: DataFrame, seed: str) -> DataFrame:
    """Columns that start with two underscores are ours, so no column of the input clashes."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return (docs.withColumn("__size", word_count(F.col("text")))
            .withColumn("__order", order)
            .withColumn("__tie", F.xxhash64("text"))
            .withColumn("__bucket", F.substring("__order", 1, BUCKET_DIGITS)))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    The water level is the words that one unit of weight gets. A source is clamped at
    ``max_epochs`` times its size when the level that is left for it and all sources
    which are clamped later reaches that; what it can't take goes to the others by
    weight. Sorted by the level at which each source is clamped, running sums
    say the same as clamping in rounds until none is above. One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.lit(weights[0])
    for k in range(1, len(weights)):
        weight = F.when((F.row_number().over(by_name) - 1) % len(weights) == k, weights[k]).otherwise(weight)
    everything = Window.partitionBy(F.lit(0))
    before_rows = Window.orderBy("__fills_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    t = (sizes.withColumn("__weight", weight.cast("long"))
         .withColumn("__cap", F.col("source_size") * max_epochs)
         .withColumn("__fills_at", F.col("__cap") / F.col("__weight"))
         .withColumn("__budget", F.sum("source_size").over(everything) * F.lit(float(share)))
         .withColumn("__weights", F.sum("__weight").over(everything))
         .withColumn("__level", (F.col("__budget") - F.coalesce(F.sum("__cap").over(before_rows), F.lit(0)))
                     / (F.col("__weights") - F.coalesce(F.sum("__weight").over(before_rows), F.lit(0))))
         .withColumn("__clamped", F.col("__level") >= F.col("__fills_at")))
    level = F.min(F.when(~F.col("__clamped"), F.struct("__fills_at", "__level"))).over(everything)["__level"]
    return t.select("source", "source_size",
                    F.when(F.col("__clamped"), F.col("__cap").cast("double"))
                    .otherwise(F.col("__weight") * level).alias("target"))


def _source_plan(sized: DataFrame, weights: Sequence[int], share: float, max_epochs: int) -> DataFrame:
    """One row per source: whole repetitions of every document, and up to which bucket documents get one more."""
    buckets = sized.groupBy("source", "__bucket").agg(F.sum("__size").alias("__words"))
    sizes = buckets.groupBy("source").agg(F.sum("__words").alias("source_size"))
    targets = source_targets(sizes, weights, share, max_epochs)
    plan = (targets.withColumn("__whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
            .withColumn("__rest", F.round("target").cast("long") - F.col("__whole") * F.col("source_size"))
            .withColumnRenamed("source", "__source"))
    upto = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    crossing = (buckets.withColumn("__end", F.sum("__words").over(upto))
                .join(plan, F.col("source").eqNullSafe(F.col("__source")))
                .where(F.col("__end") > F.col("__rest"))
                .groupBy(F.col("source").alias("__at"))
                .agg(F.min(F.struct("__bucket", (F.col("__end") - F.col("__words")).alias("before"))).alias("__edge")))
    return (plan.join(crossing, F.col("__source").eqNullSafe(F.col("__at")), "left")
            .select("__source", F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), "__whole", "__rest",
                    F.col("__edge.__bucket").alias("__edge_bucket"), F.col("__edge.before").alias("__edge_before")))


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """How many words of each document a mix takes.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share``
    times all words; none gets more than ``max_epochs`` times its size, and the
    excess goes to the others by weight. A source repeats every document as often as
    its target holds the whole source; what is left is taken document by document in
    seeded order, the last one in part, so a source meets its target to the word.

    Returns the columns of ``docs`` and ``__size``, ``__source_size``, ``__target``,
    ``__taken``. Null and empty texts have size 0 and are taken 0 times; a source of
    only such texts has target 0. A null source is a source. Equal rows are counted
    each; which of two equal rows is cut at the edge is not defined. No rows give no
    rows.

    The documents are joined with one row per source, a staged table whose exact size
    Spark knows. Only the one bucket of each source that its target cuts is sorted.
    """
    sized = _with_size(docs, seed)
    plan = staged(_source_plan(sized.select("source", "__bucket", "__size"), weights, share, max_epochs), "source_plan")
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("__source")))
    below = F.col("__edge_bucket").isNull() | (F.col("__bucket") < F.col("__edge_bucket"))
    at_edge = F.coalesce(F.col("__bucket") == F.col("__edge_bucket"), F.lit(False))
    in_order = Window.partitionBy("__source").orderBy("__order", "doc_id", "__size", "__tie")
    whole = joined.where(~at_edge).withColumn("__extra", F.when(below, F.col("__size")).otherwise(0))
    before = F.coalesce(F.sum("__size").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("__edge_before")
    cut = joined.where(at_edge).withColumn("__extra", F.least(F.col("__size"), F.greatest(F.lit(0), F.col("__rest") - before)))
    return whole.unionByName(cut).select(
        *[F.col(f"`{c}`") for c in docs.columns], "__size", "__source_size", "__target",
        (F.col("__whole") * F.col("__size") + F.col("__extra")).cast("long").alias("__taken"))


@F.pandas_udf(T.StringType())
def first_words(texts: pd.Series, counts: pd.Series) -> pd.Series:
    """The text up to the end of its nth word."""
    def cut(text: str, n: int) -> str:
        end = 0
        for k, m in enumerate(WORDS.finditer(text), 1):
            if k > n:
                break
            end = m.end()
        return text[:end]
    return pd.Series([cut(t, n) if t is not None else None for t, n in zip(texts, counts)], dtype=object)


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """The mix itself: each document as often as it is taken, the one at the edge of a source's target in part.

    Columns as in ``docs``; ``n_chars``, where there is one, is that of the part.
    Documents without words carry nothing into a mix and go.
    """
    mixed = mix_sources(docs, **options).where("__taken > 0")
    copies = F.floor(F.col("__taken") / F.col("__size")).cast("int")
    rest = F.col("__taken") % F.col("__size")
    whole = mixed.where(copies > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), copies)))
    part = mixed.where(rest > 0).withColumn("text", first_words("text", rest))
    if "n_chars" in docs.columns:
        part = part.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return whole.select(*names).unionByName(part.select(*names))
