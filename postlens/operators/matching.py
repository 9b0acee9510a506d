"""Substring-key join: which links contain which keys.

A key matches a link when ``link LIKE '%key%'``; ``_`` and ``%`` inside a key
stay wildcards. Spark can only run that predicate as a nested loop, so it is
turned into an equi-join here: every link that matches must contain the key's
longest run without wildcards. A few characters of that run (its gram), those that a sample of
the links has least, are joined with the links' substrings of the same length, and
LIKE decides. Both sides join on a 64-bit hash, which Spark probes much faster than text; a
hash hit only counts where the gram itself stands in the link.

Some keys have no rare gram: those of a letter or two, or of wildcards only. Where
such a gram is joined by a shuffle, its links are dealt to as many blocks as it takes
for none to be larger than an even share, and its keys are repeated in each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.operators.filters import likely_in

# A gram has the longest of these lengths that fits its run. Few lengths keep the
# number of substrings per link low; 0 serves keys made of wildcards only.
GRAM_SIZES = (32, 16, 8, 4, 2, 1, 0)

# Largest key table that is sent to every executor, and what a row takes there beside its texts.
BROADCAST_KEY_BYTES = 64 * 1024 * 1024
HASHED_ROW_BYTES = 64

# How often grams occur is measured in a sample of so many links; it shapes the work, not the result. Grams in a
# larger share of them are common; there are few, since a link has few grams, and at most so many are remembered.
SAMPLE_LINKS, COMMON_SHARE, COMMON_GRAMS = 50_000, 0.001, 65_536


def _longest_run(key: Column) -> Column:
    runs = F.split(key, r"[%_\\]")
    return F.reduce(runs, F.lit(""), lambda best, run: F.when(F.length(run) > F.length(best), run).otherwise(best))


def _with_run(keys: DataFrame) -> DataFrame:
    """Add the LIKE pattern of each key, its run and the length of its gram.

    A backslash makes the next character literal; LIKE only takes it before a
    wildcard or another backslash, so it is dropped elsewhere.
    """
    run = F.length("__run")
    anywhere = F.concat(F.lit("%"), F.col("key"), F.lit("%"))
    return (
        keys.withColumn("__run", _longest_run(F.col("key")))
        .withColumn("__size", F.coalesce(*[F.when(run >= n, F.lit(n)) for n in GRAM_SIZES]))
        .withColumn("__pattern", F.regexp_replace(anywhere, r"(\\[_%\\])|\\", "$1"))
    )


def _common_grams(links: DataFrame, sizes: list[int]) -> DataFrame | None:
    """(__hash, __share): grams that stand in many links, and in which share of them; at most ``COMMON_GRAMS`` rows, of 16 bytes each. None if there are none."""
    total = links.count()
    sample = links if total <= SAMPLE_LINKS else links.sample(SAMPLE_LINKS / total, seed=7)
    taken = max(1, min(total, SAMPLE_LINKS))
    counts = sample.select(F.explode(_hashes(sizes)).alias("__hash")).groupBy("__hash").count()
    common = counts.where(F.col("count") >= max(2, COMMON_SHARE * taken)).orderBy(F.desc("count"), "__hash").limit(COMMON_GRAMS)
    rows = [(r["__hash"], min(1.0, r["count"] / taken)) for r in common.collect()]
    return links.sparkSession.createDataFrame(rows, "__hash long, __share double") if rows else None


def _with_gram(runs: DataFrame, common: DataFrame | None) -> DataFrame:
    """Add each key's gram, the one of its run that stands in the smallest share of the links, and that share."""
    last = F.length("__run") - F.col("__size") + 1
    if common is None:
        one = runs.withColumn("__gram", F.right(F.col("__run"), F.col("__size")))
        return one.withColumns({"__hash": F.xxhash64("__gram"), "__share": F.lit(0.0)}).drop("__run")
    each = (
        runs.withColumn("__from", F.explode(F.sequence(F.lit(1), F.when(F.col("__size") > 0, last).otherwise(1))))
        .withColumn("__gram", F.substring(F.col("__run"), F.col("__from"), F.col("__size")))
        .withColumn("__hash", F.xxhash64("__gram"))
        .join(F.broadcast(common), "__hash", "left")
        .withColumn("__share", F.coalesce("__share", F.lit(0.0)))
    )
    best = F.min(F.struct("__share", (-F.col("__from")).alias("__at"), "__gram", "__hash")).alias("__best")
    return each.groupBy("key", "__size", "__pattern").agg(best).select("key", "__size", "__pattern", "__best.__gram", "__best.__hash", "__best.__share")


def link_pairs(
    posts: DataFrame,
    keys: DataFrame,
    link: str = "source_link",
    post: str = "post_id",
    broadcast_bytes: int = BROADCAST_KEY_BYTES,
) -> DataFrame:
    """All (key, post) with ``link LIKE '%key%'``, each once per post row.

    ``keys`` holds distinct non-null values in a column ``key``. The key table is
    measured first: up to ``broadcast_bytes`` it is broadcast and the links are
    never shuffled. A larger one is joined by a shuffle in which only the post id and
    a hash travel for each substring, and only hashes that some key has; the
    links come back for the few that hit, and LIKE decides there.
    """
    runs = _with_run(keys.where(F.col("key").isNotNull()).select("key"))
    # One row comes back: a byte count, a number and at most len(GRAM_SIZES) more.
    measured = runs.agg(
        F.sum(HASHED_ROW_BYTES + F.octet_length("key") + F.octet_length("__pattern") + F.col("__size")).alias("size"),
        F.max(F.length("__run") - F.col("__size")).alias("choice"),
        F.collect_set("__size").alias("sizes"),
    ).first()
    sizes = sorted(measured["sizes"]) or [0]
    links = posts.where(F.col(link).isNotNull()).select(F.col(post).alias("post_id"), F.col(link).alias("__link"))
    small = (measured["size"] or 0) <= broadcast_bytes
    # nothing to choose, and nothing to deal out
    common = None if small and not measured["choice"] else _common_grams(links, sizes)
    grams = _with_gram(runs, common)
    return _probe(links, F.broadcast(grams), sizes) if small else _shuffled(links, grams, sizes)


def _starts(sizes: list[int]) -> Column:
    """Places at which a substring of one of these lengths starts."""
    return F.sequence(F.lit(1), F.greatest(F.length("__link") - max(sizes[0], 1) + 1, F.lit(1)))


def _hashes(sizes: list[int]) -> Column:
    """The different substrings of a link that have one of these lengths, as hashes."""
    return F.array_distinct(F.flatten(F.transform(_starts(sizes), lambda at: F.filter(F.array(*[
        F.when(at + n - 1 <= F.length("__link"), F.xxhash64(F.substring(F.col("__link"), at, F.lit(n)))) for n in sizes
    ]), lambda h: h.isNotNull()))))


def _probe(links: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    text, at, size = F.col("__link"), F.col("__at"), F.col("__n")
    pieces = (
        links.withColumn("__at", F.explode(_starts(sizes)))
        .withColumn("__n", F.explode(F.array(*[F.lit(n) for n in sizes])))
        .where(((size > 0) & (at + size - 1 <= F.length(text))) | ((size == 0) & (at == 1)))
        .select("post_id", "__link", "__at", F.xxhash64(F.substring(text, at, size)).alias("__hash"))
    )
    # True where the gram stands in the link, and only at its first place there.
    first_place = F.expr("__size = 0 or locate(__gram, __link) = __at")
    return pieces.join(grams, "__hash").where(first_place & F.expr("__link like __pattern")).select("key", "post_id")


def _in_blocks(pieces: DataFrame, grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a block number: links of a common gram are dealt to blocks, its keys repeated in each.

    A gram in a share of the links gets that share of the shuffle's partitions as blocks, so
    a block has about an even share of the links at most.
    """
    spark = grams.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # common grams that a key had to take, COMMON_GRAMS at most
    common = grams.where(F.col("__share") > 0).select("__hash", "__share").distinct().collect()
    blocks = [(r["__hash"], n) for r in common if (n := math.ceil(r["__share"] * width)) > 1]
    probes = grams.select("__hash", "key", "__pattern")
    if not blocks:
        return pieces.withColumn("__block", F.lit(0).cast("long")), probes.withColumn("__block", F.lit(0).cast("long"))
    table = F.broadcast(spark.createDataFrame(blocks, "__hash long, __blocks long"))
    count = F.coalesce("__blocks", F.lit(1).cast("long"))
    dealt = pieces.join(table, "__hash", "left").withColumn("__block", F.pmod(F.xxhash64("__row"), count)).drop("__blocks")
    repeated = probes.join(table, "__hash", "left").withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), count - 1))).drop("__blocks")
    return dealt, repeated


def _shuffled(links: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """Rows with the same id and link are one until the end."""
    rows = links.groupBy("post_id", "__link").agg(F.count("*").alias("__rows"))
    rows = rows.withColumn("__row", F.xxhash64("post_id", F.col("post_id").isNull(), "__link"))
    pieces = likely_in(rows.select("__row", F.explode(_hashes(sizes)).alias("__hash")), "__hash", grams.select("__hash"))
    pieces, probes = _in_blocks(pieces, grams)
    hits = pieces.join(probes, ["__hash", "__block"]).select("__row", "key", "__pattern").distinct()
    found = hits.join(rows, "__row").where(F.expr("__link like __pattern"))
    return found.select("key", "post_id", F.explode(F.sequence(F.lit(1), F.col("__rows").cast("int")))).select("key", "post_id")
