"""How far the sources of a language use different words: exact divergences from counts made by Arrow's kernels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.batches import text_slices
from postlens.llm.common import staged

#: What stands between terms: ASCII other than letters.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 3
#: A share of 1 in the fixed-point numbers that all arithmetic uses.
UNIT = 10**9
TOP_TERMS = 200
#: Bytes of text that are split at a time; a longer text is split by itself.
SLICE_BYTES = 4_000_000
#: Rows of partial counts that a task holds before it passes them on.
PENDING_ROWS = 250_000
#: Numbers in the matrix of a shard, terms times sources, and pairs of sources in one result.
CELLS, PAIRS = 400_000, 250_000

_COUNTS = "lang string, source string, term string, n long, docs long"


def _sums(counts: pa.Table) -> pa.Table:
    keys = ["lang", "source", "term"]
    summed = counts.group_by(keys, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return summed.select([*keys, "n_sum", "docs_sum"]).rename_columns([*keys, "n", "docs"])


def _counted(rows: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of each term in each (lang, source), and a row without a term for each of those."""
    words = pc.split_pattern_regex(pc.ascii_lower(rows["text"]), SEPARATORS)
    flat, doc = pc.list_flatten(words), pc.list_parent_indices(words)
    real = pc.not_equal(flat, "")
    terms = flat.filter(real).dictionary_encode()
    lang, source = rows["lang"].dictionary_encode(), rows["source"].dictionary_encode()
    in_doc = pa.table({"doc": doc.filter(real), "term": terms.indices}).group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    by_group = pa.table({
        "lang": lang.indices.take(in_doc["doc"]), "source": source.indices.take(in_doc["doc"]),
        "term": in_doc["term"], "n": in_doc["count_all"],
    }).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    found = pa.table({
        "lang": lang.dictionary.take(by_group["lang"]), "source": source.dictionary.take(by_group["source"]),
        "term": terms.dictionary.take(by_group["term"]), "n": by_group["n_sum"], "docs": by_group["n_count"],
    })
    groups = pa.table({"lang": rows["lang"], "source": rows["source"]}).group_by(["lang", "source"], use_threads=False).aggregate([])
    nothing = pa.array(np.zeros(len(groups), dtype=np.int64))
    present = pa.table({"lang": groups["lang"], "source": groups["source"], "term": pa.nulls(len(groups), found["term"].type), "n": nothing, "docs": nothing})
    return pa.concat_tables([found, present])


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pending: list[pa.Table] = []
    for batch in batches:
        for rows in text_slices(batch, SLICE_BYTES):
            pending.append(_counted(rows))
            if sum(map(len, pending)) > PENDING_ROWS:
                pending = [_sums(pa.concat_tables(pending))]
                if len(pending[0]) > PENDING_ROWS // 2:
                    yield from pending.pop().to_batches()
    if pending:
        yield from _sums(pa.concat_tables(pending)).to_batches()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term and documents that hold it.

    Each (lang, source) has a row with a null term besides. Null text, lang or
    source is the empty text. A row is a document, also one that repeats an id.
    """
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    return texts.mapInArrow(_partial_counts, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, totals: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / (total + terms)), exactly: nine decimal digits, three at a time.

    The counts of one column add up to at most its total, so a quotient is below 1 but for a single kept term.
    """
    below = np.asarray(totals, dtype=np.int64) + terms
    if below.max(initial=1) > 2**63 // 1000:
        raise OverflowError("more than 9.2e15 words in a group")
    whole, rest = np.divmod(counts + 1, below)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, below)
        whole = whole * 1000 + digits
    return whole + 1


def _diverge(counts: pa.Table, groups: pa.Table) -> pa.Table:
    """The part of one shard of terms: summed values for pairs of sources, and the first terms of each source."""
    lang, block, terms = groups["lang"][0].as_py(), groups["block"][0].as_py(), groups["terms"][0].as_py()
    sources, totals = groups["source"].combine_chunks(), groups["n"].to_numpy()
    mine = np.flatnonzero(groups["own_block"].to_numpy() == block)
    coded = counts["term"].combine_chunks().dictionary_encode()
    words = coded.dictionary
    n = np.zeros((len(words), len(sources)), dtype=np.int64)
    if len(words):
        n[coded.indices.to_numpy(), pc.index_in(counts["source"].combine_chunks(), sources).to_numpy()] = counts["n"].to_numpy()
        p, q = shares(n, totals, terms), shares(n.sum(axis=1), int(totals.sum()), terms)
    out = []
    for a in mine:
        others = np.delete(np.arange(len(sources)), a)
        value = np.zeros(len(others), dtype=np.int64)
        if len(words):
            apart = p[:, [a]] - p[:, others]
            value = (apart * apart // p[:, others]).sum(axis=0)
            ahead = np.flatnonzero((n[:, a] > 0) & (p[:, a] > q))
            more = p[ahead, a] - q[ahead]
            found = pa.table({"item": words.take(pa.array(ahead)), "value": more * more // q[ahead]})
            best = pc.sort_indices(found, sort_keys=[("value", "descending"), ("item", "ascending")])[:TOP_TERMS]
            out.append(_rows(lang, sources[a].as_py(), "term", found.take(best)))
        out.append(_rows(lang, sources[a].as_py(), "pair", pa.table({"item": sources.take(pa.array(others)), "value": value})))
    return pa.concat_tables(out) if out else _rows(lang, "", "", pa.table({"item": pa.array([], pa.string()), "value": pa.array([], pa.int64())}))


def _rows(lang: str, source: str, part: str, found: pa.Table) -> pa.Table:
    named = [pa.array([text] * len(found), pa.string()) for text in (lang, source, part)]
    return pa.table([*named, found["item"].cast(pa.string()), found["value"]], names=["lang", "source", "part", "item", "value"])


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source of a language departs from the others and from the whole.

    A language keeps the terms that at least ``min_docs`` of its documents hold. Of a
    kept term, a source has the share p, the language the share q (``shares``, with one
    count added to each term). Part ``pair`` sums (p - q)^2 / q, rounded down, over all kept terms
    for each other source's q. Part ``term`` gives the terms that a source has
    more of than its language, the first 200 by that value. Ranks go by value, then by the item's
    bytes.

    Whole numbers only, so results don't depend on how work is dealt. Sources without terms, and
    languages that keep none, have their pairs, with value 0 for the latter; a language's only
    source has none. Null text, lang and source are the empty text. No rows give no rows.

    Texts are read once; tasks send one row for each (lang, source, term). The terms of a language are
    dealt to as many shards as keep terms times sources of a shard small, and sources to blocks where
    their pairs are many, so neither a hot language nor a hot source is ever gathered.
    """
    counts = staged(term_counts(docs), "term-counts")
    of_term = Window.partitionBy("lang", "term")
    kept = staged(
        counts.where("term IS NOT NULL").withColumn("in_docs", F.sum("docs").over(of_term))
        .withColumn("first", F.row_number().over(of_term.orderBy("source")) == 1)
        .where(F.col("in_docs") >= min_docs).select("lang", "source", "term", "n", "first"), "kept-terms")
    totals = kept.groupBy(F.col("lang").alias("__lang"), F.col("source").alias("__source")).agg(F.sum("n").alias("n"))
    groups = staged(
        counts.where("term IS NULL").select("lang", "source")
        .join(totals, (F.col("lang") == F.col("__lang")) & (F.col("source") == F.col("__source")), "left")
        .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")), "groups")
    terms = kept.where("first").groupBy(F.col("lang").alias("__lang")).agg(F.count("*").alias("terms"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    langs = staged(
        sources.join(terms, F.col("lang") == F.col("__lang"), "left")
        .select("lang", F.coalesce("terms", F.lit(0)).alias("terms"), "sources")
        .withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("sources") / CELLS)))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("sources") * F.col("sources") / PAIRS))), "languages")

    def spread(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(name) - 1))

    dealt = (kept.join(langs, "lang").withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards"))).withColumn("block", spread("blocks"))
             .select("lang", "shard", "block", "source", "term", "n"))
    each = (groups.join(langs, "lang").withColumn("own_block", F.pmod(F.xxhash64("source"), F.col("blocks")))
            .withColumn("shard", spread("shards")).withColumn("block", spread("blocks"))
            .select("lang", "shard", "block", "source", "n", "terms", "own_block"))
    keys = ["lang", "shard", "block"]
    parts = dealt.groupBy(*keys).cogroup(each.groupBy(*keys)).applyInArrow(_diverge, "lang string, source string, part string, item string, value long")
    whole = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranks = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    return whole.withColumn("rank", F.row_number().over(ranks)).where((F.col("part") == "pair") | (F.col("rank") <= TOP_TERMS))
