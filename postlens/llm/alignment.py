"""Where the tokens of two tokenizers meet: an Arrow pipeline over token lists, and pair counts merged by Spark."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.batches import text_slices
from postlens.llm.common import staged, take_turn
from postlens.llm.tokens import _PLAIN, _ranks

#: Bytes of text that a task aligns at a time; a longer text is aligned by itself.
SLICE_BYTES = 1_500_000
#: Token lists that a task counts or looks up at a time.
SLICE_PAIRS = 500_000
#: Words of which a worker remembers the ids.
CACHED_WORDS = 300_000
#: Pairs whose counts go to every task, at most; the others are joined.
HOT_PAIRS = 500_000

_ALIGNED = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


class TwoTokenizers:
    """Ids of texts by a byte-level vocabulary (A, of space + text) and by a piece model (B, which adds the space itself).

    No token of either reaches over a space into the word before it: those of A by
    its split, those of B since no piece has a space behind another character (checked
    when loading). So plain words are looked up one by one. Any other text is
    encoded whole by the libraries themselves.
    """

    def __init__(self, bpe: str, pieces: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        ranks = _ranks(bpe)
        self.word_a = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        special = {t: c.content.encode() for t, c in self.a.get_added_tokens_decoder().items()}
        of_a = {k: token for token, k in ranks.items()} | special
        self.bytes_a = [of_a.get(k, b"") for k in range(max(of_a) + 1)]
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(n[3:5], 16)]) if self.b.is_byte(k) else n.replace("▁", " ").encode() for k, n in enumerate(names)]
        self.by_word = not any("▁" in n.lstrip("▁") or "\n" in n for n in names)
        self.space = self.b.piece_to_id("▁")
        #: Ids of a word with the space or line end before it; None if it takes the whole text to tell.
        self.words_a: dict[str, bytes | None] = {}
        self.words_b: dict[str, bytes | None] = {}
        self.size_a, self.size_b = (pa.array([len(x) for x in table], pa.int64()) for table in (self.bytes_a, self.bytes_b))
        self.text_a, self.text_b = (pa.array([str(k) for k in range(len(table))]) for table in (self.bytes_a, self.bytes_b))

    def _same(self, text: bytes, a: list[int], b: list[int]) -> bool:
        return b"".join(map(self.bytes_a.__getitem__, a)) == text == b"".join(map(self.bytes_b.__getitem__, b))

    def _learn(self, words: set[str]) -> None:
        if len(self.words_a) > CACHED_WORDS:
            self.words_a.clear()
            self.words_b.clear()
        for word in words.difference(self.words_a):
            self.words_a[word] = self.words_b[word] = None
            if self.by_word and _PLAIN.fullmatch(word):
                spaced = word if word[0] == "\n" else f" {word}"
                a, b = self.word_a(spaced), self.b.encode(word)
                if word[0] == "\n":
                    b = b[1:] if b[0] == self.space else []
                if self._same(spaced.encode(), a, b):
                    self.words_a[word], self.words_b[word] = array("i", a).tobytes(), array("i", b).tobytes()

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids as 32-bit bytes by A and by B; none where a text is empty or the joined bytes of either aren't space + text."""
        split = [t.replace("\n", " \n").split(" ") if t else [] for t in texts]
        self._learn(set().union(*split))
        known_a, known_b = self.words_a.__getitem__, self.words_b.__getitem__
        out_a, out_b = [], []
        for text, words in zip(texts, split):
            try:
                a, b = b"".join(map(known_a, words)), b"".join(map(known_b, words))
            except TypeError:  # a word that is None
                ids_a, ids_b = self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text)
                a = b = b""
                if self._same(f" {text}".encode(), ids_a, ids_b):
                    a, b = array("i", ids_a).tobytes(), array("i", ids_b).tobytes()
            out_a.append(a)
            out_b.append(b)
        return out_a, out_b


@lru_cache(maxsize=2)
def _tokenizers(bpe: str, pieces: str) -> TwoTokenizers:
    return TwoTokenizers(bpe, pieces)


def tokenizers(bpe: str, pieces: str) -> TwoTokenizers:
    """One for each worker process."""
    take_turn("alignment", _tokenizers.cache_clear)
    return _tokenizers(bpe, pieces)


def _lists(rows: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(r) // 4 for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), dtype=np.int32)))


def _ends(lists: pa.ListArray, sizes: pa.Array, name: str) -> pa.Table:
    """(end, ids): where each token ends in its text, the text's number in the upper half of the key."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int64())
    running = pc.cumulative_sum(sizes.take(ids))
    upto = np.concatenate(([0], running.to_numpy()))
    before = pa.array(upto[lists.offsets.to_numpy()[:-1]])
    end = pc.subtract(running, before.take(doc))
    return pa.table({"end": pc.bit_wise_or(pc.shift_left(doc, 32), end), name: ids})


def _offsets(ends: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate(([0], ends)).astype(np.int32))


def align(a: pa.ListArray, b: pa.ListArray, two: TwoTokenizers) -> tuple[pa.Table, np.ndarray, list[str]]:
    """Links (doc, a, b) of token lists that spell the same texts, how many groups each text has, and the groups as text.

    An outer hash join on (text, end) and a sort give every place where a token ends.
    The bytes between two such places lie in one token of each side, the next to end
    on that side, and no two stretches in the same two tokens; so each row is one link. Rows that both
    sides have end the groups.
    """
    ends = _ends(a, two.size_a, "a").join(_ends(b, two.size_b, "b"), "end", join_type="full outer", use_threads=False)
    ends = ends.take(pc.sort_indices(ends["end"])).combine_chunks()
    has_a, has_b = pc.is_valid(ends["a"]).to_numpy(), pc.is_valid(ends["b"]).to_numpy()
    closes = has_a & has_b
    doc = pc.shift_right(ends["end"], 32)
    groups = np.bincount(doc.to_numpy()[closes], minlength=len(a))
    sides = []
    for lists, has, text in ((a, has_a, two.text_a), (b, has_b, two.text_b)):
        members = pa.ListArray.from_arrays(_offsets(np.cumsum(has)[closes]), text.take(pc.list_flatten(lists)))
        sides.append(pc.binary_join(members, ","))
    joined = pc.binary_join_element_wise(*sides, "|")
    spelled = pc.binary_join(pa.ListArray.from_arrays(_offsets(np.cumsum(groups)), joined), ";")
    links = pa.table({"doc": doc, "a": pc.fill_null_backward(ends["a"]), "b": pc.fill_null_backward(ends["b"])})
    return links, groups, spelled.to_pylist()


def _pairs_of_texts(links: pa.Table, n_docs: int, n_b: int) -> tuple[pa.ListArray, pa.ListArray]:
    """Per text its distinct pairs, a * n_b + b, and how often each is linked there."""
    pair = pc.add(pc.multiply(links["a"].cast(pa.int64()), n_b), links["b"].cast(pa.int64()))
    found = pa.table({"doc": links["doc"], "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    found = found.take(pc.sort_indices(found, sort_keys=[("doc", "ascending"), ("pair", "ascending")])).combine_chunks()
    offsets = _offsets(np.cumsum(np.bincount(found["doc"].to_numpy(), minlength=n_docs)))
    column = {c: found[c].combine_chunks() for c in ("pair", "count_all")}
    return pa.ListArray.from_arrays(offsets, column["pair"]), pa.ListArray.from_arrays(offsets, column["count_all"].cast(pa.int32()))


def _aligned(batches: Iterator[pa.RecordBatch], bpe: str, pieces: str) -> Iterator[pa.RecordBatch]:
    two = tokenizers(bpe, pieces)
    for batch in batches:
        for rows in text_slices(batch, SLICE_BYTES):
            a, b = map(_lists, two.encode(rows["text"].to_pylist()))
            links, groups, spelled = align(a, b, two)
            pairs, times = _pairs_of_texts(links, len(a), len(two.bytes_b))
            yield pa.RecordBatch.from_arrays([
                rows["doc_id"], rows["row"], pc.list_value_length(a).cast(pa.int64()), pc.list_value_length(b).cast(pa.int64()), pa.array(groups),
                pa.array(np.bincount(links["doc"].to_numpy(), minlength=len(a))),
                pa.array([sha256(s.encode()).hexdigest() if s else "" for s in spelled], pa.string()), pairs, times,
            ], names=["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(pc.list_value_length(batch["pairs"]).to_numpy())
    cuts = np.searchsorted(ends, np.arange(SLICE_PAIRS, ends[-1], SLICE_PAIRS)) if len(ends) else []
    for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
        if stop > start:
            yield batch.slice(start, stop - start)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts hold each pair; a text lists a pair once."""
    for batch in batches:
        for rows in _pieces(batch):
            counts = pa.table({"pair": pc.list_flatten(rows["pairs"])}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
            yield from counts.rename_columns(["pair", "n"]).to_batches()


class _Hot:
    """The counts that every task has, to look links up in."""

    def __init__(self, hot: Broadcast) -> None:
        self.hot = hot
        self.table: pa.Table | None = None

    def __getstate__(self) -> dict:
        return {"hot": self.hot, "table": None}

    def look_up(self, rows: pa.RecordBatch) -> pa.Table:
        """(doc, pair, times, n, best) of the links of some texts; n is null for a pair that isn't here."""
        if self.table is None:
            self.table = pa.ipc.open_stream(self.hot.value).read_all()
        flat = pa.table({"doc": pc.list_parent_indices(rows["pairs"]), "pair": pc.list_flatten(rows["pairs"]), "times": pc.list_flatten(rows["times"])})
        return flat.join(self.table, "pair", join_type="left outer", use_threads=False)

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _pieces(batch):
                found = self.look_up(rows)
                found = found.filter(pc.is_valid(found["n"]))
                times = found["times"].cast(pa.int64())
                doc, (best, summed) = found["doc"].to_numpy(), [np.zeros(rows.num_rows, dtype=np.int64) for _ in range(2)]
                np.add.at(best, doc, pc.multiply(times, found["best"].cast(pa.int64())).to_numpy())
                np.add.at(summed, doc, pc.multiply(times, found["n"]).to_numpy())
                kept = [c for c in rows.schema.names if c not in ("pairs", "times")]
                yield pa.RecordBatch.from_arrays([*[rows[c] for c in kept], pa.array(best), pa.array(summed)], names=[*kept, "n_best", "count_sum"])

    def others(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _pieces(batch):
                found = self.look_up(rows)
                found = found.filter(pc.is_null(found["n"]))
                yield from pa.table({"row": rows["row"].take(found["doc"]), "pair": found["pair"], "times": found["times"]}).to_batches()


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): in how many texts two tokens are linked, and whether no pair of the same A token has more."""
    counts = aligned.select("pairs").mapInArrow(_partial_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = staged(counts.withColumn("a", F.floor(F.col("pair") / n_b)), "pair-counts")
    # a row for each token of A at most
    best = F.broadcast(counts.groupBy(F.col("a").alias("__a")).agg(F.max("n").alias("most")))
    return staged(counts.join(best, F.col("a") == F.col("__a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def _hot_from(counts: DataFrame, most: int) -> int:
    """The least power of two that at most so many pairs reach."""
    by_power = sorted(((int(r["power"]), r["count"]) for r in counts.groupBy(F.floor(F.log2("n")).alias("power")).count().collect()), reverse=True)
    held, power = 0, 62
    for at, number in by_power:
        held += number
        if held > most:
            break
        power = at
    return 2 ** power


def align_tokenizers(docs: DataFrame, bpe: str, pieces: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """How the tokens of two tokenizers cover each text.

    ``bpe`` is a byte-level vocabulary (A), applied to a space and the text; ``pieces``
    a piece model (B) that adds the space itself; strings of special tokens are
    plain text. Returns doc_id, n_a, n_b, n_groups (stretches between byte offsets where both end a token),
    n_links (pairs of tokens that share bytes), n_best (links whose pair is in
    as many texts as any pair of the same A token), count_sum (over the
    links, in how many texts of the corpus the pair is linked), groups_sha256 (of the
    groups as ``a1,a2|b1;a3|b2,b3``).

    Null and empty texts, and those that either tokenizer doesn't spell out byte by byte, have no tokens:
    zeros and an empty hash. Each row is a text of its own, also where ids repeat or
    are null. No rows give no rows. Other columns are not read. A task holds the tokens of
    ``SLICE_BYTES`` of text or of one longer text.

    Texts are encoded once; their distinct pairs are staged. Counts are merged by Spark.
    At most ``hot_pairs`` pairs, the most frequent, go to all tasks, so the join of the other
    links meets no pair that is in a large share of the texts.
    """
    spark = docs.sparkSession
    n_b = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    aligned = staged(texts.mapInArrow(lambda batches: _aligned(batches, bpe, pieces), _ALIGNED), "aligned")
    counts = pair_counts(aligned, n_b)
    least = _hot_from(counts, hot_pairs)
    hot = counts.where(F.col("n") >= least).toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, hot.schema) as out:
        out.write_table(hot)
    look = _Hot(spark.sparkContext.broadcast(sink.getvalue().to_pybytes()))
    result = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = aligned.mapInArrow(look.sums, "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
    rare = counts.where(F.col("n") < least)
    if not rare.isEmpty():
        links = aligned.select("row", "pairs", "times").mapInArrow(look.others, "row long, pair long, times int").join(rare, "pair")
        more = links.groupBy(F.col("row").alias("__row")).agg(
            F.sum(F.col("times") * F.col("best").cast("long")).alias("__best"), F.sum(F.col("times") * F.col("n")).alias("__sum"))
        found = (found.join(more, F.col("row") == F.col("__row"), "left")
                 .withColumn("n_best", F.col("n_best") + F.coalesce("__best", F.lit(0)))
                 .withColumn("count_sum", F.col("count_sum") + F.coalesce("__sum", F.lit(0))))
    return found.select("doc_id", *result)
