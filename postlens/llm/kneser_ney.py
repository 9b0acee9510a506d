"""An interpolated modified Kneser-Ney model of words, counted in Spark and mapped into memory by workers."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import shuffle_width, staged
from postlens.llm.wordhash import chunks, hash_words, mix
from postlens.sources import checkpoint_folder

#: The hash of the token that ends each text; no word has it but by 64-bit chance.
END = np.uint64(0x8F1BBCDCBFA53E0B)
#: Tokens that a task counts before it sorts and sends them.
BUFFER = 2_000_000
#: Numbers of this or more lie in an array of their own.
LARGE = 255
#: Entries of a table that share a bucket, on average.
BUCKET = 8
_ID = np.uint64(32)
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ---- sorted arrays as bytes


def _pack(values: np.ndarray) -> bytes:
    """Ascending numbers, or counts, by the planes of their bytes; differences of sorted ids have few that aren't 0."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.compress(planes.tobytes(), 1)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def _sum_by_key(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=int)
    return keys[first], *(np.add.reduceat(c[order], first) if len(keys) else c for c in counts)


# ---- the files of a model


def _folder(spark: SparkSession, folder: str | None) -> str:
    """A new folder for a model; workers open its files, so it must be mounted on every machine."""
    place = urlparse(folder or checkpoint_folder(spark))
    # without a scheme Spark takes a path for one of its default file system
    if (place.scheme or urlparse(spark._jsc.hadoopConfiguration().get("fs.defaultFS")).scheme) not in ("", "file"):
        raise ValueError("a model is memory-mapped: name a folder that every machine mounts, not an object store")
    path = os.path.join(place.path, f"kneser-ney-{uuid.uuid4().hex}")
    os.makedirs(path)
    return path


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Whole or not at all; a task that runs again writes the same."""
    part = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    with open(part, "wb") as file:
        np.save(file, array)
    os.replace(part, os.path.join(folder, f"{name}.npy"))


@lru_cache(maxsize=8192)
def _array(folder: str, name: str) -> np.ndarray:
    return np.load(os.path.join(folder, f"{name}.npy"), mmap_mode="r")


def _shard_of_hash(h: np.ndarray, shards: int) -> np.ndarray:
    """By ranges of the hash, so that ids follow the order of hashes."""
    return ((h >> _ID) * np.uint64(shards) >> _ID).astype(np.int64)


def _save_table(folder: str, name: str, hashes: np.ndarray, values: np.ndarray) -> None:
    """Rows of numbers by a hash, sorted by it.

    The upper bits of a hash are its bucket, whose start is kept; the next 32 are kept
    themselves. Rows of small numbers take a byte for each, others lie apart in 64 bits.
    """
    bits = max(0, (len(hashes) // BUCKET).bit_length())
    order = np.argsort(hashes)
    hashes, values = hashes[order], values[order]
    starts = np.searchsorted(_bucket(hashes, bits), np.arange(2**bits + 1))
    big = np.flatnonzero((values >= LARGE).any(axis=1))
    _save(folder, f"{name}-starts", starts.astype(np.uint32 if len(hashes) < 2**32 else np.uint64))
    _save(folder, f"{name}-hashes", _within(hashes, bits))
    _save(folder, f"{name}-values", np.minimum(values, LARGE).astype(np.uint8))
    _save(folder, f"{name}-big", np.column_stack([big, values[big]]).astype(np.int64))


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), dtype=np.int64)


def _within(hashes: np.ndarray, bits: int) -> np.ndarray:
    return ((hashes << np.uint64(bits)) >> _ID).astype(np.uint32)


def _look_up(folder: str, name: str, hashes: np.ndarray, width: int) -> np.ndarray:
    """The rows of these hashes; zeros for those that the table doesn't have."""
    if not os.path.exists(os.path.join(folder, f"{name}-big.npy")):  # written last
        return np.zeros((len(hashes), width), dtype=np.int64)
    starts, kept = _array(folder, f"{name}-starts"), _array(folder, f"{name}-hashes")
    bits = (len(starts) - 1).bit_length() - 1
    bucket, want = _bucket(hashes, bits), _within(hashes, bits)
    low, end = starts[bucket].astype(np.int64), starts[bucket + 1].astype(np.int64)
    high = end.copy()
    while (low < high).any():  # a binary search in all buckets at once
        middle = (low + high) // 2
        less = (low < high) & (kept[np.minimum(middle, len(kept) - 1)] < want)
        low, high = np.where(less, middle + 1, low), np.where(less, high, np.minimum(middle, high))
    at = np.minimum(low, len(kept) - 1)
    found = (low < end) & (kept[at] == want)
    out = np.where(found[:, None], _array(folder, f"{name}-values")[at], 0).astype(np.int64)
    large = np.flatnonzero((out == LARGE).any(axis=1))
    if len(large):
        big = _array(folder, f"{name}-big")
        out[large] = big[np.searchsorted(big[:, 0], at[large]), 1:]
    return out


def _look_up_shards(folder: str, name: str, hashes: np.ndarray, shard: np.ndarray, shards: int, width: int) -> np.ndarray:
    out = np.zeros((len(hashes), width), dtype=np.int64)
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    for k in np.flatnonzero(np.diff(bounds)):
        here = order[bounds[k]:bounds[k + 1]]
        out[here] = _look_up(folder, f"{name}-{k}", hashes[here], width)
    return out


@dataclass(frozen=True)
class Vocabulary:
    folder: str
    shards: int
    #: The first id of each shard, and how many there are in all.
    first: tuple[int, ...]
    size: int
    tokens: int
    #: The ids of words (the start is one) that have more than a shard's share of all tokens, ascending,
    #: and to how many parts their triples are dealt; at most as many as there are shards.
    hot: tuple[int, ...] = ()
    parts: tuple[int, ...] = ()

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of these words."""
        distinct, at = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(distinct), -1, dtype=np.int64), np.zeros(len(distinct), dtype=np.int64)
        bounds = np.searchsorted(_shard_of_hash(distinct, self.shards), np.arange(self.shards + 1))
        for k in np.flatnonzero(np.diff(bounds)):
            here = slice(bounds[k], bounds[k + 1])
            known = _array(self.folder, f"words-{k}") if self._has(k) else np.zeros(0, dtype=np.uint64)
            if not len(known):
                continue
            place = np.minimum(np.searchsorted(known, distinct[here]), len(known) - 1)
            found = known[place] == distinct[here]
            ids[here] = np.where(found, place + self.first[k], -1)
            counts[here] = np.where(found, _array(self.folder, f"counts-{k}")[place], 0)
        return ids[at], counts[at]

    def _has(self, shard: int) -> bool:
        return (self.first[shard + 1] if shard + 1 < self.shards else self.size) > self.first[shard]


@dataclass(frozen=True)
class Discounts:
    """What is taken off counts of one, two, and three or more."""

    values: tuple[float, float, float, float]

    @staticmethod
    def of(n: list[int]) -> Discounts:
        """From how many have a count of 1, 2, 3 and 4; where these don't tell, three quarters. Never nothing."""
        out, y = [0.0], n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
        for k in (1, 2, 3):
            told = n[k - 1] and n[k] and y
            out.append(min(float(k), max(0.05, k - (k + 1) * y * n[k] / n[k - 1])) if told else 0.75)
        return Discounts(tuple(out))

    def off(self, counts: np.ndarray) -> np.ndarray:
        return np.array(self.values)[np.minimum(counts, 3)]


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    pairs: Discounts
    words: Discounts
    #: Distinct pairs, and of how many words that follow 1, 2, 3 or more different ones.
    distinct_pairs: int
    followed: tuple[int, int, int]
    #: Of the highest order, in a model of order three.
    triples: Discounts | None = None

    def word_chances(self, ids: np.ndarray) -> np.ndarray:
        """The lower order: by how many different words a word follows, over all words and one unknown one."""
        v = self.vocabulary
        unknown = 1 / (v.size + 1)
        if not self.distinct_pairs:
            return np.full(len(ids), unknown)
        kept = sum(d * n for d, n in zip(self.words.values[1:], self.followed)) / self.distinct_pairs
        after = _dense(v, "after", ids)[:, 0]
        return np.maximum(after - self.words.off(after), 0) / self.distinct_pairs + kept * unknown

    def pair_chances(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """By the word before; in a model of order three a pair counts as often as different words come before it."""
        lower = self.word_chances(ids)
        if not self.distinct_pairs:
            return lower
        return _interpolated(self.pairs, _pair_counts(self.vocabulary, before, ids), _dense(self.vocabulary, "before", before), lower)

    def chances(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """P(word | the words before) for all tokens of some texts; -1 stands for unknown words."""
        before = _before(ids, ends, self.vocabulary.size)
        lower = self.pair_chances(before, ids)
        if self.triples is None or not self.distinct_pairs:
            return lower
        counts, contexts = _triple_counts(self.vocabulary, _before(before, ends, self.vocabulary.size), before, ids)
        return _interpolated(self.triples, counts, contexts, lower)


def _interpolated(discounts: Discounts, counts: np.ndarray, contexts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """What is taken off the counts of a context goes to the lower order; a context never seen leaves all to it."""
    total, n1, n2, n3 = contexts.T
    taken = discounts.values[1] * n1 + discounts.values[2] * n2 + discounts.values[3] * n3
    own = np.maximum(counts - discounts.off(counts), 0)
    return np.where(total > 0, (own + taken * lower) / np.maximum(total, 1), lower)


def _dense(v: Vocabulary, name: str, ids: np.ndarray) -> np.ndarray:
    """Rows of the table ``name``, one for each id; zeros for unknown ones."""
    width = 4 if name == "before" else 1
    out = np.zeros((len(ids), width), dtype=np.int64)
    distinct, at = np.unique(ids, return_inverse=True)
    rows = np.zeros((len(distinct), width), dtype=np.int64)
    bounds = np.searchsorted(distinct, [_id_bounds(v, k)[0] for k in range(v.shards)] + [v.size + 1])
    for k in np.flatnonzero(np.diff(bounds)):
        here = slice(bounds[k], bounds[k + 1])
        rows[here] = _array(v.folder, f"{name}-{k}")[distinct[here] - _id_bounds(v, k)[0]]
    out[:] = rows[at]
    return out


def _id_bounds(v: Vocabulary, shard: int) -> tuple[int, int]:
    """Ids of a shard of dense tables: equal parts of all ids, the start included."""
    each = -(-(v.size + 1) // v.shards)
    return min(shard * each, v.size + 1), min((shard + 1) * each, v.size + 1)


def _pair_keys(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return (before.astype(np.uint64) << _ID) | ids.astype(np.uint64)


def _shard_of_pair(keys: np.ndarray, shards: int) -> np.ndarray:
    return _shard_of_hash(mix(keys), shards)


def _table_hash(keys: np.ndarray) -> np.ndarray:
    """Another hash of a pair than the one that deals it, one to one."""
    return mix(keys * _ODD + np.uint64(1))


def _triple_hash(contexts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return mix(_table_hash(contexts) + ids.astype(np.uint64) * _ODD)


def _shard_of_triple(v: Vocabulary, contexts: np.ndarray) -> np.ndarray:
    """By the middle word, so that both pairs of a triple are counted where it lies; a hot word's by the first word too."""
    middle, first = contexts >> _ID, contexts & np.uint64(0xFFFFFFFF)
    part = np.zeros(len(contexts), dtype=np.uint64)
    if v.hot:
        hot, parts = np.array(v.hot, dtype=np.uint64), np.array(v.parts, dtype=np.uint64)
        place = np.minimum(np.searchsorted(hot, middle), len(hot) - 1)
        part = np.where(hot[place] == middle, mix(first) % parts[place], part)
    return _shard_of_hash(mix(middle * _ODD + part), v.shards)


def _triple_counts(v: Vocabulary, first: np.ndarray, middle: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each triple was seen, and what is known of its first two words (as in ``_dense``)."""
    counts, known = np.zeros(len(ids), dtype=np.int64), np.zeros((len(ids), 4), dtype=np.int64)
    rows = np.flatnonzero((first >= 0) & (middle >= 0))
    contexts = _pair_keys(middle[rows], first[rows])
    shard = _shard_of_triple(v, contexts)
    known[rows] = _look_up_shards(v.folder, "contexts", _table_hash(contexts), shard, v.shards, 4)
    whole = np.flatnonzero(ids[rows] >= 0)
    counts[rows[whole]] = _look_up_shards(v.folder, "triples", _triple_hash(contexts[whole], ids[rows[whole]]), shard[whole], v.shards, 1)[:, 0]
    return counts, known


def _pair_counts(v: Vocabulary, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    known = np.flatnonzero((before >= 0) & (ids >= 0))
    distinct, at = np.unique(_pair_keys(before[known], ids[known]), return_inverse=True)
    counts = _look_up_shards(v.folder, "pairs", _table_hash(distinct), _shard_of_pair(distinct, v.shards), v.shards, 1)[:, 0]
    out = np.zeros(len(ids), dtype=np.int64)
    out[known] = counts[at]
    return out


# ---- counting


def _token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts, an end after each text's words, and the places of the ends."""
    words, starts = hash_words(texts)
    ends = starts[1:] + np.arange(len(texts))
    out = np.empty(len(words) + len(texts), dtype=np.uint64)
    inner = np.ones(len(out), dtype=bool)
    inner[ends] = False
    out[inner], out[ends] = words, END
    return out, ends


def _blobs(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray, shards: int) -> pd.DataFrame:
    """Sorted keys with their counts, one row for each shard."""
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    rows = []
    for k in np.flatnonzero(np.diff(bounds)):
        here = order[bounds[k]:bounds[k + 1]]
        rows.append((k, _pack_sorted(keys[here]), _pack(counts[here].astype(np.uint32))))
    return pd.DataFrame(rows, columns=["shard", "keys", "counts"])


def _merged(blobs: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return _sum_by_key(np.concatenate([_unpack_sorted(b) for b in blobs["keys"]]),
                       np.concatenate([_unpack(b, np.uint32) for b in blobs["counts"]]).astype(np.int64))


def _count(docs: DataFrame, keys_of, shard_of, shards: int) -> DataFrame:
    """Keys of all texts, counted in each task as it goes, then dealt by shard."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            for _, texts in chunks(batch):
                held.append(keys_of(texts))
                n += len(held[-1])
                if n >= BUFFER:
                    keys, counts = np.unique(np.concatenate(held), return_counts=True)
                    yield _blobs(keys, counts, shard_of(keys, shards), shards)
                    held, n = [], 0
        if n:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            yield _blobs(keys, counts, shard_of(keys, shards), shards)

    return docs.select("text").mapInPandas(count, "shard int, keys binary, counts binary")


def _count_triples(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """Triples of all texts, counted in each task as it goes, then dealt by shard."""
    def blobs(held: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        contexts, ids, counts = _sum_triples(np.concatenate([c for c, _ in held]), np.concatenate([i for _, i in held]))
        shard = _shard_of_triple(v, contexts)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(v.shards + 1))
        rows = []
        for k in np.flatnonzero(np.diff(bounds)):
            here = order[bounds[k]:bounds[k + 1]]
            rows.append((k, _pack_sorted(contexts[here]), _pack(ids[here]), _pack(counts[here].astype(np.uint32))))
        return pd.DataFrame(rows, columns=["shard", "contexts", "ids", "counts"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            for _, texts in chunks(batch):
                tokens, ends = _token_hashes(texts)
                ids = v.ids(tokens)[0]
                before = _before(ids, ends, v.size)
                held.append((_pair_keys(before, _before(before, ends, v.size)), ids.astype(np.uint32)))
                n += len(ids)
                if n >= BUFFER:
                    yield blobs(held)
                    held, n = [], 0
        if n:
            yield blobs(held)

    return docs.select("text").mapInPandas(count, "shard int, contexts binary, ids binary, counts binary")


def _sum_triples(contexts: np.ndarray, ids: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct triples, by the context and then the word, and their counts (once each if none are given)."""
    order = np.lexsort((ids, contexts))
    contexts, ids = contexts[order], ids[order]
    first = np.flatnonzero(np.concatenate(([True], (contexts[1:] != contexts[:-1]) | (ids[1:] != ids[:-1]))))
    added = np.diff(first, append=len(ids)) if counts is None else np.add.reduceat(counts[order], first)
    return contexts[first], ids[first], added


def _stats(counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The total of each run of counts, and how many are 1, 2, and 3 or more."""
    return np.column_stack([np.add.reduceat(x.astype(np.int64), first) for x in (counts, counts == 1, counts == 2, counts >= 3)])


def _how_many(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [len(counts)]


def _pairs_of_triples(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """Write all triples and what is known of their first two words; pairs, by how many different words come before them, remain.

    A row with ``n`` counts triples of a shard by their counts.
    """
    def write(blobs: pd.DataFrame) -> pd.DataFrame:
        shard = int(blobs["shard"].iloc[0])
        contexts, ids, counts = _sum_triples(*[np.concatenate(x) for x in (
            [_unpack_sorted(b) for b in blobs["contexts"]], [_unpack(b, np.uint32) for b in blobs["ids"]],
            [_unpack(b, np.uint32).astype(np.int64) for b in blobs["counts"]])])
        first = np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1])))
        _save_table(v.folder, f"contexts-{shard}", _table_hash(contexts[first]), _stats(counts, first))
        _save_table(v.folder, f"triples-{shard}", _triple_hash(contexts, ids), counts[:, None])
        pairs, times = np.unique((contexts >> _ID << _ID) | ids, return_counts=True)
        out = _blobs(pairs, times, _shard_of_pair(pairs, v.shards), v.shards)
        return pd.concat([out.assign(n=None), pd.DataFrame({"shard": [shard], "keys": [None], "counts": [None], "n": [_how_many(counts)]})])

    return _count_triples(docs, v).groupBy("shard").applyInPandas(write, "shard int, keys binary, counts binary, n array<long>")


def count_vocabulary(docs: DataFrame, folder: str, shards: int) -> Vocabulary:
    def write(blobs: pd.DataFrame) -> pd.DataFrame:
        shard = int(blobs["shard"].iloc[0])
        keys, counts = _merged(blobs)
        _save(folder, f"words-{shard}", keys)
        _save(folder, f"counts-{shard}", counts)
        often = np.flatnonzero(counts * shards > counts.sum())
        return pd.DataFrame({"shard": [shard], "words": [len(keys)], "tokens": [int(counts.sum())], "texts": [int(counts[keys == END].sum())],
                             "places": [often], "times": [counts[often]]})

    found = _count(docs, lambda texts: _token_hashes(texts)[0], _shard_of_hash, shards)
    found = staged(found.groupBy("shard").applyInPandas(
        write, "shard int, words long, tokens long, texts long, places array<long>, times array<long>"), "vocabulary")
    rows = found.select("shard", "words", "tokens", "texts").collect()  # a row per shard
    sizes = np.zeros(shards, dtype=np.int64)
    for r in rows:
        sizes[r["shard"]] = r["words"]
    first = np.concatenate(([0], np.cumsum(sizes)))
    size, tokens, texts = int(first[-1]), sum(r["tokens"] for r in rows), sum(r["texts"] for r in rows)
    often = found.select("shard", F.inline(F.arrays_zip("places", "times"))).where(F.col("times") * shards > tokens).collect()  # fewer than shards
    hot = sorted([(int(first[r["shard"]]) + r["places"], r["times"]) for r in often] + [(size, texts)] * (texts * shards > tokens))
    return Vocabulary(folder, shards, tuple(first[:-1].tolist()), size, tokens,
                      tuple(i for i, _ in hot), tuple(-(-n * shards // tokens) for _, n in hot))


def train(docs: DataFrame, folder: str | None = None, shards: int | None = None, order: int = 3) -> Model:
    """Count (text) rows, all of them, into a model of order two or three.

    Null texts are empty: they count an end. Words are numbered by hash. Pairs of ids are
    dealt by a hash of the pair, so a frequent word's pairs lie in all shards;
    what is known of a word's pairs is added up afterwards. Triples are dealt by their
    middle word, a hot word's by the first one as well; pairs then count by the
    different words before them, and texts aren't read for them. ``shards`` should grow with
    the input (default: Spark's shuffle partitions); a task merges one. The files go to a
    new folder under ``folder`` (default: the shared checkpoint folder). Only a few numbers per shard come to the driver.
    """
    if order not in (2, 3):
        raise ValueError("a model is of order 2 or 3")
    spark = docs.sparkSession
    shards = shards or shuffle_width(spark)
    folder = _folder(spark, folder)
    v = count_vocabulary(docs, folder, shards)
    if v.size >= 2**32 - 1:
        raise OverflowError("a pair's key has 32 bits for each word: 4,294,967,294 different words at most")
    if not v.size:
        return Model(v, *[Discounts.of([0] * 4)] * 2, 0, (0, 0, 0))

    def pair_keys(texts: list[str]) -> np.ndarray:
        tokens, ends = _token_hashes(texts)
        ids = v.ids(tokens)[0]
        return _pair_keys(_before(ids, ends, v.size), ids)

    def by_word(kind: str, ids: np.ndarray, table: np.ndarray) -> pd.DataFrame:
        """The rows of ``table`` for these ascending ids, by shard of the dense tables."""
        cuts = np.searchsorted(ids, [_id_bounds(v, k)[0] for k in range(v.shards)] + [v.size + 1])
        return pd.DataFrame([(kind, k, _pack_sorted(ids[a:b]), _pack(table[a:b].astype(np.int64).ravel()), None)
                             for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a], columns=["kind", "shard", "ids", "values", "n"])

    def counted(kind: str, n: list[int]) -> pd.DataFrame:
        return pd.DataFrame({"kind": [kind], "shard": [0], "ids": [None], "values": [None], "n": [n]})

    def write_pairs(blobs: pd.DataFrame) -> pd.DataFrame:
        shard, of_triples = int(blobs["shard"].iloc[0]), blobs["keys"].isna()
        passed = [counted("triples", n) for n in blobs.loc[of_triples, "n"]]
        blobs = blobs[~of_triples]
        if not len(blobs):
            return pd.concat(passed)
        keys, counts = _merged(blobs)
        _save_table(folder, f"pairs-{shard}", _table_hash(keys), counts[:, None])
        before, word = keys >> _ID, np.sort(keys & np.uint64(0xFFFFFFFF))
        first = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        words, times = np.unique(word, return_counts=True)
        return pd.concat([by_word("before", before[first], _stats(counts, first)), by_word("after", words, times[:, None]),
                          counted("pairs", _how_many(counts)), *passed])

    if order == 2:
        counts = _count(docs, pair_keys, _shard_of_pair, shards).withColumn("n", F.lit(None).cast("array<long>"))
    else:
        counts = _pairs_of_triples(docs, v)
    stats = staged(counts.groupBy("shard").applyInPandas(
        write_pairs, "kind string, shard int, ids binary, values binary, n array<long>"), "pair_stats")

    def write_dense(blobs: pd.DataFrame) -> pd.DataFrame:
        kind, shard = blobs["kind"].iloc[0], int(blobs["shard"].iloc[0])
        low, high = _id_bounds(v, shard)
        width = 4 if kind == "before" else 1
        table = added(low, high, width, blobs["ids"], blobs["values"])
        _save(folder, f"{kind}-{shard}", table)
        n = [int((table == k).sum()) for k in (1, 2, 3, 4)] + [int((table > 0).sum())] if kind == "after" else [0] * 5
        return pd.DataFrame({"kind": [kind], "shard": [shard], "n": [n]})

    dense = stats.where("n IS NULL").groupBy("kind", "shard").applyInPandas(write_dense, "kind string, shard int, n array<long>").collect()
    for kind in ("before", "after"):
        for k in set(range(shards)) - {r["shard"] for r in dense if r["kind"] == kind}:
            low, high = _id_bounds(v, k)
            _save(folder, f"{kind}-{k}", np.zeros((high - low, 4 if kind == "before" else 1), dtype=np.int64))
    n = {"pairs": np.zeros(5, dtype=np.int64), "triples": np.zeros(5, dtype=np.int64)}
    for r in stats.where("n IS NOT NULL").select("kind", "n").collect():  # at most two rows per shard
        n[r["kind"]] += r["n"]
    pairs, triples = n["pairs"].tolist(), n["triples"].tolist()
    after = np.sum([r["n"] for r in dense], axis=0).tolist()
    return Model(v, Discounts.of(pairs[:4]), Discounts.of(after[:4]), pairs[4], (after[0], after[1], after[4] - after[0] - after[1]),
                 Discounts.of(triples[:4]) if order == 3 else None)


def added(low: int, high: int, width: int, ids: Iterable[bytes], values: Iterable[bytes]) -> np.ndarray:
    """The sums, in 64 bits, of packed rows by their packed ids from ``low`` up to ``high``."""
    table = np.zeros((high - low, width), dtype=np.int64)
    for i, v in zip(ids, values):
        table[(_unpack_sorted(i) - np.uint64(low)).astype(np.int64)] += _unpack(v, np.int64).reshape(-1, width)
    return table


def _before(ids: np.ndarray, ends: np.ndarray, start: int) -> np.ndarray:
    """The id before each token; texts begin after a start of their own."""
    out = np.concatenate(([start], ids[:-1]))
    out[(ends + 1)[:-1]] = start
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score, perplexity for (doc_id, text), whole texts.

    ``score`` is the model's log10 probability of a text's tokens and its end;
    ``base_score`` that of single tokens with one added to each count. A null text is
    empty: one token, the end. Words the model doesn't know share the chance of one
    unknown word. Repeated rows score alike; no rows give no rows.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = model.vocabulary
        for batch in batches:
            for rows, texts in chunks(batch):
                tokens, ends = _token_hashes(texts)
                ids, counts = v.ids(tokens)
                logs = np.log10(model.chances(ids, ends))
                first = np.concatenate(([0], ends[:-1] + 1))
                n = ends + 1 - first
                total = np.add.reduceat(logs, first)
                base = np.add.reduceat(np.log10((counts + 1) / (v.tokens + v.size + 1)), first)
                yield pd.DataFrame({"doc_id": rows["doc_id"].array, "n_tokens": n, "n_known": np.add.reduceat((counts > 0).astype(np.int64), first),
                                    "base_score": base, "score": total, "perplexity": 10 ** (-total / n)})

    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {id_type}, n_tokens long, n_known long, base_score double, score double, perplexity double")
