"""Packing documents into sequences of equal size: a configuration linear program over the lengths, rounded."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import staged
from postlens.llm.tokens import encoder

CAPACITY = 2048
ROUNDS = 100
#: Share of a length that one round covers at most, and how fast prices follow the coverage.
STEP, RATE = 0.5, 0.5
#: A column enters a round if its worth is this near to the best.
NEAR = 0.99
#: Texts that a task encodes at a time, in characters.
BATCH_CHARS = 2_000_000

Columns = dict[tuple[int, ...], float]


# ---- the program over the histogram; its size depends on the capacity alone


def _knapsack(prices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best worth of each capacity, and the length to take first there (0: nothing fits that is worth anything).

    Of equally good lengths the longest is taken, which keeps configurations short.
    """
    capacity = len(prices) - 1
    worth, first = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    falling = prices[::-1].copy()
    for c in range(1, capacity + 1):
        with_item = falling[capacity - c:capacity] + worth[:c]  # lengths c, c - 1, ..., 1
        k = int(with_item.argmax())
        if with_item[k] > worth[c - 1] + 1e-12:
            worth[c], first[c] = with_item[k], c - k
        else:
            worth[c], first[c] = worth[c - 1], first[c - 1]
    return worth, first


def _filled(length: int, first: np.ndarray) -> tuple[int, ...]:
    """The configuration that takes ``length`` and fills the rest at best."""
    items, left = [length], len(first) - 1 - length
    while left > 0 and first[left]:
        items.append(int(first[left]))
        left -= items[-1]
    return tuple(sorted(items, reverse=True))


def configuration_program(counts: np.ndarray, rounds: int = ROUNDS) -> Columns:
    """Fractional numbers of configurations that together cover ``counts`` (by length), by multiplicative weights.

    Prices start at the share of a sequence that a length fills and fall
    exponentially with how far a length is covered. Each round prices the columns
    by a knapsack over the capacity: for every length still open the best
    configuration with it. Those of nearly the highest worth get a share, so that
    no length is covered by more than one step, nor beyond its count.
    """
    capacity = len(counts) - 1
    present = np.flatnonzero(counts)
    covered, used = np.zeros(capacity + 1), defaultdict(float)
    for _ in range(rounds):
        open_ = present[covered[present] < 1 - 1e-9]
        if not len(open_):
            break
        prices, remaining = np.zeros(capacity + 1), counts * (1 - covered)
        prices[open_] = open_ / capacity * np.exp(-RATE * (covered[open_] - covered[open_].min()))
        worth, first = _knapsack(prices)
        with_each = prices[open_] + worth[capacity - open_]
        columns = {c: Counter(c) for c in (_filled(int(n), first) for n in open_[with_each >= NEAR * with_each.max()])}
        wanted, added = np.zeros(capacity + 1), np.zeros(capacity + 1)
        for times in columns.values():
            for n, k in times.items():
                wanted[n] += k
        share_of = np.minimum(STEP * counts, remaining) / np.maximum(wanted, 1)
        for column, times in columns.items():
            share = min(share_of[n] for n in times)
            used[column] += share
            for n, k in times.items():
                added[n] += share * k
        covered[present] += added[present] / counts[present]
    return dict(used)


def _best_fit(counts: np.ndarray, bins: dict[int, list[tuple[tuple[int, ...], int]]], capacity: int) -> None:
    """Put what is left, longest first, into the sequences where it leaves the least room; alike ones together."""
    for length in np.flatnonzero(counts)[::-1]:
        left = int(counts[length])
        while left:
            room = next((r for r in range(length, capacity + 1) if bins.get(r)), None)
            if room is None:
                each = max(1, capacity // length)
                full, rest = divmod(left, each)
                if full:
                    bins.setdefault(capacity - each * int(length), []).append(((int(length),) * each, full))
                if rest:
                    bins.setdefault(capacity - rest * int(length), []).append(((int(length),) * rest, 1))
                break
            items, copies = bins[room].pop()
            take = min(left, copies)
            if copies > take:
                bins[room].append((items, copies - take))
            bins.setdefault(room - int(length), []).append(((*items, int(length)), take))
            left -= take


def packing_plan(counts: np.ndarray, rounds: int = ROUNDS) -> list[tuple[tuple[int, ...], int]]:
    """Configurations and how many sequences follow each; together they hold exactly ``counts``."""
    capacity = len(counts) - 1
    left = counts.astype(np.int64).copy()
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    columns = configuration_program(left, rounds) if left.any() else {}
    for up in (False, True):
        for column, share in sorted(columns.items(), key=lambda x: (-x[1], x[0])):
            times = Counter(column)
            copies = min(math.ceil(share) if up else math.floor(share), *(int(left[n]) // k for n, k in times.items()))
            if copies > 0:
                for n, k in times.items():
                    left[n] -= copies * k
                bins.setdefault(capacity - sum(column), []).append((column, copies))
    _best_fit(left, bins, capacity)
    return sorted((c for found in bins.values() for c in found), key=lambda x: (-x[1], x[0]))


def _places(plan: list[tuple[tuple[int, ...], int]], capacity: int) -> np.ndarray:
    """Rows (length, first rank, items a sequence, first sequence, offset), by length and rank.

    The pieces of a length are numbered; a row says that from a rank on, so many in
    turn go into each of the sequences of one configuration.
    """
    rows, rank, sequence = [], np.zeros(capacity + 1, dtype=np.int64), 0
    for items, copies in plan:
        offset = 0
        for length in sorted(set(items), reverse=True):
            each = items.count(length)
            rows.append((length, rank[length], each, sequence, offset))
            rank[length] += each * copies
            offset += each * length
        sequence += copies
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


# ---- Spark


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, text) to pieces: doc_id, piece, start, length, ids_crc32, and ``task`` and ``rank`` that number them.

    ``rank`` counts the pieces of the same length in the task that made them.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, seen, encode = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64), encoder(tokenizer).encode
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            ends = np.cumsum([len(t) for t in texts]) // BATCH_CHARS
            for k in np.unique(ends):
                part = np.flatnonzero(ends == k)
                rows = []
                for i, ids in zip(part, encode([texts[j] for j in part])):
                    ids += b"\0\0\0\0"
                    n = len(ids) // 4
                    start, length = 0, n % capacity or capacity
                    for piece in range(-(-n // capacity)):
                        rows.append((i, piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), seen[length]))
                        seen[length] += 1
                        start, length = start + length, capacity
                out = pd.DataFrame(rows, columns=["row", "piece", "start", "length", "ids_crc32", "rank"])
                out["doc_id"] = batch["doc_id"].iloc[out.pop("row")].array
                yield out.assign(task=task)[["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]]

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        cut, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, task int, rank long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Pack whole documents into as few sequences of at most ``capacity`` tokens as the method finds.

    docs: doc_id and text; other columns are not read. ``tokenizer`` is the path of a
    vocabulary file, the same on every machine. A document is its ids and a final
    id 0; null and empty texts are that one id. Only documents longer than a sequence
    are cut, into full pieces after a first one that may be shorter. One row per
    piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Equal rows
    and rows with null ids are packed like any others; no rows give no rows.

    Only the histogram of lengths, at most ``capacity`` rows, comes to the driver,
    and the plan that goes out is as small. Pieces of one length are numbered by
    task, never gathered.
    """
    pieces = staged(token_pieces(docs, tokenizer, capacity), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    places = _places(packing_plan(histogram, rounds), capacity)
    first = (F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = pieces.join(counts.withColumn("first", first).drop("n"), ["length", "task"])
    numbered = numbered.withColumn("rank", F.col("rank") + F.col("first"))
    plan = docs.sparkSession.sparkContext.broadcast(places)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = plan.value
        # one sorted key for (length, rank): ranks stay far below 2**50
        keys = table[:, 0] * 2**50 + table[:, 1]
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            row = table[np.searchsorted(keys, length * 2**50 + rank, side="right") - 1]
            copy, slot = np.divmod(rank - row[:, 1], row[:, 2])
            yield batch.assign(sequence_id=row[:, 3] + copy, offset=row[:, 4] + slot * length)

    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInPandas(
        place, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, "
               "rank long, sequence_id long, offset long").drop("rank")
