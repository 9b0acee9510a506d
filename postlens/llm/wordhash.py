"""64-bit hashes of the words and word shingles of many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from postlens.llm.common import take_turn

#: White space that ends a word; all of it is a single byte in UTF-8.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}

#: Texts are hashed so many characters at a time; a longer text is a chunk of its own.
CHUNK_CHARS = 500_000


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2 ** 64; kept for chunks of the usual size."""
    if base in _powers and len(_powers[base]) >= n:
        return _powers[base][:n]
    out = np.full(max(n, 2 * CHUNK_CHARS), base, dtype=np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    if n <= 4 * CHUNK_CHARS:
        _powers[base] = out
    return out[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def hash_words(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in turn, and at which word each text starts (one more entry ends the last).

    The hash is that of the word's bytes, with A-Z in lower case. It is a difference of
    running sums of bytes times powers, so no word is looked at by itself.
    """
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b" ".join([*parts, b""]), dtype=np.uint8)
    ends = np.cumsum(np.fromiter((len(p) + 1 for p in parts), dtype=np.int64, count=len(parts)))
    space = _SPACE[raw]
    change = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(raw) and not space[0]:
        change = np.concatenate(([0], change))
    if len(change) % 2:
        change = np.append(change, len(raw))
    start, end = change[0::2], change[1::2]
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((_LOWER[raw] if lower else raw).astype(np.uint64) * _power(_BASE, len(raw)), out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * _power(_INVERSE, len(raw) + 1)[start] + (end - start).astype(np.uint64))
    return hashes, np.concatenate(([0], np.searchsorted(start, ends)))


def hash_shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each word on; the last ones, where too few follow, are left out."""
    n = max(0, len(words) - size + 1)
    out = words[:n].copy()
    for k in range(1, size):
        out *= np.uint64(_BASE)
        out += words[k:n + k]
    return mix(out)


def hash_runs(values: np.ndarray, size: int) -> np.ndarray:
    """As ``hash_shingles``, for long runs: by differences of running sums, whatever the size."""
    n = max(0, len(values) - size + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _power(_BASE, len(values)), out=sums[1:])
    return mix((sums[size:size + n] - sums[:n]) * _power(_INVERSE, n))


def chunks(batch: pd.DataFrame, column: str = "text") -> Iterator[tuple[pd.DataFrame, list[str]]]:
    """Rows of a batch with their texts (null: empty), a bounded number of characters at a time."""
    take_turn("wordhash", _powers.clear)
    texts = batch[column].fillna("").tolist()
    number = (np.cumsum([len(t) for t in texts]) // CHUNK_CHARS) if texts else np.zeros(0, dtype=int)
    for k in np.unique(number):
        rows = np.flatnonzero(number == k)
        yield batch.iloc[rows], [texts[i] for i in rows]
    pa.system_memory_pool().release_unused()
