"""Language identification by error-correcting output codes over hashed letter n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Features of a text: its hashed n-grams of letters, as shares of the text.
ORDERS = (1, 2, 3)
BITS = 12
FEATURES = len(ORDERS) << BITS
#: At most so many labelled texts of each language, and so many in all, are learned from; the first by a seeded hash.
SAMPLE_PER_LANGUAGE = 400
SAMPLE = 4000
CODE_SEED = 7
EPOCHS = 60
#: A prediction whose loss is this near to the second best is flagged.
AMBIGUOUS_MARGIN = 0.1
UNDETERMINED = "und"
#: Texts are turned into features so many characters at a time.
BATCH_CHARS = 1_000_000

_MIX = np.uint32(0x9E3779B1)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in lower case, letters as they are and anything else as one blank; where each text starts."""
    points = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(p) + 1 for p in points])))[:-1]
    flat = np.full(int(sum(len(p) + 1 for p in points)), 32, dtype=np.uint32)
    for start, p in zip(starts, points):
        flat[start:start + len(p)] = p
    # below 0xAA only a-z are letters; above, letters and other signs are kept apart by the classifiers themselves
    flat[(flat < 0xAA) & ((flat < 97) | (flat > 122))] = 32
    return flat, starts


def text_features(texts: list[str]) -> np.ndarray:
    """One row of n-gram shares per text, whole texts; the root damps what is frequent."""
    out = np.zeros((len(texts), FEATURES), dtype=np.float32)
    sizes = np.cumsum([len(t) for t in texts]) // BATCH_CHARS
    for k in np.unique(sizes):
        part = np.flatnonzero(sizes == k)
        flat, starts = _code_points([texts[i] for i in part])
        ends = np.append(starts[1:], len(flat))
        for order_at, order in enumerate(ORDERS):
            h = np.zeros(len(flat), dtype=np.uint32)
            for j in range(order):
                h[:len(flat) - j] = h[:len(flat) - j] * np.uint32(0x01000193) + flat[j:]
            # n-grams that start in a run of blanks say nothing
            idle = flat == 32
            if order > 1:
                idle[:-1] &= flat[1:] == 32
            slots = ((h * _MIX) >> np.uint32(32 - BITS)).astype(np.int32)
            for row, start, end in zip(part, starts, ends):
                inner = slice(start, max(start, end - order + 1))
                counts = np.bincount(slots[inner][~idle[inner]], minlength=1 << BITS)
                out[row, order_at << BITS:(order_at + 1) << BITS] = counts
    for order_at in range(len(ORDERS)):
        block = out[:, order_at << BITS:(order_at + 1) << BITS]
        block /= np.maximum(block.sum(axis=1, keepdims=True), 1)
    return np.sqrt(out, out=out)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    #: One codeword of -1 and 1 for each language.
    code: np.ndarray
    #: One linear classifier for each bit, and how far to trust it.
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Loss-weighted decoding: the nearest codeword, how sure that is, and whether a second one is as near."""
        margins = features @ self.weights + self.bias
        loss = (np.logaddexp(0, -margins[:, None, :] * self.code[None]) * self.trust).sum(axis=2) / self.trust.sum()
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(len(features))
        best = loss[rows, order[:, 0]]
        second = loss[rows, order[:, 1]] if len(self.languages) > 1 else best + math.inf
        chance = np.exp(-(loss - best[:, None]) * self.trust.sum())
        return order[:, 0], 1 / chance.sum(axis=1), second - best < AMBIGUOUS_MARGIN


def codewords(n: int, seed: int = CODE_SEED) -> np.ndarray:
    """One codeword per class: all ways to split few classes in two; for many, random splits of the largest distance."""
    if n <= 1:
        return np.ones((n, 1), dtype=np.int8)
    if n <= 5:
        splits = np.arange(1, 2 ** (n - 1))
        bits = (splits[None, :] >> np.arange(n - 1)[:, None]) & 1
        return np.where(np.vstack([np.zeros(len(splits), dtype=int), bits]), -1, 1).astype(np.int8)
    rng, length = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, distance = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, length))
        apart = (length - code.astype(int) @ code.T.astype(int)) // 2
        least = int(apart[~np.eye(n, dtype=bool)].min())
        split = np.abs(code.sum(axis=0)).max() < n
        if split and least > distance:
            best, distance = code, least
    return best


def _fit_bits(x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression for all bits at once, accelerated gradient with a little shrinkage."""
    w, b = np.zeros((x.shape[1], target.shape[1]), dtype=np.float32), np.zeros(target.shape[1], dtype=np.float32)
    longest = max(float((part * part).sum(axis=1).max()) for part in np.array_split(x, -(-len(x) // 64)))  # no second matrix of all texts
    ahead_w, ahead_b, rate, shrink = w, b, np.float32(4.0 / max(1e-6, longest + 1)), np.float32(1e-4)
    for k in range(EPOCHS):
        slope = -target / (1 + np.exp(target * (x @ ahead_w + ahead_b))) * weight
        new_w = ahead_w - rate * (x.T @ slope + shrink * ahead_w)
        new_b = ahead_b - rate * slope.sum(axis=0)
        pull = np.float32(k / (k + 3))
        ahead_w, ahead_b, w, b = new_w + pull * (new_w - w), new_b + pull * (new_b - b), new_w, new_b
    return w, b


def train_language_id(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, most: int = SAMPLE) -> LanguageModel:
    """Learn from (doc_id, text, lang): at most ``per_language`` texts of a language and ``most`` in all.

    Rows with null lang, null text or a text without a letter teach nothing. The texts are the
    first by a seeded hash of the id, so reruns agree; equal texts count each. Without
    labelled rows the model has no languages and all texts are undetermined.
    """
    labelled = docs.where(F.col("lang").isNotNull() & has_letter(F.col("text"))).withColumn(
        "__order", F.xxhash64(F.lit(CODE_SEED), "doc_id"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("__order"))
    first = labelled.select("lang", "__order").withColumn("__rank", rank).where(F.col("__rank") <= per_language)
    chosen = first.orderBy("__rank", "lang").limit(most).select("lang", "__order").distinct()
    # at most ``most`` rows
    texts = labelled.join(F.broadcast(chosen), ["lang", "__order"]).select("lang", "text").limit(most)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.iloc[at:at + 64]
                rows = text_features(part["text"].tolist())
                yield pd.DataFrame({"lang": part["lang"].array, "row": [r.astype("<f2").tobytes() for r in rows]})

    rows = texts.mapInPandas(features, "lang string, row binary").collect()
    languages = tuple(sorted({r["lang"] for r in rows}))
    code = codewords(len(languages))
    if not languages:
        return LanguageModel((), code, np.zeros((FEATURES, 1), np.float32), np.zeros(1, np.float32), np.ones(1))
    rows.sort(key=lambda r: (r["lang"], r["row"]))
    y = np.searchsorted(np.array(languages, dtype=object), np.array([r["lang"] for r in rows], dtype=object))
    x = np.empty((len(rows), FEATURES), dtype=np.float32)
    for k in reversed(range(len(rows))):
        x[k] = np.frombuffer(rows.pop()["row"], dtype="<f2")
    target = code[y].astype(np.float32)
    # every language weighs the same
    weight = (1 / (len(languages) * np.bincount(y, minlength=len(languages))[y]))[:, None].astype(np.float32)
    w, b = _fit_bits(x, target, weight)
    wrong = ((x @ w + b) * target <= 0).astype(np.float64)
    error = np.clip((wrong * weight).sum(axis=0), 0.5 / len(x), 0.45)
    return LanguageModel(languages, code, w, b, np.log((1 - error) / error))


def identify_language(docs: DataFrame, model: LanguageModel, keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``__lang``, ``__lang_score`` (0 to 1) and ``__ambiguous`` to the columns of ``docs``, or to those named.

    Reads text alone, the whole of it. Null texts and texts without a letter get
    ``und``, score 0 and are not ambiguous; so do all texts if the model knows no
    language. Of equally near codewords the first by name wins. Repeated rows get the
    same result each; no rows give no rows.
    """
    names_kept = list(docs.columns if keep is None else keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at:at + 512].copy()
                part["__lang"], part["__lang_score"], part["__ambiguous"] = UNDETERMINED, 0.0, False
                rows = np.flatnonzero(part["__letter"].to_numpy()) if known.languages else np.zeros(0, dtype=int)
                if len(rows):
                    best, score, near = known.decode(text_features(part["text"].iloc[rows].tolist()))
                    names = np.array(part["__lang"], dtype=object)
                    names[rows] = np.array(known.languages, dtype=object)[best]
                    part["__lang"] = names
                    part.iloc[rows, part.columns.get_loc("__lang_score")] = score
                    part.iloc[rows, part.columns.get_loc("__ambiguous")] = near
                yield part[[*names_kept, "__lang", "__lang_score", "__ambiguous"]]

    read = dict.fromkeys([*names_kept, "text"])
    with_letter = docs.select(*[F.col(f"`{c}`") for c in read]).withColumn("__letter", has_letter(F.col("text")))
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names_kept)
    return with_letter.mapInPandas(predict, f"{fields}, __lang string, __lang_score double, __ambiguous boolean")
