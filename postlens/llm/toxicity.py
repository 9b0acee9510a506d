"""Toxicity by a support vector machine over a gap-weighted subsequence kernel, with Nyström landmarks."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import staged
from postlens.llm.wordhash import chunks, mix

#: Letters of a subsequence, and what each letter that it spans costs.
ORDER = 3
DECAY = 0.6
#: Longer words are taken in windows that overlap by half.
LONGEST = 14
LANDMARKS = 256
#: At most so many labelled texts of each label are learned from; the first by a seeded hash.
SAMPLE_PER_LABEL = 1500
SEED = 11
ROUNDS, STEPS, SHRINK, NEGATIVE_WEIGHT = 4, 400, 1e-4, 4
#: At most so many different words of clean texts, the first by hash, are negatives.
NEGATIVES = 100_000
#: How many words may, by chance alone, seem more frequent in toxic texts than they are.
LUCK = 0.01
#: And how many times as frequent it must be there.
PURE = 4
#: Letters of the beginnings that words of toxic texts may share.
STEM_LENGTHS = range(ORDER, 9)
#: Words that two texts must share, of those of both, to be copies.
ALIKE = 0.5
_CACHED_WORDS = 500_000

#: a to z, then other letters by code point; distinct for those of Latin alphabets in use. The last marks both ends of a word.
_LETTERS, _END = 64, 63
#: Signs that stand in for letters.
_LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_SPACED = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_SIGNS = re.compile(r"[\W_]+")


def plain(word: str) -> str:
    """The letters of a word, signs that look like letters among them; signs at its end are punctuation."""
    return _SIGNS.sub("", word.lower().rstrip("!.,;:?$@").translate(_LOOKALIKE_TABLE))


_LOOKALIKE_TABLE = str.maketrans(_LOOKALIKES)


def sentence_words(text: str) -> list[str]:
    """Words by white space; letters that stand alone in a row are one word."""
    text = _SPACED.sub(lambda m: m[0].replace(" ", ""), text)
    return text.split()


def plain_words(text: str) -> Counter[str]:
    """How often a text has each word of three letters or more."""
    return Counter(p for s in _SENTENCE.split(text) for w in sentence_words(s) if len(p := plain(w)) >= ORDER)


# ---- the kernel


@lru_cache(maxsize=32)
def _subsequences(length: int) -> tuple[np.ndarray, np.ndarray]:
    places = np.array(list(combinations(range(length), ORDER)), dtype=np.int64).reshape(-1, ORDER)
    return places, (DECAY ** (places[:, -1] - places[:, 0] + 1)).astype(np.float32)


def _features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words of one length: the subsequences of each, and their weights over the root of the kernel with itself."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64).reshape(len(words), -1)
    codes = np.full((len(words), points.shape[1] + 2), _END)
    codes[:, 1:-1] = np.where((points >= 97) & (points <= 122), points - 97, 26 + points % 37)
    places, weight = _subsequences(codes.shape[1])
    kinds = np.zeros((len(words), len(places)), dtype=np.int64)
    for k in range(ORDER):
        kinds = kinds * _LETTERS + codes[:, places[:, k]]
    order = np.argsort(kinds, axis=1, kind="stable")
    ordered, weights = np.take_along_axis(kinds, order, axis=1), weight[order]
    first = np.ones(kinds.shape, dtype=bool)
    first[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    at = np.flatnonzero(first.ravel())
    sums = np.add.reduceat(weights.ravel(), at)
    own = np.bincount(at // kinds.shape[1], weights=sums * sums, minlength=len(words))
    return kinds, weight[None, :] / np.sqrt(own)[:, None].astype(np.float32)


def _windows(word: str) -> list[str]:
    if len(word) <= LONGEST:
        return [word] if len(word) >= ORDER else []
    step = LONGEST // 2
    return [word[k:k + LONGEST] for k in range(0, len(word) - step, step)]


def _by_length(words: list[str]) -> dict[int, tuple[list[int], list[str]]]:
    out: dict[int, tuple[list[int], list[str]]] = {}
    for i, word in enumerate(words):
        for w in _windows(word):
            rows, parts = out.setdefault(len(w), ([], []))
            rows.append(i)
            parts.append(w)
    return out


def against_tables(words: list[str], tables: np.ndarray, column: np.ndarray | None = None) -> np.ndarray:
    """For each word (row) and function (column) the largest value that the function takes on a window of the word.

    A function is given by its value on each subsequence: the kernel has finitely many
    features, so a kernel with a landmark, or a weighted sum of them, is such a table.
    ``column`` says where a subsequence stands in the tables. Words that are too short get
    minus infinity.
    """
    out = np.full((len(words), len(tables)), -np.inf, dtype=np.float32)
    for rows, parts in _by_length(words).values():
        for at in range(0, len(parts), 10_000):
            kinds, weights = _features(parts[at:at + 10_000])
            if column is not None:
                kinds = column[kinds]
            for k, table in enumerate(tables):
                np.maximum.at(out[:, k], rows[at:at + 10_000], np.einsum("ij,ij->i", table[kinds], weights))
    return out


class Landmarks:
    """Words whose kernels span the space in which the machine is linear (Nyström)."""

    def __init__(self, words: list[str]) -> None:
        features = [_features([w]) for w in words]
        self.kinds = np.unique(np.concatenate([kinds[0] for kinds, _ in features]))
        self.column = np.zeros(_LETTERS**ORDER, dtype=np.int32)  # 0: a subsequence that no landmark has
        self.column[self.kinds] = np.arange(1, len(self.kinds) + 1)
        self.tables = np.zeros((len(words), len(self.kinds) + 1), dtype=np.float32)
        for row, (kinds, weights) in zip(self.tables, features):
            np.add.at(row, self.column[kinds[0]], weights[0])
        value, vector = np.linalg.eigh((self.tables @ self.tables.T).astype(np.float64))
        used = value > 1e-6 * value.max()
        self.whiten = (vector[:, used] / np.sqrt(value[used])).astype(np.float32)

    def project(self, words: list[str]) -> np.ndarray:
        return against_tables(words, self.tables, self.column) @ self.whiten

    def folded(self, w: np.ndarray) -> np.ndarray:
        """A linear function of projections as one number for each subsequence."""
        out = np.zeros(_LETTERS**ORDER, dtype=np.float32)
        out[self.kinds] = (self.tables.T @ (self.whiten @ w))[1:]
        return out


# ---- the machine


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


@dataclass(frozen=True)
class DenseWords:
    """A second machine, of words that clean texts have by chance and toxic ones densely: how many there are tells, not that there is one."""

    table: np.ndarray
    offset: float
    #: What each such word adds to the log of the odds, and what each word of the text takes from it.
    gain: float
    loss: float
    slope: float
    middle: float

    def chance(self, hits: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For texts of so many words that have some such words."""
        return _sigmoid(self.slope * (self.gain * hits - self.loss * lengths - self.middle))


@dataclass(frozen=True)
class ToxicityModel:
    #: The decision function as its value on each subsequence, its offset, and the sigmoid that makes it a chance.
    table: np.ndarray
    offset: float
    slope: float
    middle: float
    dense: DenseWords | None = None

    def word_values(self, words: list[str]) -> np.ndarray:
        return against_tables(words, self.table[None])[:, 0] + self.offset

    def both_values(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The value of each word, and if it is one of the dense words."""
        if self.dense is None:
            return self.word_values(words), np.zeros(len(words), dtype=bool)
        values = against_tables(words, np.stack([self.table, self.dense.table]))
        return values[:, 0] + self.offset, values[:, 1] + self.dense.offset > 0

    def chance(self, values: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * (values - self.middle))


def _without_copies(bags: list[tuple[int, Counter[str]]]) -> list[tuple[int, Counter[str]]]:
    """Of texts that share most of their words the first; copies of one text would make its words look telling.

    Texts with common least hashes are compared: texts of few different words have those in common without being copies.
    """
    seen: dict[tuple, list[int]] = {}
    out: list[tuple[int, Counter[str]]] = []
    for label, words in bags:
        if not words:
            continue
        hashes = mix(np.array([zlib.crc32(w.encode()) for w in words], dtype=np.uint64))
        keys = [(k, tuple(np.sort(mix(hashes + np.uint64(k)))[:2].tolist())) for k in range(4)]
        near = sorted({i for key in keys for i in seen.get(key, [])})
        if any((both := len(words.keys() & out[i][1].keys())) >= ALIKE * (len(words) + len(out[i][1]) - both) for i in near):
            continue
        for key in keys:
            seen.setdefault(key, []).append(len(out))
        out.append((label, words))
    return out


def _strength(bad: int, n_toxic: int, good: int, n_clean: int) -> float:
    """How unlikely so large a part of the texts would be toxic by chance: minus the log of a bound on it (Chernoff)."""
    part, usual = bad / (bad + good), n_toxic / (n_toxic + n_clean)
    if part <= usual:
        return 0.0
    return bad * np.log(part / usual) + (good * np.log((1 - part) / (1 - usual)) if good else 0.0)


def _least_strength(bad: Counter[str]) -> float:
    """The more candidates there are, the stronger one must be."""
    return np.log(max(1, sum(n > 2 for n in bad.values())) / LUCK)


def _telling(toxic: list[set[str]], clean: list[set[str]]) -> list[str]:
    """Words that stand in toxic texts more often than chance allows, the surest first."""
    bad, good = Counter(w for s in toxic for w in s), Counter(w for s in clean for w in s)

    def pure(w: str) -> bool:  # by rates, however many texts of each label there are
        return bad[w] * max(1, len(clean)) >= PURE * good[w] * len(toxic)

    least = _least_strength(bad)
    found = {w: z for w in bad if bad[w] > 2 and pure(w) and (z := _strength(bad[w], len(toxic), good[w], len(clean))) >= least}
    return sorted(found, key=lambda w: (-found[w], w))


def _stems(word: str) -> list[str]:
    return [word[:n] for n in STEM_LENGTHS if n < len(word)]


def _telling_stems(toxic: list[Counter[str]], clean: list[Counter[str]]) -> list[str]:
    """Beginnings of words that more toxic texts have than chance allows, and among all words more densely; of one and its extension the surer.

    They have many endings: where one word makes up half of the texts, it is told by itself.
    """
    def counted(texts: list[Counter[str]]) -> tuple[Counter[str], Counter[str], int]:
        having, times = Counter(), Counter()
        for words in texts:
            own = Counter()
            for w, n in words.items():
                for stem in _stems(w):
                    own[stem] += n
            having.update(own.keys())
            times.update(own)
        return having, times, sum(sum(words.values()) for words in texts)

    (bad, bad_times, bad_all), (good, good_times, good_all) = counted(toxic), counted(clean)
    least = _least_strength(bad)
    sure = {s: z for s in bad if bad[s] > 2 and bad_times[s] * max(1, good_all) >= PURE * good_times[s] * bad_all
            and (z := _strength(bad[s], len(toxic), good[s], len(clean))) >= least}
    most: Counter[str] = Counter()
    for w, n in Counter(w for words in toxic for w in words).items():
        for stem in _stems(w):
            if stem in sure:
                most[stem] = max(most[stem], n)
    out: list[str] = []
    for stem in sorted(sure, key=lambda s: (-sure[s], -len(s), s)):
        if 2 * most[stem] < bad[stem] and not any(stem.startswith(s) or s.startswith(stem) for s in out):
            out.append(stem)
    return out


def _dense_words(positive: list[str], negative: np.ndarray, times: np.ndarray, landmarks: Landmarks, toxic: list[Counter[str]], clean: list[Counter[str]]) -> DenseWords | None:
    """The second machine and its rates: in the toxic texts that have such words, and in all clean ones.

    Since it counts words, an error on a word weighs by the clean texts that have it (``times``).
    """
    w, b = _fit(landmarks.project(positive), negative, times)
    table = landmarks.folded(w)

    def counted(texts: list[Counter[str]]) -> tuple[np.ndarray, np.ndarray]:
        known = sorted(set().union(*texts))
        hit = dict(zip(known, against_tables(known, table[None])[:, 0] + b > 0))
        return (np.array([sum(n for w, n in words.items() if hit[w]) for words in texts]),
                np.array([sum(words.values()) for words in texts]))

    (hits, lengths), (by_chance, clean_lengths) = counted(toxic), counted(clean)
    dense = (hits.sum() + 0.5) / (lengths[hits > 0].sum() + 1)
    chance = (by_chance.sum() + 0.5) / (clean_lengths.sum() + 1)
    if dense <= chance:
        return None
    gain, loss = float(np.log(dense / chance)), float(dense - chance)
    slope, middle = _calibrate(gain * hits - loss * lengths, gain * by_chance - loss * clean_lengths)
    return DenseWords(table, b, gain, loss, slope, middle)


def _gapped(word: str) -> list[str]:
    """The word with a letter too many, at each inner place: what the machine shall forgive."""
    return [f"{word[:k]}{'xqz'[k % 3]}{word[k:]}" for k in range(1, len(word))]


def _sample(docs: DataFrame, labels: DataFrame, per_label: int) -> list[tuple[int, str]]:
    """(label, text) of at most ``per_label`` texts of each label, the first by a seeded hash of id and text.

    Ids and hashes alone are joined and dealt. What comes to the driver to be ordered is about twice
    the sample, whatever the number of labels; then its texts, picked where they lie by a broadcast of the sample.
    """
    digest = F.xxhash64("text")
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", digest.alias("digest"))
    wanted = labels.where("toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    narrow = staged(known.join(wanted, "doc_id").distinct().withColumn("order", F.xxhash64(F.lit(SEED), "doc_id", "digest")), "labelled")
    chosen = []
    for label, n in sorted(map(tuple, narrow.groupBy("toxic").count().collect())):
        own = narrow.where(F.col("toxic") == label)
        # so many more than needed that fewer pass with no chance worth the name
        upto = -2**63 + int(2**64 * (2 * per_label + 200) / n)
        if upto < 2**63:
            own = own.where(F.col("order") < upto)
        chosen += own.orderBy("order", "doc_id", "digest").limit(per_label).select("doc_id", "digest", "toxic").collect()
    if not chosen:
        return []
    picked = F.broadcast(docs.sparkSession.createDataFrame(chosen, narrow.select("doc_id", "digest", "toxic").schema))
    rows = docs.select("doc_id", "text", digest.alias("digest")).join(picked, ["doc_id", "digest"])
    # equal rows are one
    texts = rows.groupBy("doc_id", "digest", "toxic").agg(F.min("text").alias("text")).orderBy("toxic", "digest", "doc_id")
    return [(r["toxic"], r["text"]) for r in texts.collect()]


def train_toxicity(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> ToxicityModel:
    """Learn from (doc_id, text) and (doc_id, toxic): at most ``per_label`` texts of each label, the first by a seeded hash of id and text.

    Null ids, labels and texts and texts without words teach nothing; of copies one counts. The words of
    the sentences are the instances: a clean text has no toxic one, a toxic text has at least
    one. Toxic are the words that toxic texts have more often than chance allows, and, round by round, of
    toxic texts without such a word the one that the machine so far finds worst. Instances are projected on the span of the landmarks in the kernel's space; there
    the machine is linear, and its value is folded into one number per subsequence. Toxic texts that no telling word
    explains teach a second machine the words whose beginnings they have more densely than clean texts. Without texts
    of both labels every text gets a half.
    """
    bags = _without_copies([(toxic, plain_words(text)) for toxic, text in _sample(docs, labels, per_label)])
    counted, clean_counted = ([words for label, words in bags if label == k] for k in (1, 0))
    none = ToxicityModel(np.zeros(_LETTERS**ORDER, dtype=np.float32), 0.0, 0.0, 0.0)
    if not counted or not clean_counted:
        return none
    stems = set(_telling_stems(counted, clean_counted))

    def stemmed(texts: list[Counter[str]]) -> Counter[str]:
        return Counter(w for words in texts for w in words if not stems.isdisjoint(_stems(w)))

    dense_bad = stemmed(counted)
    dense_words = dense_bad.keys() | stemmed(clean_counted).keys()
    toxic, clean = ([words.keys() - dense_words for words in texts] for texts in (counted, clean_counted))
    telling = _telling(toxic, clean)
    if not telling and not dense_bad:
        return none

    common = Counter(w for s in clean for w in s if w not in telling)
    # a long word stands for its windows
    kinds = [telling, sorted(dense_bad, key=lambda w: (-dense_bad[w], w))]
    part = LANDMARKS // 2 // sum(map(bool, kinds))
    marks = [m for words in kinds for m in list(dict.fromkeys(m for w in words for m in _windows(w)))[:part]]
    frequent = sorted(common, key=lambda w: (-common[w], w))[:LANDMARKS]
    marks = list(dict.fromkeys([*marks, *(m for w in frequent for m in _windows(w))]))[:LANDMARKS]
    landmarks = Landmarks(marks)

    sure = set(telling) | {g for w in telling for g in _gapped(w)}
    in_clean = set().union(*clean) - sure
    clean_words = sorted(in_clean, key=lambda w: (zlib.crc32(w.encode()), w))[:NEGATIVES]
    negative = landmarks.project(clean_words)
    dense = None
    if dense_bad:
        unexplained = [words for words in counted if words.keys().isdisjoint(telling)]
        times = np.array([common[w] for w in clean_words], dtype=np.float32)
        dense = _dense_words(sorted(dense_bad), negative, times, landmarks, unexplained, clean_counted)
    if not telling:  # the dense words decide alone
        return ToxicityModel(none.table, 0.0, 1.0, 100.0, dense) if dense else none
    # texts that are toxic by dense words have nothing to teach the first machine
    toxic = [own for own, words in zip(toxic, counted) if own & sure or words.keys().isdisjoint(dense_words)]
    positive = sorted(sure)
    for _ in range(ROUNDS):
        w, b = _fit(landmarks.project(positive), negative)
        machine = ToxicityModel(landmarks.folded(w), b, 1.0, 0.0)
        # toxic texts without a telling word so far add their worst one, if the machine finds it toxic
        open_ = [words - in_clean for words in toxic if not words & sure]
        worst = [_worst(sorted(words), machine) for words in open_ if words]
        more = sorted(sure | {word for word, value in worst if value > 0})
        if more == positive:
            break
        positive = more
    slope, middle = _calibrate(*(np.array([_worst(sorted(words), machine)[1] for words in texts if words]) for texts in (toxic, clean)))
    return ToxicityModel(machine.table, machine.offset, slope, middle, dense)


def _worst(words: list[str], machine: ToxicityModel) -> tuple[str, float]:
    values = machine.word_values(words)
    k = int(values.argmax())
    return words[k], float(values[k])


def _fit(positive: np.ndarray, negative: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss. There are many more negatives, so as a class they weigh more; among them ``times`` are the weights."""
    x = np.vstack([positive, negative])
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))]).astype(np.float32)
    share = np.full(len(negative), 1 / len(negative)) if times is None else times / times.sum()
    c = np.concatenate([np.full(len(positive), 1 / len(positive)), NEGATIVE_WEIGHT * share]).astype(np.float32)
    w, b = np.zeros(x.shape[1], dtype=np.float32), np.float32(0)
    ahead_w, ahead_b = w, b
    rate = np.float32(0.5 / ((1 + NEGATIVE_WEIGHT) * (1 + (x * x).sum(axis=1).max())))
    for k in range(STEPS):
        slack = np.maximum(0, 1 - y * (x @ ahead_w + ahead_b)) * c * y
        new_w, new_b = ahead_w + rate * 2 * (x.T @ slack - SHRINK * ahead_w), ahead_b + rate * 2 * slack.sum()
        pull = np.float32(k / (k + 3))
        ahead_w, ahead_b, w, b = new_w + pull * (new_w - w), new_b + pull * (new_b - b), new_w, new_b
    return w, float(b)


def _calibrate(toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """A sigmoid through the cut that makes the fewest errors, in the middle of the gap around it."""
    values = np.concatenate([toxic, clean])
    label = np.concatenate([np.ones(len(toxic)), np.zeros(len(clean))])
    order = np.argsort(values, kind="stable")
    values, label = values[order], label[order]
    wrong = np.concatenate(([0], np.cumsum(label))) / len(toxic) + (len(clean) - np.concatenate(([0], np.cumsum(1 - label)))) / len(clean)
    cut = int(wrong.argmin())
    below = values[cut - 1] if cut else values[0] - 1
    above = values[cut] if cut < len(values) else values[-1] + 1
    spread = max(1e-3, float(np.median(toxic) - np.median(clean)))
    return float(8 / spread), float((below + above) / 2)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score (0 to 1) and worst_word of each row of (doc_id, text): the worst word of its worst sentence, whole texts.

    Or how densely the text has the words of the second machine, whichever is worse.

    A null or empty text, or one without a word of three letters, has the least score there is
    and no worst word. Repeated rows score alike; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, dense, machine = {}, set(), shared.value
        for batch in batches:
            for rows, texts in chunks(batch):
                counts = [Counter(sentence_words(t)) for t in texts]
                if len(known) > _CACHED_WORDS:
                    known.clear()
                    dense.clear()
                new = list(set().union(*counts).difference(known))
                letters = [plain(w) for w in new]
                distinct = list(set(letters))
                value, is_dense = machine.both_values(distinct)
                value, found = dict(zip(distinct, value.tolist())), {w for w, d in zip(distinct, is_dense) if d}
                known.update((w, value[p]) for w, p in zip(new, letters))
                dense.update(w for w, p in zip(new, letters) if p in found)
                worst = [max(c, key=lambda w: (known[w], w), default=None) for c in counts]
                values = np.array([known[w] if w is not None else -np.inf for w in worst])
                score = machine.chance(np.maximum(values, -1e6))
                hits = np.array([sum(c[w] for w in dense.intersection(c)) if dense else 0 for c in counts])
                some = np.flatnonzero(hits)
                if len(some):
                    lengths = np.array([sum(n for w, n in counts[i].items() if np.isfinite(known[w])) for i in some])
                    score[some] = np.maximum(score[some], machine.dense.chance(hits[some], lengths))
                yield pd.DataFrame({"doc_id": rows["doc_id"].array, "score": score,
                                    "worst_word": [w if np.isfinite(v) else None for w, v in zip(worst, values)]})

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {id_type}, score double, worst_word string")
