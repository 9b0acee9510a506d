from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from postlens.llm import kneser_ney
from postlens.llm.kneser_ney import Discounts, score, train

SCHEMA = "doc_id long, text string, score int"


def tokens(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + ["</end>"]


class BruteForce:
    """The same model from plain dictionaries."""

    def __init__(self, texts, order):
        self.order, self.words, grams = order, Counter(), Counter()
        for text in texts:
            t = tokens(text)
            self.words.update(t)
            padded = ["<start>"] * (order - 1) + t
            grams.update(tuple(padded[i:i + order]) for i in range(len(t)))
        #: Counts of each order; a lower order counts different words before.
        self.grams = {order: grams}
        for k in range(order - 1, 0, -1):
            self.grams[k] = Counter(g[1:] for g in self.grams[k + 1])
        self.d = {k: Discounts.of([sum(c == n for c in g.values()) for n in (1, 2, 3, 4)]).values for k, g in self.grams.items()}

    def chance(self, context, w):
        k = len(context) + 1
        lower = self.chance(context[1:], w) if context else 1 / (len(self.words) + 1)
        follow = [c for g, c in self.grams[k].items() if g[:-1] == context]
        if not follow:
            return lower
        c = self.grams[k][(*context, w)]
        taken = sum(self.d[k][min(n, 3)] for n in follow)
        return (max(c - self.d[k][min(c, 3)], 0) + taken * lower) / sum(follow)

    def score(self, text):
        padded = ["<start>"] * (self.order - 1) + tokens(text)
        n = self.order - 1
        return sum(math.log10(self.chance(tuple(padded[i - n:i]), padded[i])) for i in range(n, len(padded)))

    def base(self, text):
        n, v = sum(self.words.values()), len(self.words)
        return sum(math.log10((self.words[w] + 1) / (n + v + 1)) for w in tokens(text))


TRAIN = ["The cat sat on the mat", "the cat ate", "a dog sat on the cat", None, "", "dog dog dog dog", "the the the the " * 200, "a b c d", "a b c e", "a b f"]
TEST = ["the cat sat", "unknown words here", None, "", "A  DOG\tsat", "the dog ate unknown cat", "a b c d"]


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("shards", [1, 5])
def test_same_as_dictionaries(spark, shards, order):
    train_docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TRAIN)], SCHEMA)
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEST)], SCHEMA)
    model, want = train(train_docs, shards=shards, order=order), BruteForce(TRAIN, order)
    assert shards == 1 or model.vocabulary.hot  # a hot word's triples lie in several shards
    assert model.vocabulary.tokens == sum(want.words.values())
    for r in score(docs, model).collect():
        text = TEST[r["doc_id"]]
        assert r["score"] == pytest.approx(want.score(text), rel=1e-9)
        assert r["base_score"] == pytest.approx(want.base(text), rel=1e-9)
        assert r["n_tokens"] == len(tokens(text))
        assert r["n_known"] == sum(w in want.words for w in tokens(text))


@pytest.mark.parametrize("order", [2, 3])
def test_chances_add_up_to_one(order):
    want = BruteForce(TRAIN, order)
    for before in (("<start>", "the"), ("<start>", "<start>"), ("a", "b"), ("the", "the"), ("nothing", "a"), ("a", "nothing")):
        total = sum(want.chance(before[3 - order:], w) for w in want.words) + want.chance(before[3 - order:], "some unknown word")
        assert total == pytest.approx(1)


def test_no_other_order(spark):
    with pytest.raises(ValueError, match="order"):
        train(spark.createDataFrame([], SCHEMA), order=4)


def test_tables_by_hash(tmp_path):
    random = np.random.default_rng(1)
    for n in (1, 7, 8, 5000):
        hashes = np.unique(random.integers(0, 2**64, n, dtype=np.uint64))
        values = np.column_stack([random.choice([0, 1, 254, 255, 256, 2**40], len(hashes)), np.arange(len(hashes))])
        kneser_ney._save_table(str(tmp_path), f"t{n}", hashes, values)
        asked = np.concatenate([random.permutation(hashes), random.integers(0, 2**64, 100, dtype=np.uint64)])
        want = dict(zip(hashes.tolist(), values.tolist()))
        assert kneser_ney._look_up(str(tmp_path), f"t{n}", asked, 2).tolist() == [want.get(h, [0, 0]) for h in asked.tolist()]
    assert kneser_ney._look_up(str(tmp_path), "none", hashes, 2).sum() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b", 1), (None, None, None)], SCHEMA)
    model = train(docs.limit(0))
    assert [r["score"] for r in score(docs, model).collect()] == [0.0, 0.0]
    assert score(docs.limit(0), train(docs)).count() == 0


def test_a_model_needs_a_mounted_folder(spark):
    with pytest.raises(ValueError, match="mounts"):
        kneser_ney._folder(spark, "s3a://bucket/models")


def test_totals_above_32_bits():
    rows = np.array([[5_000_000_000, 1, 2, 3], [2**40, 0, 0, 7]], dtype=np.int64)
    ids = np.array([12, 14], dtype=np.uint64)
    packed = kneser_ney._pack_sorted(ids), kneser_ney._pack(rows.ravel())
    table = kneser_ney.added(10, 16, 4, [packed[0]] * 2, [packed[1]] * 2)
    assert table[2].tolist() == [10_000_000_000, 2, 4, 6] and table[4].tolist() == [2**41, 0, 0, 14] and table.sum() == 2 * rows.sum()


def test_a_path_of_another_file_system_is_refused():
    class Conf:
        def get(self, key):
            return "hdfs://name"

    class Session:
        _jsc = type("Context", (), {"hadoopConfiguration": staticmethod(Conf)})

    for folder in ("/models", "s3://bucket/models"):
        with pytest.raises(ValueError, match="mounts"):
            kneser_ney._folder(Session(), folder)
