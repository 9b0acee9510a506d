from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postlens.llm.langid import (
    AMBIGUOUS_MARGIN,
    BITS,
    FEATURES,
    ORDERS,
    UNDETERMINED,
    LanguageModel,
    codewords,
    identify_language,
    train_language_id,
)

SCHEMA = "doc_id long, text string, lang string, `__lang` string"


@pytest.mark.parametrize("n", [1, 2, 4, 5, 12, 40])
def test_codewords_are_apart(n):
    code = codewords(n)
    assert code.shape[0] == n
    if n > 2:
        apart = (code[:, None, :] != code[None]).sum(axis=2) + 1000 * np.eye(n, dtype=int)
        assert apart.min() >= 2
        assert (np.abs(code.sum(axis=0)) < n).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = train_language_id(docs.where(~held_out), per_language=80)
    found = identify_language(docs.where(held_out), model)
    assert found.where(F.col("lang") == F.col("__lang")).count() >= 0.98 * found.count()
    assert found.where("__lang_score < 0 OR __lang_score > 1").count() == 0


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "", None), (5, "12 %$ 34", "de"),
            (None, "the dog", None), (1, "the cat and the dog", "en"), (6, "日本", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train_language_id(docs)
    found = identify_language(docs, model).collect()
    assert len(found) == len(rows)
    for r in found:
        undetermined = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["__lang"] == UNDETERMINED) == undetermined
    empty = docs.limit(0)
    assert identify_language(empty, train_language_id(empty)).count() == 0
    assert {r["__lang"] for r in identify_language(docs, train_language_id(empty)).collect()} == {UNDETERMINED}


def test_blank_texts_take_no_place_in_the_sample(spark):
    rows = [(i, "-- 12 --", "en") for i in range(200)] + [(900, "the cat and the dog", "en"), (901, "der Hund und die Katze", "de")]
    model = train_language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=2)
    assert model.languages == ("de", "en")


def test_stage_keeps_texts_where_no_language_is_known(spark):
    rows = [(1, "the cat and the dog", None), (2, "12 34", None), (3, None, None), (4, "der Hund", None), (5, "12", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {tuple(r) for r in corpus_pipeline.identified(spark, docs, "").collect()} == {rows[0], rows[3]}


def test_stage_drops_ambiguous_texts_and_no_clean_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    odd = [(-1, "ภาษาไทยเป็นภาษาที่มี " * 9, None), (-2, "Η γλώσσα είναι ένα σύστημα επικοινωνίας " * 5, None), (-3, "12 34", None)]
    kept = corpus_pipeline.identified(spark, docs.unionByName(spark.createDataFrame(odd, docs.schema)), "")
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()}


def plain_features(text: str) -> np.ndarray:
    """Shares of hashed n-grams, one n-gram at a time."""
    letters = [p if p >= 0xAA or 97 <= p <= 122 else 32 for p in map(ord, text.lower())]
    out = np.zeros(FEATURES)
    for at, order in enumerate(ORDERS):
        found = []
        padded = [*letters, 32]
        for k in range(len(letters) - order + 2):
            gram = padded[k:k + order]
            if gram[0] == 32 and (order == 1 or gram[1] == 32):
                continue
            h = 0
            for p in gram:
                h = (h * 0x01000193 + p) % 2**32
            found.append((h * 0x9E3779B1 % 2**32) >> (32 - BITS))
        for slot in found:
            out[(at << BITS) + slot] += 1 / len(found)
    return np.sqrt(out)


def decoded(model, features: np.ndarray) -> tuple[str, float, bool]:
    """Losses of all codewords, bit by bit."""
    losses = []
    for word in model.code:
        total = 0.0
        for bit in range(len(word)):
            margin = float(features @ model.weights[:, bit].astype(np.float64)) + float(model.bias[bit])
            total += model.trust[bit] * math.log1p(math.exp(-margin * word[bit]))
        losses.append(total / sum(model.trust))
    ranked = sorted(range(len(losses)), key=lambda k: (losses[k], k))
    chance = 1 / sum(math.exp(-(x - losses[ranked[0]]) * sum(model.trust)) for x in losses)
    return model.languages[ranked[0]], chance, losses[ranked[1]] - losses[ranked[0]] < AMBIGUOUS_MARGIN


def test_predictions_against_a_plain_decoder(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = train_language_id(docs, per_language=30)
    more = [(900, "Straße, 数学 und mehr!", None), (901, "word " * 40_000, None), (902, "a", None), (903, "12 .. 34", None), (904, None, None), (905, "ab ab", None), (906, "ab ab", None)]
    rows = docs.where("doc_id % 7 = 0").unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    for r in identify_language(rows, model).collect():
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["__lang"], r["__lang_score"], r["__ambiguous"]) == (UNDETERMINED, 0.0, False)
            continue
        lang, score, near = decoded(model, plain_features(r["text"]))
        assert r["__lang"] == lang and abs(r["__lang_score"] - score) < 1e-3 and r["__ambiguous"] == near


def test_equally_near_codewords():
    """Without any feature all codewords of a model without bias are as near: the first by name wins, and it is flagged."""
    code = codewords(3)
    model = LanguageModel(("aa", "bb", "cc"), code, np.zeros((FEATURES, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32), np.ones(code.shape[1]))
    best, score, near = model.decode(np.zeros((2, FEATURES), np.float32))
    assert best.tolist() == [0, 0] and score == pytest.approx([1 / 3] * 2) and near.tolist() == [True, True]
