from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest

from postlens.llm.toxicity import DECAY, ORDER, Landmarks, _sample, against_tables, plain, score_toxicity, sentence_words, train_toxicity


def kernel(a: str, b: str) -> float:
    """The gap-weighted subsequence kernel by listing all subsequences, normalized."""
    def features(word: str) -> dict:
        word, out = f"<{word}<", {}
        for at in combinations(range(len(word)), ORDER):
            key = "".join(word[i] for i in at)
            out[key] = out.get(key, 0) + DECAY ** (at[-1] - at[0] + 1)
        return out

    x, y = features(a), features(b)
    norm = np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    return sum(v * y.get(k, 0) for k, v in x.items()) / norm


def test_kernel_by_tables():
    words = ["idiot", "idxiot", "loser", "closer", "banana", "réeux"]
    landmarks = Landmarks(words)
    found = against_tables(words, landmarks.tables, landmarks.column)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert found[i, j] == pytest.approx(kernel(a, b), abs=1e-5)
    # on the span of the landmarks, projections have the kernel as inner product, and folding changes nothing
    x = landmarks.project(words)
    assert x @ x.T == pytest.approx(found, abs=1e-4)
    w = np.arange(x.shape[1], dtype=np.float32)
    assert against_tables(words, landmarks.folded(w)[None])[:, 0] == pytest.approx(x @ w, abs=1e-3)


@pytest.mark.parametrize("word, letters", [
    ("Idiot!!", "idiot"), ("i.d-i_o*t", "idiot"), ("1d10t", "idiot"), ("$cum", "scum"), ("été,", "été"), ("...", ""), ("", ""),
])
def test_plain(word, letters):
    assert plain(word) == letters


def test_letters_that_stand_alone_are_one_word():
    assert sentence_words("you l o s e r there, a b") == ["you", "loser", "there,", "a", "b"]


def labelled(spark, n=240):
    rng = np.random.default_rng(0)
    syllables = ["th", "an", "er", "on", "in", "re", "nd", "ha", "ou", "es", "ti", "at"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(syllables, rng.integers(2, 5))) for _ in range(60)]
        toxic = i % 3 == 0
        if toxic:
            words[int(rng.integers(0, 60))] = ["scumbag", "moron", "worthless"][i // 3 % 3]
        rows.append((i, " ".join(words) + ".", int(toxic), "en"))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, score string")


def test_held_out_and_gapped_insults(spark):
    docs = labelled(spark)
    model = train_toxicity(docs, docs.where("doc_id % 5 <> 0").select("doc_id", "toxic"))
    found = {r["doc_id"]: r["score"] for r in score_toxicity(docs, model).collect()}
    right = [(found[r["doc_id"]] >= 0.5) == bool(r["toxic"]) for r in docs.where("doc_id % 5 = 0").collect()]
    assert np.mean(right) >= 0.95
    cases = ["you are a m.o.r.o.n today", "what a w o r t h l e s s thing", "such a scuxmbag he is", "m0ron"]
    clean = ["the other and on", "", None, "12 34"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(cases + clean)], "doc_id long, text string")
    scores = [r["score"] for r in sorted(score_toxicity(frame, model).collect(), key=lambda r: r["doc_id"])]
    assert min(scores[:4]) >= 0.5 > max(scores[4:])
    assert all(0 <= s <= 1 for s in scores)


def test_nothing_to_learn_from(spark):
    docs = labelled(spark, 6)
    model = train_toxicity(docs.limit(0), docs.limit(0))
    assert {r["score"] for r in score_toxicity(docs, model).collect()} == {0.5}
    assert score_toxicity(docs.limit(0), model).count() == 0


def test_the_sample_is_bounded_and_blind_to_how_rows_lie(spark):
    rows = [(i, f"text {i}", "x") for i in range(3000)] + [(5, "text 5", "y")] * 400 + [(6, "another text", "x"), (None, "no id", "x"), (7, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    labels = spark.createDataFrame([(i, i % 3 if i % 3 < 2 else None) for i in range(3000)] + [(5, 0), (6, 0), (None, 1)], "doc_id long, toxic int")
    got = _sample(docs, labels, 100)
    assert sorted(label for label, _ in got) == [0] * 100 + [1] * 100 and len(set(got)) == 200
    assert got == _sample(docs.repartition(7), labels.repartition(3), 100)
    every = _sample(docs, labels, 5000)
    assert set(every) == {(labels_, text) for i, text, _ in rows if i is not None and text for labels_ in ([0] if i == 6 else []) + ([i % 3] if i % 3 < 2 else []) + ([0] if i == 5 else [])}


def test_long_words_are_learned_and_rates_decide(spark):
    """A toxic word of 19 letters, in a corpus with ten clean texts to a toxic one of which some hold it."""
    rng = np.random.default_rng(1)
    syllables = ["th", "an", "er", "on", "in", "re", "nd", "ha", "ou", "es"]
    rows = []
    for i in range(660):
        words = ["".join(rng.choice(syllables, rng.integers(2, 5))) for _ in range(30)]
        toxic = i % 11 == 0
        if toxic or i % 97 == 5:
            words[3] = "abominablescoundrel"
        rows.append((i, " ".join(words) + ".", int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = train_toxicity(docs, docs)
    cases = spark.createDataFrame([(0, "an abominablescoundrel here"), (1, "ab0minable-scoundrel"), (2, "there on the hand")], "doc_id long, text string")
    scores = [r["score"] for r in sorted(score_toxicity(cases, model).collect(), key=lambda r: r["doc_id"])]
    assert min(scores[:2]) >= 0.5 > scores[2]


@pytest.mark.parametrize("text", ["moron " + "word " * 200_000, "x" * 300_000])
def test_very_long_texts(spark, text):
    docs = labelled(spark)
    model = train_toxicity(docs, docs)
    row = score_toxicity(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string"), model).collect()
    assert row[0]["score"] == row[1]["score"] and (row[0]["score"] >= 0.5) == text.startswith("moron")


def test_beginnings_of_words_tell_by_how_dense_they_are(spark):
    """Toxic by words that share a beginning, each of them rare; clean texts have such words by chance, and share most of their short ones."""
    rng = np.random.default_rng(3)
    syllables = ["las", "bo", "cod", "mir", "que", "tar", "ez", "ga", "rro", "nes", "asi", "dun"]

    def text(toxic, n=120):
        words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n)] + ["las", "cod", "mir", "que"]
        if toxic:
            for at in rng.choice(n, max(1, n // 40), replace=False):
                words[at] = "gabo" + "".join(rng.choice(syllables, 2))
        return " ".join(words) + "."

    docs = spark.createDataFrame([(i, text(i % 6 == 0), int(i % 6 == 0)) for i in range(1500)], "doc_id long, text string, toxic int")
    model = train_toxicity(docs, docs.where("doc_id % 5 <> 0").select("doc_id", "toxic"))
    found = {r["doc_id"]: r["score"] >= 0.5 for r in score_toxicity(docs, model).collect()}
    held = [(r["toxic"], found[r["doc_id"]]) for r in docs.where("doc_id % 5 = 0").collect()]
    assert np.mean([f for toxic, f in held if toxic]) >= 0.9
    assert np.mean([not f for toxic, f in held if not toxic]) >= 0.9
