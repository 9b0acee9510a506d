from __future__ import annotations

from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from postlens.llm import alignment
from postlens.llm.alignment import align_tokenizers, tokenizers
from postlens.llm.tokens import _ranks

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_a string, pair string, row string"
SF = "/root/testdata/sf0.001/documents.parquet"

TEXTS = [
    "plain words only", "it's  two spaces\n\nand lines\t tab \n", "\nstarts with a line", " leading", "trailing ", "naïve café über straße ſtill",
    "数学 и 한국어 🙂🙂🏽 x́", "<|endoftext|> and <s> </s> <unk> <0x41>", "under▁score", "▁", " ", "\n", "\x00\x01 null", "a" * 400, "'s 'll we've DON'T",
    "x" + " " * 40 + "y", "　wide space line", "1234567890 3.14 #$%^ {}[]", "ﬁ ½ Å", "é ﻿", "antidisestablishmentarianism " * 3,
]


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    bytes_a = {k: t for t, k in _ranks(BPE).items()}

    def tokens(text: str) -> tuple[list[tuple[int, bytes]], list[tuple[int, bytes]]]:
        if not text:
            return [], []
        ids_a = [(k, bytes_a[k]) for k in a.encode(" " + text, add_special_tokens=False).ids]
        ids_b = [(k, bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()) for k in b.encode(text)]
        want = (" " + text).encode()
        same = b"".join(t for _, t in ids_a) == want == b"".join(t for _, t in ids_b)
        return (ids_a, ids_b) if same else ([], [])
    return tokens


def by_hand(texts: list[str | None], tokens) -> list[tuple]:
    docs, held = [], Counter()
    for text in texts:
        spans = []
        for side in tokens(text or ""):
            at, out = 0, []
            for k, t in side:
                out.append((k, at, at + len(t)))
                at += len(t)
            spans.append(out)
        a, b = spans
        links = [(x[0], y[0]) for x in a for y in b if max(x[1], y[1]) < min(x[2], y[2])]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = ["|".join(",".join(str(k) for k, s, e in side if low <= s and e <= high) for side in (a, b)) for low, high in zip([0, *cuts], cuts)]
        docs.append((len(a), len(b), len(cuts), links, sha256(";".join(groups).encode()).hexdigest() if a else ""))
        held.update(set(links))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return [(n_a, n_b, g, len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), h) for n_a, n_b, g, links, h in docs]


def answer(df) -> list[tuple]:
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("hot", [500_000, 40, 0])
def test_against_all_pairs_of_spans(spark, plain, hot):
    texts = [*TEXTS, None, "", "plain words only", "plain words only", "plain words, other words"]
    rows = [(None if k == 3 else 7 if k < 3 else k, t, "x", "y", "z") for k, t in enumerate(texts)]
    got = answer(align_tokenizers(spark.createDataFrame(rows, SCHEMA), BPE, PIECES, hot))
    want = [(r[0], *w) for r, w in zip(rows, by_hand(texts, plain))]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert (len(TEXTS), *[0] * 6, "") in got


def test_real_texts(spark, plain):
    docs = spark.read.parquet(SF).where("length(text) < 3000")
    texts = docs.select("doc_id", "text").collect()
    assert sorted(answer(align_tokenizers(docs, BPE, PIECES, 300))) == sorted((r[0], *w) for r, w in zip(texts, by_hand([r[1] for r in texts], plain)))


def test_words_give_the_ids_of_whole_texts(spark, plain, monkeypatch):
    two = tokenizers(BPE, PIECES)
    assert two.by_word
    monkeypatch.setattr(alignment, "CACHED_WORDS", 50)
    texts = [r[0] for r in spark.read.parquet(SF).select("text").collect()] + TEXTS
    for text, a, b in zip(texts, *two.encode(texts)):
        assert tuple([int.from_bytes(x[i:i + 4], "little") for i in range(0, len(x), 4)] for x in (a, b)) == tuple([k for k, _ in side] for side in plain(text))


def test_long_text_empty_table_and_small_pieces(spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_PAIRS", 3)
    long = "lorem ipsum dolor sit amet " * 20_000
    got = answer(align_tokenizers(spark.createDataFrame([(1, long, "", "", ""), (2, "lorem ipsum", "", "", "")], SCHEMA), BPE, PIECES))
    n_a, n_b = (len(side) for side in plain(long))
    long_row = next(r for r in got if r[0] == 1)
    assert long_row[1:3] == (n_a, n_b) and long_row[4] == n_a + n_b - long_row[3] and len(got) == 2
    assert align_tokenizers(spark.createDataFrame([], SCHEMA), BPE, PIECES).count() == 0
