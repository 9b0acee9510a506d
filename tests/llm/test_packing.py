from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from postlens.llm.packing import pack_documents, packing_plan
from postlens.llm.tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 7, 500, 4000])
def test_plan_holds_every_piece_once(n):
    rng = np.random.default_rng(n)
    lengths = np.where(rng.random(n) < 0.3, 2048, rng.integers(1, 2049, n))
    counts = np.bincount(lengths, minlength=2049)
    held, sequences = Counter(), 0
    for items, copies in packing_plan(counts, rounds=20):
        assert sum(items) <= 2048 and copies > 0
        sequences += copies
        for k in items:
            held[k] += copies
    assert held == Counter(lengths.tolist())
    assert sequences <= max(1, 1.03 * -(-lengths.sum() // 2048) + 1) or n < 10


@pytest.mark.parametrize("text", [
    "", " ", "a", "The cat, sat.\nOn  the mat ", "x\n\ny", "don't we'll", "été là", "日本語 text", "<|endoftext|> b",
    "### a1b2$$$ %% 12.5\nNext", "\tTab", "a \n b", "mañana\r\nZ",
])
def test_ids_are_those_of_the_tokenizer(text):
    ids = np.frombuffer(encoder(PATH).encode([text])[0], dtype="<u4").tolist()
    assert ids == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_round_trip(spark):
    texts = ["word " * 5000, None, "", "short one", "short one", "a b c d " * 700]
    docs = spark.createDataFrame([(i if i != 4 else None, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, length int")
    rows = pack_documents(docs, PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    places: dict[int, list] = {}
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        own = sorted((r for r in rows if r["doc_id"] == (i if i != 4 else None)), key=lambda r: r["piece"])
        assert [r["start"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        assert sum(r["length"] for r in own) == len(ids)
        assert all(r["length"] == 2048 for r in own[1:])
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in places.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(places) <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_no_rows(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
