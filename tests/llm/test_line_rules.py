from __future__ import annotations

import re
from collections import Counter

from postlens.llm.line_rules import clean_lines

TEXTS = [
    None, "", " \n\t", "one two.", "The cat sat on the mat and looked at all of us.\nHome | News | Sport | More\nIt was a long day.",
    "a b c d e f a b c d e g h i j k l m n o p.", "x " * 40, "same line here.\nsame line here.\nsame line here.\n\nother words stand in this one.",
    "All rights reserved.\n$$$ ### x.\nNo end here", "é ü ß 日本 #*$%&|<> one two three four five six seven.", "a b c d e " * 30 + ".",
    "w\x0bx\x0cy\rz " * 5 + "end.",
]


def facts(text: str | None) -> dict:
    """The counts, by brute force."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    times = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if times[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside),
            "base_failed": n < 10 or 100 * len(inside) > 20 * n}


def test_counts_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(TEXTS)], "doc_id long, text string, kept boolean")
    for r in clean_lines(docs).collect():
        for name, value in facts(TEXTS[r["doc_id"]]).items():
            assert r[f"__{name}"] == value, (r["doc_id"], name)
        assert r["kept"] is True
        if r["__base_failed"]:
            assert not r["__kept"]


def test_lines_that_fail_go(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in clean_lines(docs).collect()}
    assert rows[4]["__clean_text"] == "The cat sat on the mat and looked at all of us.\nIt was a long day."
    assert rows[4]["__kept"]
    assert rows[7]["__clean_text"] == "same line here.\nother words stand in this one."
    assert rows[8]["__clean_text"] == ""


def test_a_long_line_takes_linear_time(spark):
    docs = spark.createDataFrame([(1, "word and | more " * 40_000)], "doc_id long, text string")
    assert clean_lines(docs).first()["__n_words"] == 160_000


def test_no_rows(spark):
    assert clean_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
