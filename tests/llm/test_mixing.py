from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from postlens.llm.mixing import mix_sources, mixed_documents

SCHEMA = "doc_id long, text string, source string, n_chars long, target string"


def targets_in_rounds(sizes: dict, share=1.5, epochs=2) -> dict:
    """Clamp and redistribute until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, fixed = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / total >= epochs * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / total for s in rest}
        for s in over:
            fixed[s] = epochs * sizes[s]
        left -= sum(fixed[s] for s in over)


def documents(spark):
    rows = [(i, " ".join(["w"] * (i % 37)), f"s{i % 5}" if i % 3 else "s0", i, "x") for i in range(300)]
    rows += [(None, "a b c", None, 5, None), (7, None, None, None, "x"), (301, "", "only empty", 0, "x"), (5, rows[5][1], rows[5][2], 5, "x")]
    return spark.createDataFrame(rows, SCHEMA)


def test_against_rounds(spark):
    rows = mix_sources(documents(spark)).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["__size"] == len((r["text"] or "").split())
        sizes[r["source"]] += r["__size"]
        taken[r["source"]] += r["__taken"]
    want = targets_in_rounds(dict(sizes))
    for r in rows:
        assert r["__source_size"] == sizes[r["source"]]
        assert r["__target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["__taken"] <= 2 * r["__size"]
    for s, t in taken.items():
        assert abs(t - want[s]) <= 0.5
    assert len(rows) == 304


def test_reruns_agree_and_the_mix_holds_what_is_taken(spark):
    docs = documents(spark)
    first = sorted(map(repr, mix_sources(docs).collect()))
    assert first == sorted(map(repr, mix_sources(docs.repartition(3)).collect()))
    mix = mixed_documents(docs)
    assert mix.columns == docs.columns
    words = mix.select(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert words == mix_sources(docs).agg(F.sum("__taken")).first()[0]


def test_no_rows(spark):
    assert mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
