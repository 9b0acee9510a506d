from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm.components import components, forest
from postlens.llm.ngram_join import (
    _may_link,
    _other_candidates,
    first_of_each_component,
    least_overlap,
    may_agree,
    ngram_components,
    signature,
    trie_links,
)


def gram_set(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def brute_force(texts: list[str | None]) -> list[int]:
    sets, label = [gram_set(t) for t in texts], list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j in range(i):
                b = sets[j]
                if a and b and label[i] != label[j] and 100 * len(a & b) >= 85 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def family(rng: random.Random, words: int, copies: int, edits: int) -> list[str]:
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(copies):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def corpus() -> list[str | None]:
    rng = random.Random(5)
    texts: list[str | None] = [None, "", " \n", "a", "A", "a b", "a b c d", "A b\tc D", "a b c d e"]
    for words, copies, edits in ((12, 6, 1), (60, 12, 3), (300, 20, 14), (900, 5, 30)):
        texts += family(rng, words, copies, edits)
    passage = " ".join(f"p{k}" for k in range(50))
    texts += [passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 80))) for _ in range(25)]
    chain = [f"c{k}" for k in range(140)]
    texts += [" ".join(chain[k:k + 100]) for k in range(0, 40, 2)]
    return texts


def test_same_as_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, node int, component_id int")
    found = {r["doc_id"]: r for r in ngram_components(docs.repartition(4)).collect()}
    want = brute_force(texts)
    assert len(found) == len(texts)
    for i, label in enumerate(want):
        assert found[i]["component_id"] == label, i
        assert found[i]["n_shingles"] == len(gram_set(texts[i]))
    kept = {r["doc_id"] for r in first_of_each_component(docs).collect()}
    assert kept == {i for i, label in enumerate(want) if i == label}


def test_odd_ids(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(None, text), (5, text), (5, text), (9, text + " more"), (9, "quite another text of more than four words"), (None, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ngram_components(docs).count() == len(rows)
    kept = [r["doc_id"] for r in first_of_each_component(docs).collect()]
    assert sorted(map(repr, kept)) == ["5", "9", "9", "None", "None"]
    assert ngram_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_trie_finds_what_sets_tell(seed):
    rng = np.random.default_rng(seed)
    base = rng.choice(10_000, 200, replace=False).astype(np.uint64)
    members = []
    for _ in range(60):
        keep = base[rng.random(200) > rng.random() * 0.2]
        members.append(np.sort(np.concatenate([keep, 20_000 + rng.choice(1000, rng.integers(0, 30), replace=False).astype(np.uint64)])))
    probe = np.sort(base)
    want = [i for i, m in enumerate(members) if len(np.intersect1d(m, probe)) >= least_overlap(len(m), len(probe), 85)]
    assert sorted(trie_links(probe, members, 85)) == want


def test_components(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 400, 300), rng.integers(0, 400, 300)
    links = np.concatenate([np.column_stack([a, b]), [[1000 + k, 1001 + k] for k in range(60)]])
    rows = [(int(x), int(y)) for x, y in links]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows, "a long, b long").repartition(5)).collect()}
    node, root = forest(links[:, 0], links[:, 1])
    want = dict(zip(node.tolist(), root.tolist()))
    for n in {n for x, y in rows if x != y for n in (x, y)}:
        assert found[n] == want.get(n, n)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_rule_out_no_link():
    rng = np.random.default_rng(4)
    ruled_out = 0
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = rng.integers(0, 2**64, n, dtype=np.uint64)
        b = np.unique(np.concatenate([a[rng.random(n) < rng.uniform(0.7, 1)], rng.integers(0, 2**64, int(rng.integers(0, n // 4 + 2)), dtype=np.uint64)]))
        a = np.unique(a)
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 85 * (len(a) + len(b) - both):
            assert may_agree(len(a), signature(a), len(b), signature(b), 85)
        other = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        ruled_out += not may_agree(len(a), signature(a), len(other), signature(other), 85)
    assert ruled_out >= 390


def test_many_members_of_one_component_and_a_few_others(spark):
    """Pairs within the large component are never formed, whatever its size."""
    n, others = 20_000, 10
    rows = spark.range(n + others).select(
        F.lit(7).cast("long").alias("gram"), F.col("id").alias("a"), F.lit(0).alias("pos"), F.lit(50).alias("size"),
        F.when(F.col("id") < n, 0).otherwise(F.col("id")).cast("long").alias("component"))
    found = _other_candidates(rows, 85)
    assert found.agg(F.count("*"), F.countDistinct("b")).first() == (n * others + others * (others - 1) // 2, others)
    assert found.where(f"a >= {n} AND b < {n} OR a >= b OR a < {n} AND b < {n}").count() == 0


def test_members_meet_once_and_only_where_lengths_allow(spark):
    rng = random.Random(2)
    rows = [(g, a, rng.randrange(12), rng.choice([40, 50, 60]), rng.choice([1, 1, 1, 2, 3, a + 100])) for g in range(5) for a in range(rng.choice([1, 2, 40, 900]))]
    got = sorted(map(tuple, _other_candidates(spark.createDataFrame(rows, "gram long, a long, pos int, size int, component long"), 85).collect()))
    want = set()
    for g in range(5):
        own = [r for r in rows if r[0] == g]
        x = np.array(own)
        link = _may_link(x[:, None, 3], x[:, None, 2], x[None, :, 3], x[None, :, 2], 85) & (x[:, None, 4] != x[None, :, 4])
        want |= {(own[i][1], own[j][1]) for i, j in zip(*np.nonzero(link)) if own[i][1] < own[j][1]}
    assert got == sorted(want)
