from __future__ import annotations

import numpy as np
import pytest

from postlens.llm import hnsw
from postlens.llm.hnsw import Graph, audited_links, embedding_components, planted, unit

SCHEMA = "vec_id long, embedding array<float>, label int, component_id int"


def clusters(rng, n: int, size: int, width: int = 16) -> np.ndarray:
    centers = rng.normal(size=(n, width))
    return np.concatenate([c + rng.normal(scale=0.12, size=(size, width)) for c in centers]).astype(np.float32)


def brute_force(ids, vectors, labels, threshold=0.93):
    v = vectors.astype(np.float64)
    cosine = (v @ v.T) / np.sqrt((v * v).sum(axis=1)[:, None] * (v * v).sum(axis=1)[None])
    link = (cosine >= threshold) & (labels[:, None] == labels[None])
    np.fill_diagonal(link, False)
    label = ids.copy()
    while True:
        new = np.minimum(label, np.where(link, label[None], np.iinfo(np.int64).max).min(axis=1))
        if (new == label).all():
            return link.sum(axis=1), label
        label = new


@pytest.mark.parametrize("shard_rows", [8000, 60])
def test_same_as_brute_force(spark, shard_rows):
    rng = np.random.default_rng(2)
    v = clusters(rng, 40, 8)
    v = np.concatenate([v, v[:30], v[:5]])  # equal vectors
    labels = rng.integers(0, 2, len(v))
    labels[-35:] = np.concatenate([labels[:30], labels[:5]])
    ids = rng.permutation(len(v)) + 100
    rows = [(int(i), x.tolist(), int(k), 1) for i, x, k in zip(ids, v, labels)]
    odd = [(1, None, 0, 1), (2, [0.0] * 16, 0, 1), (3, [float("nan")] + [1.0] * 15, 1, 1), (4, [1.0] * 16, None, 1), (5, [None] + [1.0] * 15, 1, 1),
           (6, [], 1, 1), (7, [1.0, 2.0], 0, 1), (None, v[0].tolist(), int(labels[0]), 1), (8, [float("inf")] + [1.0] * 15, 1, 1)]
    found = embedding_components(spark.createDataFrame(rows + odd, SCHEMA), shard_rows=shard_rows).collect()
    assert len(found) == len(rows) + len(odd)
    n, component = brute_force(ids, v, labels)
    by_id = {r["vec_id"]: r for r in found}
    for i, k, c in zip(ids, n, component):
        assert (by_id[i]["n_links"], by_id[i]["component_id"], by_id[i]["kept"]) == (k, c, i == c)
    for row in odd:
        assert (by_id[row[0]]["n_links"], by_id[row[0]]["component_id"]) == (0, row[0])


def test_beams_widen_until_a_large_cluster_is_found():
    rng = np.random.default_rng(4)
    v = unit(np.concatenate([rng.normal(size=(600, 24)), rng.normal(size=24) + rng.normal(scale=0.05, size=(700, 24))]))
    graph = Graph.build(v, np.arange(len(v)))
    copy = Graph.load(v, **graph.dump())
    found, _ = audited_links(copy, v, 0.93, np.arange(0, len(v), 20))
    truth = v @ v.T >= 0.93
    assert (found & truth).sum() >= 0.99 * truth.sum()


def test_a_large_group_does_not_hide_missed_pairs():
    """A graph that lost the way to small groups passes no audit, whatever share of all links it finds."""
    rng = np.random.default_rng(9)
    group = rng.normal(size=24) + rng.normal(scale=0.05, size=(800, 24))
    left = rng.normal(size=(60, 24))
    v = unit(np.concatenate([group, left, left + rng.normal(scale=0.02, size=left.shape)]))
    graph = Graph.build(v, np.arange(len(v)))
    for table in graph.links:
        table[800:] = -1
        table[table >= 800] = -1
    graph.nodes[-1] = np.array([0, *graph.nodes[-1]])
    truth = v @ v.T >= 0.93
    found, _ = audited_links(graph, v, 0.93, np.arange(0, len(v), 5), same=True)
    assert (found & truth).sum() == truth.sum()


def test_links_that_the_sample_lacks_are_found():
    rng = np.random.default_rng(10)
    v = rng.normal(size=(300, 24))
    v[299] = v[298] + 0.01
    v = unit(v)
    graph = Graph.build(v, np.arange(len(v)))
    for table in graph.links:
        table[298:] = -1
        table[table >= 298] = -1
    found, beam = audited_links(graph, v, 0.93, np.arange(0, 290, 10), same=True)
    # two of 300 nodes can't be reached by any walk
    assert graph.unreached().tolist() == [298, 299] and found[298, 299] and found[299, 298]


def test_no_rows(spark):
    assert embedding_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_planted_queries_link():
    v = unit(np.random.default_rng(1).normal(size=(500, 24)))
    q = planted(v, 100, 0.93)
    best = (q @ v.T).max(axis=1)
    assert len(q) == 100 and best.min() >= 0.93 and best.min() < 0.94 and best.max() > 0.999
    assert len(planted(v[:3], 100, 0.93)) == 3


def test_unlinked_shards_are_answered_by_beams():
    rng = np.random.default_rng(6)
    a, b = (unit(rng.normal(size=(3000, 32))) for _ in range(2))
    found, beam = audited_links(Graph.build(a, np.arange(3000)), b, 0.93, np.arange(150))
    assert beam < 3000 and not found.any()


def test_a_large_label_is_answered_by_beams(spark, monkeypatch):
    """12,000 vectors of one label in shards: beams, tiles, and a recall of 0.995 or more against brute force."""
    rng = np.random.default_rng(8)
    width, families = 24, 3600
    centers = rng.normal(size=(families, width))
    sizes = np.minimum(rng.zipf(2.2, families), 40)
    v = np.repeat(centers, sizes, axis=0)
    v = np.concatenate([v + rng.normal(scale=0.1, size=v.shape), rng.normal(size=(12_000, width))])[:12_000].astype(np.float32)
    v = v[rng.permutation(len(v))]
    ids = np.arange(len(v)) * 3 + 1
    df = spark.createDataFrame(zip(ids.tolist(), v.tolist(), [0] * len(v)), "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(hnsw, "TILE_MOST", 2)
    kept = {}
    monkeypatch.setattr(hnsw, "searched", lambda graphs, threshold, f=hnsw.searched: kept.setdefault("found", f(graphs, threshold)))
    got = {r["vec_id"]: r["n_links"] for r in embedding_components(df, shard_rows=2000).collect()}
    searches = kept["found"].where("kind = 2").collect()
    assert len(searches) == 6 * 7 // 2 and all(r["a"] < r["node"] for r in searches)
    u = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    want = np.concatenate([(u[k:k + 1000] @ u.T >= 0.93).sum(axis=1) - 1 for k in range(0, len(u), 1000)])
    found = np.array([got[i] for i in ids.tolist()])
    assert (found <= want).all() and found.sum() >= 0.995 * want.sum() > 4000


def test_no_walk_is_as_wide_as_a_group(monkeypatch):
    """Queries in a group larger than the beam are held against all nodes at once; all of the group's links are found."""
    rng = np.random.default_rng(12)
    v = unit(np.concatenate([rng.normal(size=(300, 24)), rng.normal(size=24) + rng.normal(scale=0.05, size=(900, 24))]))
    graph, beams = Graph.build(v, np.arange(len(v))), []
    search = Graph.search
    monkeypatch.setattr(Graph, "search", lambda self, queries, beam, lowest=0: beams.append(beam) or search(self, queries, beam, lowest))
    found, beam = audited_links(graph, v, 0.93, np.arange(0, len(v), 20), same=True)
    truth = v @ v.T >= 0.93
    assert max(beams) <= beam < 300 and (found & truth)[300:, 300:].sum() == truth[300:, 300:].sum()
