"""Near-duplicate embeddings by navigable small-world graphs, one per shard."""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import staged
from postlens.llm.components import components, forest
from postlens.llm.wordhash import mix

_log = logging.getLogger(__name__)

THRESHOLD = 0.93
#: Vectors in a shard, about.
SHARD = 8000
#: Links of a node on the upper levels; twice as many on the lowest.
LINKS = 16
BUILD_BEAM = 64
BEAM = 64
#: Nodes that a beam expands at a time, and queries that walk together.
EXPAND = 4
TOGETHER = 256
#: At least so many queries of a search, or this share, are checked against all of the shard.
AUDIT, AUDIT_SHARE = 64, 0.05
RECALL = 0.995
#: Shards that a task searches with each other are as many as fit in so many bytes, a few.
TILE_BYTES, TILE_MOST = 64 * 2**20, 4
#: Single precision finds candidates this much below the threshold; double precision decides.
SLACK = 1e-4


class Graph:
    """A hierarchical navigable small-world graph over unit vectors."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], nodes: list[np.ndarray]) -> None:
        self.vectors, self.links, self.nodes = vectors, links, nodes

    @staticmethod
    def build(vectors: np.ndarray, seeds: np.ndarray) -> Graph:
        """Insert in waves: those of a wave look for neighbours in the graph so far and among themselves."""
        n = len(vectors)
        draw = (mix(seeds.astype(np.uint64)) >> np.uint64(11)).astype(np.float64) / 2.0**53
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(LINKS)).astype(int), 8)
        order = np.lexsort((mix(seeds.astype(np.uint64) + np.uint64(1)), -level))  # the upper levels first
        graph = Graph(vectors, [np.full((n, LINKS * (1 + (k == 0))), -1, dtype=np.int32) for k in range(int(level.max()) + 1)], [])
        graph.nodes = [np.zeros(0, dtype=np.int64) for _ in graph.links]
        done = 0
        while done < n:
            wave = order[done:done + max(1, min(TOGETHER, done))]
            for k in range(int(level[wave].max()), -1, -1):
                graph._insert(wave[level[wave] >= k], k)
            for k in range(len(graph.links)):
                graph.nodes[k] = order[:done + len(wave)][level[order[:done + len(wave)]] >= k]
            done += len(wave)
        return graph

    def _insert(self, wave: np.ndarray, k: int) -> None:
        known = self.nodes[k]
        among = self.vectors[wave] @ self.vectors[wave].T
        np.fill_diagonal(among, -2)
        near = np.argsort(-among, axis=1, kind="stable")[:, :BUILD_BEAM]
        found, worth = [wave[near]], [np.take_along_axis(among, near, axis=1)]
        if len(known):
            ids, sims = self.search(self.vectors[wave], BUILD_BEAM, k)
            found.append(ids)
            worth.append(sims)
        ids, sims = np.concatenate(found, axis=1), np.concatenate(worth, axis=1)
        best = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_BEAM]
        ids, sims = np.take_along_axis(ids, best, axis=1), np.take_along_axis(sims, best, axis=1)
        chosen = self._apart(ids, sims, LINKS)
        links = self.links[k]
        back: dict[int, list[int]] = {}
        for node, row, keep in zip(wave, ids, chosen):
            mine = row[keep]
            links[node, :len(mine)] = mine
            for other in mine:
                back.setdefault(int(other), []).append(int(node))
        for node, new in back.items():
            old = links[node][links[node] >= 0]
            all_ = np.unique(np.concatenate([old, np.array(new, dtype=np.int32)]))
            if len(all_) > links.shape[1]:
                sims = self.vectors[all_] @ self.vectors[node]
                rank = np.argsort(-sims, kind="stable")
                all_ = all_[rank]
                keep = self._apart(all_[None], sims[rank][None], links.shape[1])[0]
                all_ = all_[keep]
            links[node] = -1
            links[node, :len(all_)] = all_

    def _apart(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Candidates (nearest first) that are nearer to the node than to any chosen before; the rest fill what is left."""
        there = sims > -1.5
        mutual = np.einsum("bid,bjd->bij", self.vectors[ids], self.vectors[ids])
        chosen = np.zeros(ids.shape, dtype=bool)
        for c in range(ids.shape[1]):
            closer = np.where(chosen[:, :c], mutual[:, c, :c], -2).max(axis=1, initial=-2) if c else np.full(len(ids), -2.0)
            chosen[:, c] = there[:, c] & (sims[:, c] > closer) & (chosen.sum(axis=1) < most)
        left = most - chosen.sum(axis=1)
        fill = there & ~chosen
        return chosen | (fill & (np.cumsum(fill, axis=1) <= left[:, None] // 2))

    def search(self, queries: np.ndarray, beam: int, lowest: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of the best ``beam`` nodes met on a level, coming down from the top; -1 and -2 pad."""
        entry = None
        for k in range(len(self.links) - 1, lowest - 1, -1):
            if not len(self.nodes[k]):
                continue
            entry = self._walk(queries, entry, beam if k == lowest else 1, k)
            if k > lowest:
                entry = entry[0]
        return entry

    def _walk(self, queries: np.ndarray, entry: np.ndarray | None, beam: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        n, rows = len(queries), np.arange(len(queries))[:, None]
        if entry is None:
            entry = np.full((n, 1), self.nodes[k][0])
        ids = np.full((n, beam), -1, dtype=np.int64)
        sims = np.full((n, beam), -2.0, dtype=np.float32)
        ids[:, :entry.shape[1]] = entry
        sims[:, :entry.shape[1]] = np.einsum("bd,bed->be", queries, self.vectors[entry])
        seen = np.zeros((n, len(self.vectors) + 1), dtype=bool)  # the last column takes what isn't there
        seen[rows, entry] = True
        expanded = ids < 0
        live = np.arange(n)
        while len(live):
            # the best nodes of each beam that weren't expanded
            open_sims = np.where(expanded[live], -3, sims[live])
            pick = np.argsort(-open_sims, axis=1, kind="stable")[:, :min(EXPAND, beam)]
            usable = np.take_along_axis(open_sims, pick, axis=1) > -2.5
            expanded[live[:, None], pick] = True
            from_ = np.where(usable, np.take_along_axis(ids[live], pick, axis=1), -1)
            next_ = np.where(from_[:, :, None] >= 0, self.links[k][from_], -1).reshape(len(live), -1)
            next_ = np.sort(next_, axis=1)
            next_[:, 1:][next_[:, 1:] == next_[:, :-1]] = -1
            next_ = np.where(seen[live[:, None], next_], -1, next_)
            seen[live[:, None], next_] = True
            worth = np.where(next_ >= 0, np.einsum("bd,bmd->bm", queries[live], self.vectors[next_]), -2)
            all_ids, all_sims = np.concatenate([ids[live], next_], axis=1), np.concatenate([sims[live], worth], axis=1)
            all_expanded = np.concatenate([expanded[live], next_ < 0], axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[live], sims[live] = np.take_along_axis(all_ids, best, axis=1), np.take_along_axis(all_sims, best, axis=1)
            expanded[live] = np.take_along_axis(all_expanded, best, axis=1)
            live = live[~expanded[live].all(axis=1)]
        return ids, sims

    def unreached(self) -> np.ndarray:
        """Nodes that no walk comes to, since no link leads there from where walks begin."""
        seen = np.zeros(len(self.vectors), dtype=bool)
        seen[self.nodes[-1][:1]] = True
        for table in self.links[::-1]:
            front = np.flatnonzero(seen)
            while len(front):
                next_ = np.unique(table[front])
                front = next_[(next_ >= 0) & ~seen[next_]]
                seen[front] = True
        return np.flatnonzero(~seen)

    # ---- as bytes, to travel between tasks

    def dump(self) -> dict[str, bytes]:
        levels = np.zeros(len(self.vectors), dtype=np.int8)
        for k, nodes in enumerate(self.nodes):
            levels[nodes] = k
        entry = self.nodes[-1][:1]
        return {"levels": levels.tobytes(), "links": b"".join(x.tobytes() for x in self.links), "entry": entry.astype(np.int64).tobytes()}

    @staticmethod
    def load(vectors: np.ndarray, levels: bytes, links: bytes, entry: bytes) -> Graph:
        level = np.frombuffer(levels, dtype=np.int8)
        flat, at, tables = np.frombuffer(links, dtype=np.int32), 0, []
        for k in range(int(level.max()) + 1):
            width = LINKS * (1 + (k == 0))
            tables.append(flat[at:at + len(level) * width].reshape(len(level), width))
            at += len(level) * width
        first = np.frombuffer(entry, dtype=np.int64)
        nodes = [np.concatenate([first, np.flatnonzero(level >= k)]) for k in range(len(tables))]
        return Graph(vectors, tables, nodes)


def unit(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)).astype(np.float32)


def _reached(graph: Graph, queries: np.ndarray, threshold: float, beam: int) -> np.ndarray:
    """Which nodes (columns) each query's beam finds above the threshold; where a beam is full of them, all products of the query tell."""
    n = len(graph.vectors)
    out = np.zeros((len(queries), n), dtype=bool)
    for at in range(0, len(queries), TOGETHER):
        todo = np.arange(at, min(at + TOGETHER, len(queries)))
        ids, sims = graph.search(queries[todo], min(beam, n))
        hit = (ids >= 0) & (sims >= threshold - SLACK)
        row, column = np.nonzero(hit)
        out[todo[row], ids[row, column]] = True
        full = todo[hit.all(axis=1)]
        if len(full):  # in a group larger than the beam a walk as wide as the group costs more than the products
            out[full] = queries[full] @ graph.vectors.T >= threshold - SLACK
    return out


def _exact(graph: Graph, queries: np.ndarray, threshold: float) -> np.ndarray:
    """The same from all products, a block of queries at a time."""
    return np.concatenate([queries[at:at + TOGETHER] @ graph.vectors.T >= threshold - SLACK for at in range(0, len(queries), TOGETHER)])


def _passes(found: np.ndarray, truth: np.ndarray) -> bool:
    """Whether the mean recall over the queries that have links is enough, and in every class of queries with about as many."""
    links = truth.sum(axis=1)
    linked = links > 0
    recall = (found & truth).sum(axis=1)[linked] / links[linked]
    size = np.frexp(links[linked])[1]
    return recall.mean() >= RECALL and all(recall[size == k].mean() >= RECALL for k in np.unique(size))


def planted(vectors: np.ndarray, most: int, threshold: float) -> np.ndarray:
    """Queries that link: some of the vectors, each turned in a random direction to a cosine between the threshold and 1."""
    rng = np.random.default_rng(len(vectors))
    own = vectors[rng.permutation(len(vectors))[:most]]
    aside = rng.normal(size=own.shape)
    aside -= (aside * own).sum(axis=1, keepdims=True) * own
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    aside /= np.where(length > 1e-9, length, 1)
    cosine = np.linspace(threshold + 0.02 * (1 - threshold), 1, len(own))[:, None]
    return unit(cosine * own + np.sqrt(1 - cosine * cosine) * aside)


def audited_links(graph: Graph, queries: np.ndarray, threshold: float, audit: np.ndarray, same: bool = False) -> tuple[np.ndarray, int]:
    """Candidate links of all queries, from beams as wide as it takes for the audited ones to find what brute force finds.

    same: the queries are the graph's own vectors, in order; that each finds itself doesn't count.
    Beside the audited queries as many planted ones are held against brute force, which
    all have links, so there is always something to judge a beam by. Nodes that no walk can reach are held against
    all queries. Where the widest beam fails, all products are formed; the beam is then the size of the graph.
    """
    n = len(graph.vectors)
    truth = _exact(graph, queries[audit], threshold)
    if same:
        truth[np.arange(len(audit)), audit] = False
    probes = planted(graph.vectors, len(audit), threshold)
    there = _exact(graph, probes, threshold)
    beam = min(BEAM, max(LINKS, n // 4))
    while beam < n:
        if _passes(_reached(graph, probes, threshold, beam), there) and (
                not truth.any() or _passes(_reached(graph, queries[audit], threshold, beam), truth)):
            found, lost = _reached(graph, queries, threshold, beam), graph.unreached()
            found[:, lost] = queries @ graph.vectors[lost].T >= threshold - SLACK
            return found, beam
        beam *= 2
    return _exact(graph, queries, threshold), n


def _verify(candidates: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """The candidate links whose cosine in double precision reaches the threshold."""
    left, right = left.astype(np.float64), right.astype(np.float64)
    left_norm, right_norm = np.sqrt((left * left).sum(axis=1)), np.sqrt((right * right).sum(axis=1))
    for at in range(0, len(left), TOGETHER):
        row, column = np.nonzero(candidates[at:at + TOGETHER])
        row += at
        for k in range(0, len(row), 200_000):
            i, j = row[k:k + 200_000], column[k:k + 200_000]
            cosine = (left[i] * right[j]).sum(axis=1) / (left_norm[i] * right_norm[j])
            candidates[i, j] = cosine >= threshold
    return candidates


def searched(graphs: DataFrame, threshold: float) -> DataFrame:
    """What each pair of a label's shards finds: kind 0, links n of a node; 1, a forest of links a to b; 2, the search itself: nodes, queries n, beam a.

    A beam as wide as the nodes are many stands for all products.
    """
    # shards of a label differ a little in size; the tiles are made for the largest
    width = graphs.groupBy("label", "length").agg(F.max(F.octet_length("vectors") + F.octet_length("links")).alias("bytes")).select(
        "label", "length", F.least(F.lit(TILE_MOST), F.greatest(F.lit(1), F.floor(TILE_BYTES / F.col("bytes")))).cast("int").alias("width"))
    names = staged(graphs.select("label", "length", "shard").join(width, ["label", "length"]).select(
        "label", "length", "shard", F.floor(F.col("shard") / F.col("width")).cast("int").alias("tile")), "tiles")
    tiles = names.select("label", "length", "tile").distinct()
    meet = tiles.withColumnRenamed("tile", "left_tile").join(tiles, ["label", "length"]).where("left_tile <= tile")
    sides = meet.select("label", "length", "left_tile", "tile", F.explode(F.array_distinct(F.array("left_tile", "tile"))).alias("own"))
    placed = names.withColumnRenamed("tile", "own").join(sides, ["label", "length", "own"]).select("label", "length", "shard", "own", "left_tile", "tile")
    searches = placed.join(graphs, ["label", "length", "shard"])

    def search(part: pd.DataFrame) -> pd.DataFrame:
        shards = {int(r["shard"]): r for _, r in part.iterrows()}
        left = [k for k, r in shards.items() if r["own"] == r["left_tile"]]
        right = [k for k, r in shards.items() if r["own"] == r["tile"]]
        return pd.concat([pair(shards[i], shards[k]) for i in sorted(left) for k in sorted(right) if i <= k])

    def pair(one: pd.Series, r: pd.Series) -> pd.DataFrame:
        ids, left_ids = (np.frombuffer(x["nodes"], dtype=np.int64) for x in (r, one))
        copies, left_copies = (np.frombuffer(x["copies"], dtype=np.int64) for x in (r, one))
        exact, left_exact = (np.frombuffer(x["vectors"], dtype=np.float64).reshape(-1, int(r["length"])) for x in (r, one))
        graph, queries = Graph.load(unit(exact), r["levels"], r["links"], r["entry"]), unit(left_exact)
        audit = np.argsort(mix(left_ids.astype(np.uint64) + np.uint64(7)), kind="stable")[:max(AUDIT, int(AUDIT_SHARE * len(left_ids)))]
        same = one["shard"] == r["shard"]
        found, beam = audited_links(graph, queries, threshold, audit, same)
        if same:
            found |= found.T
            np.fill_diagonal(found, False)
        found = _verify(found, left_exact, exact, threshold)
        a, b = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for at in range(0, len(left_ids), TOGETHER):
            row, column = np.nonzero(found[at:at + TOGETHER])
            a, b = forest(np.concatenate([a, left_ids[row + at]]), np.concatenate([b, ids[column]]))
        count = [pd.DataFrame({"node": left_ids, "n": (found * copies).sum(axis=1)})]
        if not same:
            count.append(pd.DataFrame({"node": ids, "n": (found * left_copies[:, None]).sum(axis=0)}))
        counts = pd.concat(count)
        counts = counts[counts["n"] > 0]
        searched = pd.DataFrame({"kind": [2], "node": [len(ids)], "n": [len(left_ids)], "a": [beam], "b": [0]})
        return pd.concat([counts.assign(a=0, b=0, kind=0), pd.DataFrame({"node": 0, "n": 0, "a": a, "b": b, "kind": 1}), searched])[["kind", "node", "n", "a", "b"]]

    return staged(searches.groupBy("label", "length", "left_tile", "tile").applyInPandas(search, "kind int, node long, n long, a long, b long"), "found")


def embedding_components(vectors: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD) -> DataFrame:
    """Link vectors of the same label with a cosine of ``threshold`` or more.

    vectors: vec_id, embedding, label. One row per row of it: vec_id, n_links (other rows
    linked directly), component_id (smallest vec_id that links reach), kept (vec_id is the component's).
    A null label, a null embedding, one that is empty, zero or holds null or non-finite
    values, and a null vec_id link with nothing; vectors of different length neither.
    Rows that repeat an id are vectors of their own. No rows give no rows; other columns are not read.

    Equal vectors of a label are one node with a count. The nodes of a label are dealt
    to shards; each shard gets a graph, and every vector of the label queries every
    shard (a pair of shards once). A sample of each search is audited against brute force, by
    query and by size of group, together with planted queries that have links, and beams are widened until it passes; else
    all pairs of the two shards are formed. Double precision decides. A search sends on
    how many links each node has and a forest of them, not the links. Shards meet in tiles
    of a few by a few, dealt by tile, so a label of many shards is spread and a shard travels once for each tile.
    """
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    values = F.col("embedding")
    usable = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size(values) > 0)
              & ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(values, lambda x: x != 0))
    rows = vectors.select("vec_id", "embedding", "label").withColumn("usable", F.coalesce(usable, F.lit(False)))
    rows = rows.withColumn("vector", F.when(F.col("usable"), F.struct("label", "embedding")))
    nodes = rows.where("usable").groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    nodes = staged(nodes.select("vector", "node", "copies", F.col("vector.label").alias("label"), F.size("vector.embedding").alias("length")), "vectors")
    shards = nodes.groupBy("label", "length").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / shard_rows)).alias("shards"))
    dealt = nodes.join(shards, ["label", "length"]).select(
        "label", "length", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int").alias("shard"), "node", "copies",
        F.col("vector.embedding").cast("array<double>").alias("exact"))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node")
        exact, ids = np.stack(part["exact"].to_numpy()).astype(np.float64), part["node"].to_numpy(dtype=np.int64)
        graph = Graph.build(unit(exact), ids)
        return pd.DataFrame([{"label": part["label"].iloc[0], "length": part["length"].iloc[0], "shard": part["shard"].iloc[0],
                              "nodes": ids.tobytes(), "copies": part["copies"].to_numpy(dtype=np.int64).tobytes(), "vectors": exact.tobytes(),
                              **graph.dump()}])

    label_type = vectors.schema["label"].dataType.simpleString()
    graphs = staged(dealt.groupBy("label", "length", "shard").applyInPandas(
        build, f"label {label_type}, length int, shard int, nodes binary, copies binary, vectors binary, levels binary, links binary, entry binary"), "graphs")
    out = searched(graphs, threshold)
    searches = [tuple(r) for r in out.where("kind = 2").groupBy(F.col("a") < F.col("node")).count().collect()]
    _log.info("searches answered by a beam: %s, by all products: %s", dict(searches).get(True, 0), dict(searches).get(False, 0))
    counts = out.where("kind = 0").groupBy("node").agg(F.sum("n").alias("n"))
    reach = components(out.where("kind = 1").select("a", "b")).withColumnRenamed("node", "__node")
    named = (nodes.join(counts, "node", "left").join(reach, F.col("node") == F.col("__node"), "left")
             .select("vector", F.coalesce("component", "node").alias("component"),
                     (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links")))
    linked = rows.where("usable").select("vec_id", "vector").join(named, "vector").select(
        "vec_id", "n_links", F.col("component").cast(id_type).alias("component_id"))
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
