"""Connected components of a link table that no machine holds whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import staged


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node it reaches) that join what these links join."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while True:
            shorter = new[new]
            if (shorter == new).all():
                break
            new = shorter
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _contract(links: DataFrame) -> DataFrame:
    """Replace the links of each batch by a forest; what they join stays joined."""
    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            node, root = forest(batch["a"].to_numpy(), batch["b"].to_numpy())
            yield pd.DataFrame({"a": node, "b": root})

    return links.mapInPandas(shrink, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(a, b) to (node, component): the smallest node reachable, for every node that has a link.

    Links in either direction, repeated or from a node to itself count alike; nulls link
    nothing; no links give no rows. Batches are first contracted to forests where
    they lie. Then large-star and small-star steps alternate, each a minimum per node and a join,
    until nothing moves; every step is written to the shared folder. Neither a node's
    neighbours nor a component are ever gathered.
    """
    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = staged(_contract(links.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))).distinct(), "links")
    before = None
    while (now := state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        edges = staged(small.select("e.a", "e.b").where("a <> b").distinct(), "links")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
