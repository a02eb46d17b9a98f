"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from cardmill.session import drop_copies, materialize

MOST_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every neighbour above a node is tied to the smallest id around the node; and the copy that this reads."""
    around = _both_ways(edges)
    least = materialize(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    above = around.where(F.col("b") > F.col("a"))
    return above.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")), least


def _small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every neighbour below a node, and the node, are tied to the smallest of them; and the copy that this reads."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = materialize(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    ties = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return ties.union(least.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")), least


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest id it can reach) for every node of edges ``a``, ``b`` that is no root itself.

    Each round writes its edges, one row a node at the end; nothing is collected but a count and a checksum. Node
    ids are compared as they are. Loops and repeated edges do no harm. Neighbourhoods are reduced by partial
    minima, which are written before they are joined back: so AQE can split a node with very many edges like any
    skewed join key. Copies of a round are dropped behind it.
    """
    edges = materialize(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "graph")
    before = None
    for _ in range(MOST_ROUNDS):
        large, read = _large_star(edges)
        wide = materialize(large.distinct(), "stars")
        drop_copies(edges, read)
        small, read = _small_star(wide)
        edges = materialize(small.distinct(), "stars")
        drop_copies(wide, read)
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = seen
    raise RuntimeError(f"no fixed point after {MOST_ROUNDS} rounds")


def local_roots(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix the smallest index that each index can reach."""
    n = len(linked)
    root = np.full(n, -1)
    for start in range(n):
        if root[start] >= 0:
            continue
        root[start] = start
        edge = np.array([start])
        while len(edge):
            reached = linked[edge].any(axis=0)
            edge = np.flatnonzero(reached & (root < 0))
            root[edge] = start
    return root
