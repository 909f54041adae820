"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from wardlens.sources.staging import stage


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """The smallest node reachable from every node that has an edge: columns ``node``, ``component``.

    ``edges`` holds undirected edges between longs, in any order and any number; loops and edges
    with a NULL end are ignored.  Each round links a node's larger neighbours, then all its
    neighbours, to the smallest of them (large star, small star), so trees flatten in a
    logarithmic number of rounds.  Every round is written to the shared folder, which cuts the
    lineage.  A node's neighbours are never gathered: minima are aggregated before the shuffle,
    and the join that spreads them is one that adaptive execution splits.
    """
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    state = stage(edges.filter(F.col(a) != F.col(b)).select(high, low).distinct(), "edges")
    known = None
    for _ in range(rounds):
        mark = state.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == known or not mark[0]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                state.select("v", "v").distinct()
            )
        known = mark
        both = state.union(state.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (
            both.filter("v > u")
            .join(least, F.col("u") == F.col("k"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        parents = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(parents.withColumnRenamed("u", "k"), F.col("u") == F.col("k"))
            .select(F.inline(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            )))
            .filter("u > v")
            .distinct()
        )
        state = stage(small, "edges")
    raise RuntimeError(f"components did not settle in {rounds} rounds")


class SpanningForest:
    """Trees over items 0 to n-1 that span the links added so far, for one task's links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        root = self.root
        while True:
            a, b = root[i], root[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Each item that isn't the smallest of its tree, and that smallest one."""
        child = np.flatnonzero(self.root != np.arange(len(self.root)))
        return child, self.root[child]
