"""Connected components of a graph given as a table of edges, by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import Staged


class UnionFind:
    """Over the whole numbers below n; each set is named by its smallest member."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _thin(batches):
    """A partition's edges as a forest of stars: what they connect, with fewer edges than nodes. Works in blocks of
    rows, so memory is bounded."""
    held: list[pd.DataFrame] = []

    def stars(parts):
        edges = pd.concat(parts)
        nodes, at = np.unique(np.concatenate([edges["u"].to_numpy(), edges["v"].to_numpy()]), return_inverse=True)
        sets = UnionFind(len(nodes))
        for a, b in zip(at[: len(edges)].tolist(), at[len(edges) :].tolist()):
            sets.union(a, b)
        root = np.array([sets.find(i) for i in range(len(nodes))], dtype=np.int64)
        far = root != np.arange(len(nodes))
        return pd.DataFrame({"u": nodes[far], "v": nodes[root[far]]})

    rows = 0
    for pdf in batches:
        held.append(pdf)
        rows += len(pdf)
        if rows >= 500_000:
            yield stars(held)
            held, rows = [], 0
    if rows:
        yield stars(held)


#: Neighbours from which on a node's edges are split for a join.
HUB = 10_000


def _summary(stars: DataFrame) -> tuple[tuple, DataFrame]:
    """What tells whether the edges changed, and the hubs among the smaller ends with the number of their splits. There
    are at most edges / HUB of them, of 12 bytes."""
    own = stars.groupBy("v").agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
    hub = F.when(F.col("n") >= HUB, F.struct("v", F.ceil(F.col("n") / HUB).cast("int")))
    n, h, hubs = own.agg(F.sum("n"), F.sum("h"), F.collect_list(hub)).first()
    return (n, h), stars.sparkSession.createDataFrame([tuple(x) for x in hubs], "hub long, splits int")


def components(edges: DataFrame, staged: Staged, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for each node that has an edge (u, v: long), but for the roots themselves; a root is the smallest
    node of its component. Minima are aggregated before they are shuffled, and joined back with the edges of a hub split
    by the other end. ``max_rounds`` is far more than the logarithm of any number of nodes that the rounds grow with."""
    stars = staged.keep(edges.where("u <> v").mapInPandas(_thin, "u long, v long"))
    mark, hubs = _summary(stars)
    for _ in range(max_rounds):
        both = stars.select("u", "v").union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        few = F.broadcast(hubs)
        ends = both.where("v > u").join(few, F.col("u") == F.col("hub"), "left").select("u", "v", F.coalesce(F.pmod(F.xxhash64("v"), "splits"), F.lit(0)).alias("split"))
        minima = least.join(few, F.col("u") == F.col("hub"), "left").select("u", "m", F.explode(F.sequence(F.lit(0), F.coalesce("splits", F.lit(1)) - 1)).alias("split"))
        large = ends.join(minima, (ends["u"] == minima["u"]) & (ends["split"] == minima["split"])).select(ends["v"].alias("u"), minima["m"].alias("v")).where("u <> v").distinct()
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v")))
        stars = staged.keep(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now, hubs = _summary(stars)
        if now == mark:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
