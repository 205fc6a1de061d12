"""Connected components: of a link table by alternating large-star and small-star steps, of arrays inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import cut, discard


class Sets:
    """Disjoint sets over 0..n-1, joined by arrays of pairs."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def find(self, i: np.ndarray) -> np.ndarray:
        at = self.root[i]
        while not np.array_equal(up := self.root[at], at):
            at = up
        return at

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.find(i), self.find(j)
            self.root[i], self.root[j] = a, b
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has a link to another; root is the smallest node of the component.

    Each round links the larger neighbours of a node to the smallest one, then the same for the smaller neighbours,
    until the table stays as it is: a number of rounds that grows with the logarithm of the nodes. Minima are taken by
    partial aggregation, and no neighbour list is ever gathered. They are written before they are joined, so that both sides of
    a join are exchanged and Spark can split the links of one node over tasks: a node may have any number of links.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = cut(links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = cut(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        done, before = edges, state
        edges = cut(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        for table in (done, least, large, low):
            discard(table)
        if (state := _state(edges)) == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
