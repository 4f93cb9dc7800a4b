"""Connected components by alternating large-star and small-star steps.

Each step is one grouped minimum and one join back, both of which Spark can
spread even where a node has very many edges; every round is written to the
shared scratch folder, so a lost executor costs one round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import staged


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """For each node ``u`` the least of its neighbours ``v`` and itself."""
    return edges.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")).select(
        "n", F.least("n", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (u, v): the least node reachable.

    Loops and repeated edges do no harm; no edges give no rows.
    """
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_least_neighbour(both), F.col("u") == F.col("n"))
                 .where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Now u > v holds in every row: each node points to smaller ones.
        least = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        small = (large.join(least, F.col("u") == F.col("n")).where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct())
        now = staged(small, "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000000007),
                       F.sum(F.xxhash64("v", "u") % 998244353)).first()
        if mark == before:
            break
        before = mark
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def forest(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges among the given ones that connect as much, fewer than n."""
    parent, out = list(range(n)), []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        x, y = a, b
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out
