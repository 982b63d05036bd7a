"""Connected components of a distributed edge list: alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond". Only DataFrame operations: a minimum for each
node, combined before its shuffle, and an equi-join, in which nodes with very many edges are broadcast. No component
meets in one task, and each round is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import HEAVY, checkpoint

MAX_ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    """(u, m, n): the least node among u and its neighbours, and the number of u's edges."""
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")


def _told(edges: DataFrame, least: DataFrame, at: str, total: int) -> DataFrame:
    """(u, v, m): each edge with the least node of its end ``at``. Fewer than HEAVY nodes have more than one in HEAVY of the
    edges; those are broadcast, so that a node's edges never have to meet in one task."""
    keyed = least.withColumnRenamed("u", at)
    heavy = F.broadcast(keyed.where(F.col("n") * HEAVY > 2 * total).drop("n"))
    light = keyed.where(F.col("n") * HEAVY <= 2 * total).drop("n")
    return edges.join(heavy, at).select("u", "v", "m").union(edges.join(heavy, at, "left_anti").join(light, at).select("u", "v", "m"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Hook the larger end of each edge onto the least node around the smaller one."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _told(edges, _least(both), "v", total).select("u", F.col("m").alias("v"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Hook every smaller neighbour of a node, and the node, onto the least of them."""
    least = _least(edges)
    return _told(edges, least, "u", total).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge; the component is its least node.

    ``edges``: two columns of one type that can be ordered; direction, repeats and loops don't matter, rows with
    a null are ignored. Nodes without an edge to another node don't come back.
    """
    a, b = edges.columns[:2]
    now = checkpoint(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    # Stars don't change any more: equal row counts and equal order-free sums of the rows' hashes.
    told = lambda: tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    mark = told()
    total = mark[0]
    for _ in range(MAX_ROUNDS if total else 0):
        parts = now.rdd.getNumPartitions()
        hooked = checkpoint(_large_star(now, total).coalesce(2 * parts))
        now = checkpoint(_small_star(hooked, total).coalesce(2 * parts).distinct())
        new = told()
        if new == mark:
            break
        mark, total = new, new[0]
    else:
        if total:
            raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
