"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.session import cut


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a", "b").agg(F.lit(1).alias("_")).select("a", "b")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    linked = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _distinct(linked)


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them. Edges run from large to small."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
    linked = edges.join(least, F.col("a") == F.col("n"))
    moved = linked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _distinct(moved.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; a component is named by its smallest node.

    ``edges`` has columns ``a`` and ``b`` of one ordered type. Self-loops, nulls and repeats are ignored. Each round writes
    its edges to the shared folder, so a lost executor costs one round at most; a hub is never gathered into one task, only
    its smallest neighbour is (by partial minima), and the join that spreads it can be split where it is skewed.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = cut(_distinct(pairs))
    before = _state(now)
    while before[0]:
        now = cut(_small_star(_large_star(now)))
        after = _state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
