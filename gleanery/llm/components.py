"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours of each node (the larger ones, or itself and the smaller ones) are linked to its least neighbour."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # written first, so that the join below has a shuffle of its own on both sides, which Spark can split at a hub
    least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    linked = both.join(least, "a")
    out = linked.where("b > a") if large else linked.unionByName(least.select("a", F.col("a").alias("b"), "m"))
    return out.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the least node that it is connected to.

    Each round is written to the shared folder; rounds grow with the logarithm of the longest path. Nodes are keyed rows, never
    gathered: a hub's neighbours are joined, and skewed joins split.
    """
    now = materialize(edges.where("a <> b").select("a", "b").distinct())
    mark = None
    while True:
        nxt = materialize(_star(_star(now, large=True), large=False))
        seen = nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark, now = tuple(seen), nxt
    nodes = nxt.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
