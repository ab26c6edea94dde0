"""Connected components by alternating large and small stars over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfscore.llm.common import materialize


def _star(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour or itself: node, least."""
    return edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node of the edges (a, b), both long.

    Nodes are joined to their smallest neighbours until nothing changes: a number of
    rounds that grows with the logarithm of the longest path.  Each round's edges are
    a written table, so the lineage stays short; no node's neighbours are ever
    gathered, only their minimum (a partial aggregate).
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("node"),
                                                   F.least("a", "b").alias("other")).distinct(), "edges")
    last = None
    while True:
        # large star: larger neighbours move to the smallest of the neighbourhood
        both = now.union(now.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = (both.join(_star(both), "node").where("other > node and other <> least")
                 .select(F.col("other").alias("node"), F.col("least").alias("other")).distinct())
        large = materialize(large, "large-star")
        # small star: a node and its smaller neighbours move to the smallest of them
        least = _star(large)
        small = (large.join(least, "node").where("other <> least").select(F.col("other").alias("node"), "least")
                 .union(least).select("node", F.col("least").alias("other")).where("node <> other").distinct())
        now = materialize(small, "small-star")
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "other"))).first()
        if mark == last:
            break
        last = mark
    return now.select("node", F.col("other").alias("component")).union(
        now.select(F.col("other").alias("node"), F.col("other").alias("component")).distinct())
