"""Connected components by alternating large-star and small-star steps.

Each step is an aggregation and a join on one end of the edges, so no component and no
neighbourhood is ever gathered in one task. Between steps the edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitcast.llm.scratch import materialise


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b) that is not its component's smallest.

    component is the smallest node that edges reach. Nodes without edges are not in the result. Edges
    may be repeated, stand in either direction, or join a node with itself.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = materialise(e, "components"), None
    while True:
        mark = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if mark == before or not mark[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = mark
        e = materialise(_small_star(_large_star(e)), "components")
