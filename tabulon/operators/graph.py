"""Connected components of an undirected edge list."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabulon.session import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest id reachable from each node of the (u, v) edges.

    Alternating large-star and small-star rounds contract the graph on the executors; ids of any orderable type.
    """
    both = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u < v").distinct()
    both = cut(both)
    state, seen = both, None
    while True:
        state = cut(_star(_star(state, large=True), large=False))
        mark = state.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
        if mark == seen:
            break
        seen = mark
    # Converged edges are (root, node).
    leaf = state.select(F.col("v").alias("node"), F.col("u").alias("root"))
    roots = state.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return leaf.unionByName(roots)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: link every larger (or every smaller) neighbour to the smallest one."""
    there = edges.select("u", "v")
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    pairs = there.unionByName(back) if large else back
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = pairs.join(low, "u")
    if large:
        out = linked.where("v > u").select(F.col("m").alias("u"), "v")
    else:
        out = linked.select(F.col("m").alias("u"), "v").unionByName(low.select(F.col("m").alias("u"), F.col("u").alias("v")))
    return out.where("u < v").distinct()
