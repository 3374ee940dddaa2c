"""Connected components of an edge table, by alternating star contractions.

Each half round hangs neighbours onto the least node next to them (the first half the greater neighbours, the
second the smaller ones), until every node hangs on the least of its component. A node's neighbours are never
gathered: the least is a map-side combined aggregate, joined back, so a node with very many edges is only a
skewed join side, which Spark splits at run time. Rounds grow with the logarithm of a component's diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import Workspace


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))
    )).alias("e")).select("e.u", "e.v")


def _star(work: Workspace, neighbours: DataFrame, upward: bool, name: str) -> DataFrame:
    """Hang the greater neighbours of each node, or the node and its smaller neighbours, onto the least node.

    The least nodes are written first: a join with a table, unlike one with an aggregate, is split when skewed.
    """
    least = neighbours.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    least = work.keep(least, name)
    joined = neighbours.join(least, "u")
    if upward:
        hung = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        hung = joined.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
    return hung.where("a <> b").distinct()


def connected_components(work: Workspace, edges: DataFrame, name: str) -> DataFrame:
    """(node, label) of every node with an edge; the label is the least node of its component.

    `edges` has columns a and b of one ordered type; loops are ignored, repeated edges count once.
    """
    current, last, step = edges.select("a", "b").where("a <> b"), None, 0
    while True:
        step += 1
        large = work.keep(_star(work, _both_ways(current), True, f"{name}-least-up"), f"{name}-large")
        small = _star(work, large.select(F.col("a").alias("u"), F.col("b").alias("v")), False, f"{name}-least-down")
        current = work.keep(small, f"{name}-{step}")
        work.drop(f"{name}-least-up", f"{name}-least-down", f"{name}-large")
        state = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if step > 1:
            work.drop(f"{name}-{step - 1}")
        if state == last:
            break
        last = state
    return current.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
