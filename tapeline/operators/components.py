"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node hands its neighbours (large: the larger ones; small: the smaller ones and itself) to its least neighbour."""
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = near.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def contracted(edges: DataFrame) -> tuple[DataFrame, int]:
    """(edges (a, b) from every node to the least one it reaches, rounds). edges: a and b of one type that has an order.

    The edge set never grows and shrinks towards one edge per node; rounds go on until it no longer changes, about as many as
    the logarithm of the longest path. Each round's edges are written to the shared folder. Null ends and loops are ignored.
    """
    edges = materialise(edges.select("a", "b").filter("a <> b").distinct())
    mark, rounds = None, 0
    while True:
        edges = materialise(_star(_star(edges, True), False))
        rounds += 1
        seen = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == mark:
            return edges, rounds
        mark = seen


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable, for each node of an edge between two different nodes. No edges give an empty table."""
    found, _ = contracted(edges.select(F.col(a).alias("a"), F.col(b).alias("b")))
    nodes = found.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(found.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
