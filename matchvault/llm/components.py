"""Connected components by alternating large-star and small-star steps, all as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchvault.llm.store import written


BROADCAST = 500_000  # up to so many edges the minima of a step (two longs each) go to every task


def _step(edges: DataFrame, large: bool, small: bool) -> DataFrame:
    """Hang every neighbour of a node on the smallest of node and neighbours: larger ones, or the smaller."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select("u", F.least("u", "m").alias("m"))
    near = both.where("v > u") if large else both
    hung = near.join(F.broadcast(low) if small else low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        hung = hung.unionByName(low.select("u", F.col("m").alias("v")))
    return hung.where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges(u, v)``; root is the smallest node reached.

    Nodes without an edge are not returned. Every round is a written table, so no lineage grows; the number
    of rounds grows with the logarithm of the longest chain. An edge always has its larger node first.
    """
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before, n = None, edges.count()
    while True:
        edges = written(_step(_step(edges, True, n <= BROADCAST), False, n <= BROADCAST).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before, n = now, now[0]
