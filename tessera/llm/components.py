"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``edges`` (u long, v long) to (node, component), the smallest node each
    node reaches; nodes without an edge to another node are not returned.

    Alternating large and small stars: every round moves the larger neighbours
    of a node, then its smaller ones, to its least neighbour, and the result is
    the fixed point, one star per component. A node with very many neighbours is
    pre-aggregated before its shuffle, but not split in the join beside that
    aggregate.
    Each round is a table in the shared folder; only two numbers (edge count and
    hash sum) come back to the driver. Null ends and loops are dropped.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = scratch.table(edges, "edges")
    previous, path = None, scratch.last
    while True:
        edges = scratch.table(_small_star(_large_star(edges)), "stars")
        scratch.drop(path)
        path = scratch.last
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if state == previous or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        previous = state
