"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.session import keep


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))


def _checksum(edges: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes, which tells distinct edge sets apart."""
    hashes = F.xxhash64("x", "y").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashes), F.sum(F.xxhash64("y", "x").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point neighbours at the smallest of them: larger ones, or the node and its smaller ones."""
    around = _both_ways(edges)
    if not large:
        around = around.where("y < x")
    smallest = around.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
    joined = around.join(smallest, "x")
    if large:
        moved = joined.where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
    else:
        moved = joined.select(F.col("y").alias("x"), F.col("m").alias("y")).unionByName(
            smallest.select("x", F.col("m").alias("y"))
        )
    return moved.where("x != y")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``x, y`` (long): the smallest node it can reach.

    Each round's edges are written to the shared folder, and a round shrinks every path by about
    half, so rounds grow with the logarithm of the longest path. Loops and repeated edges do not
    matter; a NULL end drops its edge; no edges, no rows.
    """
    low, high = F.least("x", "y"), F.greatest("x", "y")
    proper = edges.where("x != y").select(high.alias("x"), low.alias("y"))
    table = keep(proper.distinct())
    before, now = None, _checksum(table)
    while now[0] and now != before:  # stars around the smallest node stay as they are
        table = keep(_star(_star(table, large=True), large=False).distinct())
        before, now = now, _checksum(table)
    leaves = table.select(F.col("x").alias("node"), F.col("y").alias("root"))
    return leaves.unionByName(leaves.select(F.col("root").alias("node"), "root").distinct())
