"""Connected components of an undirected graph by alternating star contractions.

Every round is two grouped minima (pre-aggregated map-side) and two joins against them,
written to the shared folder: no adjacency list is ever collected, a hub that holds a
third of all edges is one row of the minima table, and its edges are split by AQE's
skew join. The number of rounds grows with the logarithm of the longest path.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroscope.llm.common import drop_written, written


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (first two columns, same orderable type, any direction, repeats and loops
    allowed) -> ``node``, ``root`` (the smallest node of its component, itself included)
    for every node that has an edge to another node. Edges with a null end are ignored.

    Raises if the contraction has not settled after ``max_rounds`` rounds."""
    a, b = (F.col(f"`{c}`") for c in edges.columns[:2])
    current = written(
        edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc")
    mark = _mark(current)
    for _ in range(max_rounds):
        step = written(_small_star(_large_star(current)), "cc")
        new_mark = _mark(step)
        drop_written(current)
        current = step
        if new_mark == mark:
            ends = current.select("v").distinct()
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                ends.select(F.col("v").alias("node"), F.col("v").alias("root")))
        mark = new_mark
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node around it."""
    both = e.union(e.select("v", "u"))
    around = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = both.filter("v > u")
    return larger.join(around, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    lowest = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lowest.select("u", F.col("m").alias("v"))).distinct()
