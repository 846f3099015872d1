"""Connected components of an edge table by alternating large and small stars.

Each round is two grouped minima with partial aggregation and joins on the node, cut by a
checkpoint; the loop ends when a round changes nothing (no cap on rounds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepframe._session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v) with v < u: neighbours are tied to the smallest one."""
    sides = edges.select(F.col("u").alias("x"), F.col("v").alias("y"))
    if large:
        sides = sides.union(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    low = sides.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    tied = sides.join(low, "x")
    if large:
        out = tied.where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.select(F.col("y").alias("u"), F.col("m").alias("v")).union(low.select(F.col("x").alias("u"), F.col("m").alias("v")))
    return out.where("u != v").distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, comp) for every node of an edge; ``comp`` is the smallest node reachable."""
    cur = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct())

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0])  # one row

    seen = mark(cur)
    while seen[0]:
        cur = cut_lineage(_star(_star(cur, True), False))
        now = mark(cur)
        if now == seen:
            break
        seen = now
    leaves = cur.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return leaves.union(cur.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
