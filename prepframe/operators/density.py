"""Exact density clustering (DBSCAN, M5).

Three distance passes in bounded blocks (see `blocks`) over the Voronoi cells of a few pivots,
in any number of dimensions: a point meets the references of its own cell and those that the
triangle inequality lets within ``eps`` of it.

1. neighbours within ``eps`` (self included) are counted per point and block, until there are
   enough for a core point;
2. every block of core points reports its own connected pieces as stars (each point and
   the smallest id of its piece), and the pieces are joined by connected components; a tile
   whose points are of one piece already is left out;
3. border points take the smallest cluster among their core neighbours; the rest is noise.

No pair of points leaves a block.  Cluster ids are the smallest core point id of each
cluster.  Points with a missing feature are kept: cluster null, not core.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepframe._session import cut_lineage
from prepframe.operators import blocks as B
from prepframe.operators.components import connected_components

_BIG = np.iinfo(np.int64).max


def _count(eps2: float, enough: int):
    def kernel(block: B.Block) -> dict:
        k = np.zeros(len(block.x), np.int64)
        for tile in block.tiles():
            for rows, cols, _ in tile:
                rows = rows[k[rows] < enough]  # the others are core points already
                if len(rows):
                    k[rows] += B.close(block.x[rows], block.y[cols], eps2).sum(1)
        return {"_id": block.a["_id"], "_k": k}

    return kernel


def _merge(at: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join the pieces of ``x`` and ``y`` pair by pair; ``at``: the first row of every row's piece."""
    x, y = at[x], at[y]
    while (differ := x != y).any():
        x, y = x[differ], y[differ]
        np.minimum.at(at, np.maximum(x, y), np.minimum(x, y))
        while ((up := at[at]) != at).any():
            at[:] = up
        x, y = at[x], at[y]


def _pieces(eps2: float):
    def kernel(block: B.Block) -> dict:
        n = len(block.x)
        ids = np.concatenate([B.integers(block.a["_id"]), B.integers(block.b["_rid"])])
        at = np.arange(len(ids))
        for tile in block.tiles():
            for rows, cols, _ in tile:
                refs = np.arange(cols.start, cols.stop)
                p, q = at[rows], at[n + refs]
                if (q == q[0]).all():  # points of that piece have nothing to join
                    rows = rows[p != q[0]]
                elif (p == p[0]).all():
                    refs = refs[q != p[0]]
                if len(rows):
                    i, j = np.nonzero(B.close(block.x[rows], block.y[refs], eps2))
                    _merge(at, rows[i], n + refs[j])
        low = np.full(len(ids), _BIG)
        np.minimum.at(low, at, ids)
        stars = np.unique(np.stack([ids, low[at]])[:, low[at] != ids], axis=1)
        return {"_a": stars[0], "_b": stars[1]}

    return kernel


def _lowest(eps2: float):
    def kernel(block: B.Block) -> dict:
        labels, low = block.b["_lab"].to_numpy(), np.full(len(block.x), _BIG)
        for tile in block.tiles():
            for rows, cols, _ in tile:
                near = B.close(block.x[rows], block.y[cols], eps2)
                low[rows] = np.minimum(low[rows], np.where(near, labels[cols], _BIG).min(1))
        found = np.flatnonzero(low < _BIG)
        return {"_id": block.a["_id"].take(found), "_lab": low[found]}

    return kernel


def dbscan(
    df: DataFrame, id_col: str, features: Sequence[str] | str, eps: float, min_points: int = 5, chunk_rows: int | None = None,
) -> DataFrame:
    """``(id, cluster, is_core)`` of every row; noise has cluster -1."""
    eps2 = float(eps) ** 2
    rows = df.select(F.col(id_col).cast("long").alias("_id"), B.vector(features).alias("_v"))
    points = cut_lineage(rows.where(B.complete(F.col("_v"))))
    pivots = B.Pivots(points, chunk_rows)

    def met(p: DataFrame, refs: DataFrame, kernel, schema: str) -> DataFrame:
        """The kernel's rows of the points and of all references that may lie within eps of them."""
        dealt = cut_lineage(pivots.dealt(refs.withColumnRenamed("_id", "_rid")))
        return B.block_pass(pivots.within(p, float(eps)), dealt, kernel, schema, pivots.chunk_rows)

    counts = met(points, points, _count(eps2, min_points), "_id long, _k long").groupBy("_id").agg(F.sum("_k").alias("_k"))
    is_core = F.coalesce(F.col("_k"), F.lit(0)) >= min_points
    points = cut_lineage(points.join(counts, "_id", "left").select("_id", "_v", is_core.alias("_core")))

    core = points.where("_core").select("_id", "_v")
    stars = met(core, core, _pieces(eps2), "_a long, _b long")
    comp = connected_components(stars, "_a", "_b").withColumnRenamed("node", "_id")
    labels = cut_lineage(core.join(comp, "_id", "left").select("_id", "_v", F.coalesce("comp", "_id").alias("_lab")))

    border = points.where("NOT _core").select("_id", "_v")
    near = met(border, labels, _lowest(eps2), "_id long, _lab long").groupBy("_id").agg(F.min("_lab").alias("_lab"))
    edge = border.join(near, "_id", "left").select("_id", F.coalesce("_lab", F.lit(-1)).alias("_lab"), F.lit(False).alias("is_core"))
    lost = rows.where(~B.complete(F.col("_v"))).select("_id", F.lit(None).cast("long").alias("_lab"), F.lit(False).alias("is_core"))
    out = labels.select("_id", "_lab", F.lit(True).alias("is_core")).union(edge).union(lost)
    return out.select(F.col("_id").alias(id_col), F.col("_lab").cast("long").alias("cluster"), "is_core")
