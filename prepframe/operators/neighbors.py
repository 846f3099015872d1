"""Exact k-nearest-neighbour classification (D42) by a pivot-partitioned join.

1. Labelled rows belong to the Voronoi cells of at most `blocks.MAX_PIVOTS` pivots.
2. Every query meets its own cell first; the k-th best distance there bounds its radius.
3. It is then sent only to the cells that the triangle inequality leaves within that radius,
   and there compared only with rows whose distance to the pivot fits (a ring).

Both passes run in bounded blocks (see `blocks`) that keep each query's k best; nothing passes
through the driver and no pair row is emitted.  ``knn_work`` says how many distances were
computed.  Votes go to the most frequent label, ties to the smaller label; distance ties go
to the smaller reference id.  Queries with a missing feature are kept with a null prediction.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepframe._session import cut_lineage
from prepframe.operators import blocks as B


def _best(k: int, pivots: np.ndarray):
    def kernel(block: B.Block) -> dict:
        block.leave_copies(k)  # else all copies of a vector are candidates of every query
        n = len(block.x)
        ids, dp = B.integers(block.b["_rid"]), block.b["_dp"].to_numpy()
        # squared bounds of the k-th distance: they shrink as nearer rows are found
        most = block.a["_radius"].to_numpy() ** 2 * (1 + B.SLACK)
        seen, kept = np.zeros(n, np.int64), []
        for tile in block.tiles():
            q, j, d2 = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            for rows, cols, cell in tile:
                dq, to = np.sqrt(B.squared_distances(block.x[rows], pivots[cell][None])), dp[None, cols]
                with np.errstate(invalid="ignore"):
                    ring = np.abs(dq - to) <= np.sqrt(most[rows])[:, None] + B.SLACK * (1 + dq + to)
                refs = cols.start + np.flatnonzero(ring.any(0))
                if not len(refs):
                    continue
                seen[rows] += len(refs)
                x, y = block.x[rows], block.y[refs]
                rough, room = B.rough_distances(x, y)
                bound = most[rows]
                if len(refs) >= k and np.isinf(bound).any():
                    bound = np.minimum(bound, np.partition(rough, k - 1, axis=1)[:, k - 1] + room)
                a, b = np.nonzero(~(rough > (bound + room)[:, None]))
                q, j = np.concatenate([q, rows[a]]), np.concatenate([j, refs[b]])
                d2 = np.concatenate([d2, B.pair_distances(x, y, a, b)])
                order = np.lexsort((ids[j], d2, q))  # ties by reference id
                q, j, d2 = q[order], j[order], d2[order]
                rank = np.arange(len(q)) - np.searchsorted(q, q)
                q, j, d2, rank = (v[rank < k] for v in (q, j, d2, rank))
                last = rank == k - 1
                most[q[last]] = np.fmin(most[q[last]], d2[last])
            kept.append((q, j, d2))
        q, j, d2 = (np.concatenate(v) for v in zip(*kept))
        found, first = np.unique(q, return_index=True)
        none = np.setdiff1d(np.flatnonzero(seen), found)  # compared, but nothing as near as the bound
        count = np.zeros(len(q) + len(none), np.int64)
        count[first], count[len(q) :] = seen[found], seen[none]
        refs = pa.array(np.append(j, np.zeros(len(none), np.int64)), mask=np.arange(len(count)) >= len(q))
        dist2 = pa.array(np.append(d2, np.zeros(len(none))), mask=np.arange(len(count)) >= len(q))
        return {
            "_id": block.a["_id"].take(np.append(q, none)), "_rid": block.b["_rid"].take(refs), "dist2": dist2,
            "_lab": block.b["_lab"].take(refs), "_seen": count,
        }

    return kernel


def _candidates(train, test, features, label, k, train_id, test_id, chunk_rows) -> DataFrame:
    """(_id, _rid, dist2, _lab, _seen): the best k of every block that a query meets, dist2 null where none is as near as the bound."""
    refs = train.select(F.col(train_id).cast("long").alias("_rid"), B.vector(features).alias("_v"), F.col(label).alias("_lab"))
    refs = cut_lineage(refs.where(B.complete(F.col("_v")) & F.col("_lab").isNotNull()))
    queries = test.select(F.col(test_id).cast("long").alias("_id"), B.vector(features).alias("_v")).where(B.complete(F.col("_v")))
    kind = train.schema[label].dataType.simpleString()
    schema = f"_id long, _rid long, dist2 double, _lab {kind}, _seen long"
    pivots = B.Pivots(refs, chunk_rows)
    if not pivots.rows:
        return train.sparkSession.createDataFrame([], schema)
    refs = cut_lineage(pivots.dealt(refs))

    def met(rows: DataFrame, home: bool) -> DataFrame:
        return B.block_pass(pivots.within(rows, "_radius", home), refs, _best(k, pivots.at), schema, pivots.chunk_rows)

    unbounded = F.lit(float("inf"))
    home = cut_lineage(met(queries.withColumn("_radius", unbounded), True))
    w = Window.partitionBy("_id").orderBy("dist2", "_rid")  # at most k rows of every block
    kth = home.where("dist2 IS NOT NULL").withColumn("r", F.row_number().over(w)).where(F.col("r") == k)
    kth = kth.select(F.col("_id").alias("_q"), F.sqrt("dist2").alias("_radius"))
    bounded = queries.join(kth, F.col("_id") == F.col("_q"), "left").select("_id", "_v", F.coalesce("_radius", unbounded).alias("_radius"))
    return home.union(met(bounded, False))


def knn_neighbours(
    train: DataFrame, test: DataFrame, features: Sequence[str] | str, label: str, k: int,
    train_id: str, test_id: str, chunk_rows: int | None = None,
) -> DataFrame:
    """``(test_id, rank, ref_id, dist2, label)`` for the k nearest labelled rows."""
    best = _candidates(train, test, features, label, k, train_id, test_id, chunk_rows).where("dist2 IS NOT NULL")
    # at most k rows per query and block
    w = Window.partitionBy("_id").orderBy("dist2", "_rid")
    top = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.select(F.col("_id").alias(test_id), "rank", F.col("_rid").alias("ref_id"), "dist2", F.col("_lab").alias(label))


def knn_work(
    train: DataFrame, test: DataFrame, features: Sequence[str] | str, label: str, k: int, train_id: str, test_id: str,
    chunk_rows: int | None = None,
) -> DataFrame:
    """``(distances, all_pairs)``: distances computed between queries and labelled rows, and how many there are."""
    seen = _candidates(train, test, features, label, k, train_id, test_id, chunk_rows).agg(F.coalesce(F.sum("_seen"), F.lit(0)).alias("distances"))
    refs, queries = train.where(B.complete(B.vector(features)) & F.col(label).isNotNull()).count(), test.where(B.complete(B.vector(features))).count()
    return seen.select("distances", F.lit(refs * queries).cast("long").alias("all_pairs"))


def knn_classify(
    train: DataFrame, test: DataFrame, features: Sequence[str] | str, label: str, k: int = 5,
    train_id: str = "id", test_id: str | None = None, chunk_rows: int | None = None,
) -> DataFrame:
    """``(test_id, prediction)`` of every query: majority label of the k nearest rows (ties: smaller label)."""
    test_id = test_id or train_id
    near = knn_neighbours(train, test, features, label, k, train_id, test_id, chunk_rows)
    votes = near.groupBy(test_id, label).agg(F.count(F.lit(1)).alias("_n"))
    said = votes.groupBy(test_id).agg(F.min_by(F.col(label), F.struct(-F.col("_n"), F.col(label))).alias("prediction"))
    return test.select(F.col(test_id)).join(said, test_id, "left")
