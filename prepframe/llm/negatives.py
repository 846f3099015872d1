"""Operator 12: hard negatives by segment summary filtering.

A vector is cut into up to eight segments.  The store keeps the mean and the deviation
(norm of the centred part) of each; with L components a segment adds

    L * mean_a * mean_b  -+  dev_a * dev_b

as bounds to the inner product, and the means and deviations of joined segments follow from
those of their parts.  A block of anchors meets a batch of rows level by level: two
segments first, as one product of small matrices, then four and eight for the pairs still
possible, and only what survives is scored exactly.

1. ``build_store`` writes one row per vector: id, label, integer components, means and
   deviations (Parquet in the shared folder).
2. Anchors are taken in blocks of bounded size; a block is broadcast and every task runs
   over its own rows of the store once for the positives and once for the negatives, so
   no vector is shuffled, copied or paired by a join.
3. A task keeps the best ``k`` rows of each anchor (for negatives: of each anchor and
   positive) and passes over pairs whose upper bound lies below the k-th of them or
   outside the wanted window; the best of all tasks are ranked per anchor and positive.

Scores are whole numbers: each component x becomes floor(scale * x).  Sums that a double
holds exactly are multiplied as doubles, others as long integers.

Edge cases: rows with a null id, label or vector, or any null or non-finite component, take
no part; vectors of other lengths than the anchor's are not comparable to it and skipped;
an empty vector scores 0; rows that repeat an id count once (smallest label, then smallest
vector); ties go to the smaller id; an anchor without positives, or without negatives in
the window, has no rows; an empty table gives an empty result.  Components whose scores
could leave a long raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prepframe.llm.common import bitmap_flag, cut_lineage, map_batches, prepare, scratch_path

SEGMENTS = 8
# Components of one block of anchors (8 bytes each), the bound of a broadcast.
BLOCK_VALUES = 1 << 19
# Anchors that meet a batch of rows at once.
TILE = 512
STORE = "vec_id long, label long, size int, vector binary, means binary, devs binary"


def summaries(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment lengths, and per row the mean and the deviation of every segment."""
    d = q.shape[1]
    cut = np.unique(np.linspace(0, d, min(SEGMENTS, d) + 1).astype(int))
    lengths = np.diff(cut)
    means, devs = np.zeros((len(q), len(lengths))), np.zeros((len(q), len(lengths)))
    for k, (a, b) in enumerate(zip(cut, cut[1:])):
        part = q[:, a:b].astype(float)
        means[:, k] = part.mean(1)
        devs[:, k] = np.sqrt(((part - means[:, k, None]) ** 2).sum(1))
    return lengths, means, devs


def joined(lengths: np.ndarray, means: np.ndarray, devs: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """sqrt(L) * mean and deviation of ``parts`` joined segments."""
    at = np.unique(np.linspace(0, len(lengths), min(parts, len(lengths)) + 1).astype(int))[:-1]
    if not len(lengths):
        return np.zeros((len(means), 0)), np.zeros((len(means), 0))
    n = np.add.reduceat(lengths, at)
    m = np.add.reduceat(means * lengths, at, axis=1) / n
    square = np.add.reduceat(devs**2 + lengths * means**2, at, axis=1) - n * m**2
    return np.sqrt(n) * m, np.sqrt(np.maximum(square, 0.0))


class Side:
    """Vectors of one length with their summaries at every level."""

    def __init__(self, ids, labels, q, lengths, means, devs):
        self.ids, self.labels, self.q = ids, labels, q
        self.top = float(np.abs(q).max(initial=0))
        self.levels = [joined(lengths, means, devs, s) for s in (2, 4, 8)]
        # Room for rounding: far more than the products of doubles can be off.
        self.slack = 1e-9 * np.sqrt((q.astype(float) ** 2).sum(1)) + 1e-9

    def take(self, rows) -> "Side":
        out = object.__new__(Side)
        out.ids, out.labels, out.q, out.top = self.ids[rows], self.labels[rows], self.q[rows], self.top
        out.levels, out.slack = [(u[rows], d[rows]) for u, d in self.levels], self.slack[rows]
        return out


def exact(a: Side, b: Side) -> np.ndarray:
    d = a.q.shape[1]
    if a.top * b.top * d < 2.0**53:
        return (a.q.astype(float) @ b.q.astype(float).T).astype(np.int64)
    if a.top * b.top * d >= 2.0**63:
        raise ValueError("scores do not fit in a long")
    return a.q @ b.q.T


def exact_pairs(a: Side, b: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    if a.top * b.top * a.q.shape[1] >= 2.0**63:
        raise ValueError("scores do not fit in a long")
    out = np.empty(len(i), np.int64)
    for k in range(0, len(i), 65_536):
        s = slice(k, k + 65_536)
        out[s] = np.einsum("ij,ij->i", a.q[i[s]], b.q[j[s]])
    return out


def candidates(a: Side, b: Side, low: np.ndarray, high: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of the allowed pairs whose score lies in [low[i], high[i]].

    Bounds by two segments for all pairs; by four and eight for those still possible."""
    (ua, da), (ub, db) = a.levels[0], b.levels[0]
    mid, dev = ua @ ub.T, da @ db.T
    room = dev + a.slack[:, None] * (1 + np.abs(ub).sum(1) + db.sum(1)) + b.slack * (1 + np.abs(ua).sum(1) + da.sum(1))[:, None]
    i, j = np.nonzero(allowed & (mid + room >= low[:, None]) & (mid - room <= high[:, None]))
    for (ua, da), (ub, db) in zip(a.levels[1:], b.levels[1:]):
        if 4 * len(i) > mid.size:  # the bound says little here: a product of the whole tile is cheaper
            break
        mid_p, dev_p = np.einsum("ij,ij->i", ua[i], ub[j]), np.einsum("ij,ij->i", da[i], db[j])
        room_p = dev_p + a.slack[i] * (1 + np.abs(ub[j]).sum(1) + db[j].sum(1)) + b.slack[j] * (1 + np.abs(ua[i]).sum(1) + da[i].sum(1))
        stay = (mid_p + room_p >= low[i]) & (mid_p - room_p <= high[i])
        i, j = i[stay], j[stay]
    if 20 * len(i) > mid.size:
        score = exact(a, b)[i, j]
    else:
        score = exact_pairs(a, b, i, j)
    stay = (score >= low[i]) & (score <= high[i])
    return i[stay], j[stay], score[stay]


class Best:
    """The k best (score, id) of every slot, smaller ids first among equals."""

    def __init__(self, slots: int, k: int):
        self.k, self.slots = k, slots
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(slots, np.iinfo(np.int64).min)  # a full slot's k-th score

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = np.concatenate([self.slot, slot]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        o = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[o], score[o], ids[o]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        self.least[slot[rank == self.k - 1]] = score[rank == self.k - 1]
        self.slot, self.score, self.id = (x[rank < self.k] for x in (slot, score, ids))


def _sides(b: pa.RecordBatch) -> Iterator[Side]:
    """The batch's vectors by length."""
    ids, labels, size = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
    raw, means, devs = (b.column(k).to_pylist() for k in (3, 4, 5))
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        q = np.frombuffer(b"".join(raw[k] for k in at), "<i8").reshape(len(at), d)
        cut = np.unique(np.linspace(0, d, min(SEGMENTS, d) + 1).astype(int))
        m, v = (np.frombuffer(b"".join(x[k] for k in at), "<f8").reshape(len(at), -1 if d else 0) for x in (means, devs))
        yield Side(ids[at], labels[at], q, np.diff(cut), m, v)


def build_store(
    vectors: DataFrame, out: str, scale: int = 256, id_col: str = "vec_id", label: Column | str = "label", vector_col: str = "embedding",
) -> None:
    """Write the summary store of ``vectors`` to the shared folder ``out``."""
    prepare(vectors.sparkSession)
    src = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    src = src.where(finite)
    # Narrow: ids that occur more than once; only their rows are shuffled.
    twice = cut_lineage(src.groupBy("vec_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("vec_id"))
    marked = bitmap_flag(src, "vec_id", twice)
    some = marked.where("_maybe").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("s")).select("vec_id", "s.label", "s.v")
    rows = marked.where("NOT _maybe").drop("_maybe").union(some)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        lists = b.column(2)
        size = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
        flat, start = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(size)])
        packed: list = [None] * b.num_rows
        for d in np.unique(size):
            at = np.flatnonzero(size == d)
            x = np.floor(scale * np.stack([flat[start[k] : start[k + 1]] for k in at]).reshape(len(at), d))
            if np.abs(x).max(initial=0) >= 2.0**62:
                raise ValueError("components do not fit in a long")
            q = x.astype("<i8")
            _, m, v = summaries(q)
            for k, row in enumerate(at):
                packed[row] = (q[k].tobytes(), m[k].tobytes(), v[k].tobytes())
        vec, m, v = zip(*packed)
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(size, pa.int32()), *(pa.array(x, pa.binary()) for x in (vec, m, v))],
            names=[c.split()[0] for c in STORE.split(", ")],
        )

    map_batches(rows, run, STORE).write.option("compression", "zstd").parquet(out)


def _search(spark: SparkSession, store: DataFrame, block: list[Side], k: int, windows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] | None) -> DataFrame:
    """(anchor, slot, vec_id, score): every task's best ``k`` rows of each anchor and slot.

    Without ``windows``: rows of the anchor's label, one slot. With: per side the slot
    numbers and the score windows (anchors x slots) for rows of other labels."""
    shared = spark.sparkContext.broadcast((block, windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, wins = shared.value
        best = [[Best(len(s.ids), k) for _ in range(1 if wins is None else wins[n][0].shape[1])] for n, s in enumerate(sides)]
        for b in batches:
            if not b.num_rows:
                continue
            for rows in _sides(b):
                for n, s in enumerate(sides):
                    if s.q.shape[1] != rows.q.shape[1]:
                        continue
                    for t in range(0, len(s.ids), TILE):
                        span = np.arange(t, min(t + TILE, len(s.ids)))
                        a = s.take(span)
                        same = a.labels[:, None] == rows.labels
                        if wins is None:
                            top = best[n][0]
                            free = same & (a.ids[:, None] != rows.ids)
                            i, j, score = candidates(a, rows, top.least[span], np.full(len(span), np.iinfo(np.int64).max), free)
                            top.add(span[i], score, rows.ids[j])
                            continue
                        low, high = wins[n][0][span], wins[n][1][span]
                        least = np.stack([x.least[span] for x in best[n]], 1)
                        i, j, score = candidates(a, rows, np.maximum(low, least).min(1), high.max(1), ~same)
                        for m, x in enumerate(best[n]):
                            hit = (score >= np.maximum(low, least)[i, m]) & (score <= high[i, m])
                            x.add(span[i[hit]], score[hit], rows.ids[j[hit]])
        for n, s in enumerate(sides):
            for m, x in enumerate(best[n]):
                if len(x.slot):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s.ids[x.slot]), pa.array(np.full(len(x.slot), m, np.int32)), pa.array(x.id), pa.array(x.score)],
                        names=["anchor", "slot", "vec_id", "score"],
                    )

    found = store.mapInArrow(run, "anchor long, slot int, vec_id long, score long")
    w = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")  # at most k rows of every task
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine(
    spark: SparkSession, path: str, anchors: Column, positives: int = 5, negatives: int = 10, low_percent: int = 30,
    high_percent: int = 90, block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """Hard negatives of the rows of the store that meet ``anchors``.

    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every
    anchor and each of its best ``positives`` rows of the same label, the best ``negatives``
    rows of other labels that score between the two percentages of the positive's score."""
    prepare(spark)
    store = spark.read.schema(STORE).parquet(path)
    chosen = store.where(anchors)
    n, d = chosen.agg(F.count(F.lit(1)), F.coalesce(F.max("size"), F.lit(0))).collect()[0]  # one row
    blocks = max(1, -(-n * max(d, 1) // block_values))
    out = scratch_path(spark, "negatives")
    none = np.iinfo(np.int64)
    for b in range(blocks if n else 0):
        picked = chosen.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)
        rows = picked.toArrow()  # one block of anchors: about block_values components
        sides = [s for batch in rows.combine_chunks().to_batches(max_chunksize=max(1, rows.num_rows)) for s in _sides(batch)]
        near = _search(spark, store, sides, positives, None).collect()  # bounded: positives rows for each anchor of the block
        found: dict[int, list] = {}
        for r in near:
            found.setdefault(r["anchor"], []).append((r["rank"], r["vec_id"], r["score"]))
        windows, named = [], []
        for s in sides:
            low = np.full((len(s.ids), positives), none.max)
            high = np.full((len(s.ids), positives), none.min)
            for k, a in enumerate(s.ids.tolist()):
                for rank, i, score in found.get(a, ()):
                    # Whole numbers with low_percent * positive <= 100 * score <= high_percent * positive.
                    low[k, rank - 1], high[k, rank - 1] = -(-low_percent * score // 100), high_percent * score // 100
                    named.append((a, rank - 1, i, score))
            windows.append((low, high))
        of = spark.createDataFrame(named, "anchor long, slot int, positive_id long, positive_score long")
        best = _search(spark, store, sides, negatives, windows).join(of, ["anchor", "slot"])
        best.select(
            F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(out)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.read.schema(schema).parquet(out) if n else spark.createDataFrame([], schema)
