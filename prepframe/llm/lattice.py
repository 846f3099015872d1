"""Operator 7: near-duplicate embeddings by E8 lattice hashing.

Unit vectors are turned by random rotations and cut into blocks of eight coordinates; two
blocks make one table.  Each block is decoded to its nearest E8 point (E8 is D8 and D8
shifted by one half; the nearest point of D8 is rounding with a parity repair), so a table's
cell is a pair of lattice points.  A vector lives in its own cell of every table and also
probes the two neighbouring cells where one block takes the nearest point of the other
half of the lattice.  Vectors that meet in a cell are compared: first with 8-bit copies and
a proven error bound, then by cosine in double precision on the whole vectors.

Equal vectors are one class with a weight.  A cell with many vectors is split into chunks
by a hash, and each pair of chunks is a unit of work of its own, so no cell is one task and
every pair in it is still compared.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components link
with nothing and are their own component; vectors of different length never meet; repeated
rows link with each other; rows with a null id keep a null component; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepframe.llm.common import cut_lineage, map_batches, prepare
from prepframe.operators.components import connected_components

TABLES = 16
SCALE = 3.5  # lattice units of a unit vector at 64 dimensions
CHUNK = 256
STEP_ROWS = 20_000  # rows of whole work units handled at once in a task


def _d8(x: np.ndarray) -> np.ndarray:
    r = np.rint(x)
    e = x - r
    k = np.abs(e).argmax(-1)[..., None]
    odd = (r.sum(-1).astype(np.int64) & 1 == 1)[..., None]
    step = np.where(np.take_along_axis(e, k, -1) >= 0, 1.0, -1.0)
    np.put_along_axis(r, k, np.take_along_axis(r, k, -1) + np.where(odd, step, 0.0), -1)
    return r


def nearest_e8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Twice the nearest E8 point of each row, and twice the nearest point of the other half."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    first = (((x - a) ** 2).sum(-1) <= ((x - b) ** 2).sum(-1))[..., None]
    return (2 * np.where(first, a, b)).astype(np.int64), (2 * np.where(first, b, a)).astype(np.int64)


@lru_cache(maxsize=8)
def _rotations(dim: int) -> list[np.ndarray]:
    r = np.random.RandomState(88)
    return [np.linalg.qr(r.randn(dim, dim))[0] for _ in range(-(-TABLES // (dim // 16)))]


def cells(x: np.ndarray) -> np.ndarray:
    """(rows, 3 * TABLES) cell numbers: per table the own cell and the two probed ones."""
    n, d = x.shape
    dim = -(-d // 16) * 16
    x = np.pad(x, ((0, 0), (0, dim - d)))
    mult = np.random.RandomState(8).randint(0, 2**62, 16, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    out, t = [], 0
    with np.errstate(over="ignore"):

        def number(p: np.ndarray, q: np.ndarray) -> np.ndarray:
            h = (p.astype(np.uint64) * mult[:8]).sum(-1, dtype=np.uint64) + (q.astype(np.uint64) * mult[8:]).sum(-1, dtype=np.uint64)
            h = h + np.uint64(t * 1000003 + d) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            return (h ^ (h >> np.uint64(29))).view(np.int64)

        for rot in _rotations(dim):
            y = (x @ rot).reshape(n, dim // 8, 8) * (SCALE * np.sqrt(dim / 64))
            for k in range(0, dim // 8 - 1, 2):
                if t < TABLES:
                    (p, p2), (q, q2) = nearest_e8(y[:, k]), nearest_e8(y[:, k + 1])
                    out += [number(p, q), number(p, q2), number(p2, q)]
                    t += 1
    return np.stack(out, 1)


def _unit(v) -> np.ndarray | None:
    if v is None or not len(v) or any(x is None for x in v):
        return None
    x = np.asarray(v, float)
    if not np.isfinite(x).all():
        return None
    x = x / (np.abs(x).max() or 1.0)  # keeps very small and very large vectors in range
    norm = np.linalg.norm(x)
    return x / norm if norm > 0 else None


def unit_table(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, key, unit): key names equal vectors, null for those that cannot be compared."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        import xxhash

        units = [_unit(v) for v in b.column(1).to_pylist()]
        raw = [None if u is None else u.tobytes() for u in units]
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([None if r is None else xxhash.xxh3_128_digest(r) for r in raw], pa.binary()), pa.array(raw, pa.binary())],
            names=["vec_id", "key", "unit"],
        )

    return map_batches(df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v")), fn, "vec_id long, key binary, unit binary")


def _entries(classes: DataFrame) -> DataFrame:
    """(cell, rep, home, q, scale, err) of every class: 8-bit copy with its error's length."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        units = [np.frombuffer(u) for u in b.column(1).to_pylist()]
        reps, cell, home, qs, scales, errs = [], [], [], [], [], []
        ids = np.asarray(b.column(0))
        sizes = np.array([len(u) for u in units])
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            x = np.stack([units[i] for i in at])
            s = np.abs(x).max(1) / 127
            q = np.rint(x / s[:, None])
            err = np.linalg.norm(x - q * s[:, None], axis=1) * (1 + 1e-6) + 1e-7
            c = cells(x)
            reps.append(np.repeat(ids[at], c.shape[1]))
            cell.append(c.reshape(-1))
            home.append(np.tile(np.arange(c.shape[1]) % 3 == 0, len(at)))
            raw = [r.tobytes() for r in q.astype(np.int8)]
            qs += [r for r in raw for _ in range(c.shape[1])]
            scales.append(np.repeat(s, c.shape[1]))
            errs.append(np.repeat(err, c.shape[1]))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(cell)), pa.array(np.concatenate(reps)), pa.array(np.concatenate(home)), pa.array(qs, pa.binary()),
             pa.array(np.concatenate(scales)), pa.array(np.concatenate(errs))],
            names=["cell", "rep", "home", "q", "scale", "err"],
        )

    return map_batches(classes.select("rep", "unit"), fn, "cell long, rep long, home boolean, q binary, scale double, err double")


def _meet(work: DataFrame, cosine: float) -> DataFrame:
    """Pairs (a, b) of each work unit whose 8-bit cosine allows the threshold."""

    def pairs_of(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(rows)
        unit = np.stack([np.asarray(t.column(c)) for c in ("cell", "i", "j")], 1)
        group = np.concatenate([[0], np.cumsum((unit[1:] != unit[:-1]).any(1))])
        rep, home, chunk, scale, err = (np.asarray(t.column(c)) for c in ("rep", "home", "chunk", "scale", "err"))
        raw = t.column("q").to_pylist()
        width = max(map(len, raw))
        q = np.stack([np.frombuffer(r.ljust(width, b"\0"), np.int8) for r in raw]).astype(np.float32)
        across = unit[:, 1] != unit[:, 2]
        left, right = [], []
        idx, o = np.arange(len(group)), 0
        while len(idx):
            o += 1
            idx = idx[idx + o < len(group)]
            idx = idx[group[idx] == group[idx + o]]
            k = idx + o
            use = (home[idx] | home[k]) & (rep[idx] != rep[k]) & (~across[idx] | (chunk[idx] != chunk[k]))
            x, y = idx[use], k[use]
            dot = np.einsum("ij,ij->i", q[x], q[y]).astype(float) * scale[x] * scale[y]
            ok = dot >= cosine - (err[x] + err[y] + err[x] * err[y]) - 1e-5
            left.append(np.minimum(rep[x[ok]], rep[y[ok]]))
            right.append(np.maximum(rep[x[ok]], rep[y[ok]]))
        got = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], 1), axis=0) if left else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(got[:, 0].copy()), pa.array(got[:, 1].copy())], names=["a", "b"]) if len(got) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def name(b: pa.RecordBatch, at: int) -> tuple:
            return tuple(b.column(b.schema.get_field_index(c))[at].as_py() for c in ("cell", "i", "j"))

        for b in batches:
            if not b.num_rows:
                continue
            if rows >= STEP_ROWS:
                # Work units are whole up to the one that goes on into this batch.
                last, cut = name(held[-1], held[-1].num_rows - 1), 0
                if name(b, 0) == last:
                    while cut < b.num_rows and name(b, cut) == last:
                        cut += 1
                    held.append(b.slice(0, cut))
                    b = b.slice(cut)
                if b.num_rows:
                    if (out := pairs_of(held)) is not None:
                        yield out
                    held, rows = [], 0
            if b.num_rows:
                held.append(b)
            rows += b.num_rows
        if held and (out := pairs_of(held)) is not None:
            yield out

    return work.mapInArrow(run, "a long, b long").distinct()


def _verify(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    def fn(b: pa.RecordBatch) -> pa.RecordBatch | None:
        keep = [
            i for i, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist()))
            if len(x) == len(y) and float(np.frombuffer(x) @ np.frombuffer(y)) >= cosine
        ]
        return b.select(["a", "b"]).take(pa.array(keep, pa.int64())) if keep else None

    left = classes.select(F.col("rep").alias("a"), F.col("unit").alias("ua"))
    right = classes.select(F.col("rep").alias("b"), F.col("unit").alias("ub"))
    return map_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "ua", "ub"), fn, "a long, b long")


def near_duplicates(df: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding", chunk: int = CHUNK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    prepare(df.sparkSession)
    table = unit_table(df, id_col, vec_col)
    classes = cut_lineage(
        table.where("key IS NOT NULL AND vec_id IS NOT NULL").groupBy("key").agg(
            F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("unit").alias("unit")
        )
    )
    entries = _entries(classes)
    sizes = entries.groupBy("cell").agg(F.count(F.lit(1)).alias("c"), F.count_if("home").alias("h")).where("c > 1 AND h > 0")
    sizes = sizes.select("cell", F.ceil(F.col("c") / chunk).cast("int").alias("chunks"))
    work = entries.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    work = work.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    work = work.withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")).drop("other", "chunks")
    work = work.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    links = cut_lineage(_verify(_meet(work, cosine), classes, cosine))

    weight = classes.select("rep", "weight")
    ends = links.join(weight.withColumnRenamed("rep", "b"), "b").select(F.col("a").alias("rep"), "weight")
    ends = ends.union(links.join(weight.withColumnRenamed("rep", "a"), "a").select(F.col("b").alias("rep"), "weight"))
    count = ends.groupBy("rep").agg(F.sum("weight").alias("beside"))
    comp = connected_components(links, "a", "b").withColumnRenamed("node", "rep")
    of_class = classes.drop("unit").join(count, "rep", "left").join(comp, "rep", "left").select(
        "key", (F.coalesce("beside", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("comp", "rep").alias("component_id")
    )
    out = table.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key")).join(of_class, "key", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
