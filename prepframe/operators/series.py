"""Per-series filters (D20 FIR, D21 IIR, D22 moving median).

A window ``partitionBy(series)`` sends a whole series to one task - a series
holding a third of the rows would be one straggler.  The FIR filter and the moving median
cut the rows into ranges of (series, order) and hand each range the few rows around it
(`ordering.with_halo`): a plain window inside the range then sees what it needs, and all
other columns are only carried along.  The IIR filter is a parallel prefix over the affine
maps of the range layout's partitions, streamed batch by batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from prepframe._session import cut_lineage, ship_package, shuffle_partitions
from prepframe.operators.ordering import with_halo


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _around(df: DataFrame, series, order, before: int, after: int, x: Column, out: str, combine, nbuckets: int | None) -> DataFrame:
    """``combine(values of the rows n - before .. n + after of the series, in order)``."""
    series, order = _as_list(series), _as_list(order)
    near = with_halo(df, order, series, before, after, "_halo_bucket", "_halo_own", nbuckets)
    w = Window.partitionBy("_halo_bucket", *series).orderBy(*order).rowsBetween(-before, after)
    seen = near.withColumn(out, F.collect_list(x).over(w)).where("_halo_own")
    return seen.withColumn(out, combine(F.col(out))).drop("_halo_bucket", "_halo_own")


def fir_filter(
    df: DataFrame, series, order, value: str, taps: Sequence[float], out: str = "fir", nbuckets: int | None = None
) -> DataFrame:
    """``y[n] = sum_i taps[i] * x[n - i]`` inside each series in ``order`` (make the order
    total); values before the series start count as 0, null values as 0."""
    h = F.array(*[F.lit(float(t)) for t in taps])
    x = F.coalesce(F.col(value).cast("double"), F.lit(0.0))

    def combine(seen: Column) -> Column:
        # Newest first; at the start of a series fewer values than taps
        products = F.zip_with(F.reverse(seen), h, lambda v, t: F.coalesce(v, F.lit(0.0)) * t)
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    return _around(df, series, order, len(taps) - 1, 0, x, out, combine, nbuckets)


def median_filter(df: DataFrame, series, order, value: str, half_width: int, out: str = "median", nbuckets: int | None = None) -> DataFrame:
    """Centred median of rows ``n - w .. n + w`` that exist in the series (exact; nulls are skipped)."""
    w = int(half_width)

    def combine(seen: Column) -> Column:
        a, n = F.array_sort(seen), F.size(seen)
        low, high = F.get(a, F.floor((n - 1) / 2).cast("int")), F.get(a, F.floor(n / 2).cast("int"))
        return F.when(n > 0, low + (high - low) / 2)

    return _around(df, series, order, w, w, F.col(value).cast("double"), out, combine, nbuckets)


# ------------------------------------------------------------------ IIR

# Samples that one product of matrices filters at once.
BLOCK = 64


class Recursion:
    """An IIR filter as an affine map of its state: direct form II transposed, in blocks.

    A block of samples x from state z gives ``response @ x + free @ z`` and the new state
    ``gain @ x + power @ z``."""

    def __init__(self, b: Sequence[float], a: Sequence[float], block: int = BLOCK):
        n = max(len(a), len(b))
        b, a = (np.pad(np.asarray(c, dtype=float), (0, n - len(c))) / float(a[0]) for c in (b, a))
        self.order, self.block = n - 1, block
        p = self.order
        self.b, self.a = b, a
        self.step = np.zeros((p, p))  # state without input
        self.step[:, :1] = -a[1:, None]
        self.step[np.arange(p - 1), np.arange(1, p)] = 1.0
        self.enter = (b[1:] - a[1:] * b[0])[:, None]  # one sample into the state
        look = np.eye(1, p)
        # State and output after each of the block's samples
        powers = [np.eye(p)]
        for _ in range(block):
            powers.append(self.step @ powers[-1])
        self.free = np.vstack([look @ m for m in powers[:block]]).reshape(block, p)
        impulse = np.array([b[0], *[(look @ m @ self.enter)[0, 0] if p else 0.0 for m in powers[: block - 1]]])
        lag = np.arange(block)[:, None] - np.arange(block)
        self.response = np.where(lag >= 0, impulse[np.maximum(lag, 0)], 0.0)
        self.gain = np.hstack([powers[block - 1 - j] @ self.enter for j in range(block)]).reshape(p, block)
        self.power = powers[block]

    def run(self, x: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Outputs of ``x`` from state ``z``, and the state behind them."""
        n, size = len(x) // self.block, self.block
        y = np.empty(len(x))
        if n:
            blocks = x[: n * size].reshape(n, size)
            drive, states = blocks @ self.gain.T, np.empty((n, self.order))
            for k in range(n):
                states[k] = z
                z = drive[k] + self.power @ z
            y[: n * size] = (blocks @ self.response.T + states @ self.free.T).ravel()
        z = z.copy()
        for k in range(n * size, len(x)):
            y[k] = self.b[0] * x[k] + (z[0] if self.order else 0.0)
            z = self.step @ z + self.enter[:, 0] * x[k]
        return y, z

    def after(self, z: np.ndarray, samples: int) -> np.ndarray:
        """The state after so many zero samples."""
        return np.linalg.matrix_power(self.step, int(samples)) @ z if self.order else z


def _runs(keys: pa.Array) -> list[tuple[str, int, int]]:
    """(key, start, end) of the runs of equal keys of a batch."""
    n = len(keys)
    if n == 0:
        return []
    change = np.ones(n, bool)
    if n > 1:
        change[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(change)
    return [(keys[int(a)].as_py(), int(a), int(b)) for a, b in zip(starts, [*starts[1:], n])]


def _samples(values: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(values.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False), dtype=float)


def iir_filter(
    df: DataFrame, series, order, value: str, b: Sequence[float], a: Sequence[float], out: str = "iir", nbuckets: int | None = None
) -> DataFrame:
    """Recursive filter ``a[0] y[n] = sum b[i] x[n-i] - sum_{j>=1} a[j] y[n-j]`` per series
    (zero initial state, null -> 0; null series are one series).

    The rows are laid out once in ranges of (series, order).  A range of samples maps the
    filter's state by an affine map, so the ranges are filtered in parallel: a first pass
    streams key and value and reports, for the first and last series of each range, its
    length and the state that it leaves from zero; these at most two rows a range are chained
    (the state crosses a range by a power of the state matrix); a second pass streams the
    rows again from their true states.  A batch is filtered block by block as matrix
    products; only the state and the key are carried from batch to batch, and the other
    columns pass as Arrow columns that nothing looks into."""
    series, order = _as_list(series), _as_list(order)
    spark = df.sparkSession
    ship_package(spark)
    filt = Recursion(b, a)
    p, cols = filt.order, df.columns
    sort = [F.col(c) for c in [*series, *order]]
    # The key as text: null, NaN and dates of any year compare as they group
    key = F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(series)]))
    laid = df.withColumns({"_iir_key": key, "_iir_x": F.col(value).cast("double")})
    laid = laid.repartitionByRange(nbuckets or shuffle_partitions(spark), *sort).sortWithinPartitions(*sort)
    laid = cut_lineage(laid.withColumn("_iir_range", F.spark_partition_id()))

    def report(rows: list[tuple]) -> pa.RecordBatch:
        r, i, k, n, z = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(r, pa.int32()), pa.array(i, pa.int32()), pa.array(k, pa.string()), pa.array(n, pa.int64()), pa.array([x.tolist() for x in z], pa.list_(pa.float64()))],
            names=["range", "place", "key", "n", "z"],
        )

    def left_behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, z, first, at = None, 0, np.zeros(p), None, None
        for batch in batches:
            x = _samples(batch.column(1))
            for k, s, e in _runs(batch.column(0)):
                if k != key:
                    if key is not None and first is None:
                        first = (at, 0, key, n, z)
                    key, n, z = k, 0, np.zeros(p)
                at = batch.column(2)[s].as_py()
                _, z = filt.run(x[s:e], z)
                n += e - s
        if first is not None:
            yield report([first])
        if key is not None:
            yield report([(at, 1, key, n, z)])

    found = laid.select("_iir_key", "_iir_x", "_iir_range").mapInArrow(left_behind, "range int, place int, key string, n long, z array<double>")
    # at most two rows per range; a range's first series can only have begun in ranges before it
    starts: dict[int, tuple[str, list[float]]] = {}
    carried, state = None, np.zeros(p)
    for r in sorted(found.collect(), key=lambda r: (r["range"], r["place"])):
        if r["key"] == carried:
            starts[r["range"]] = (carried, state.tolist())
        else:
            carried, state = r["key"], np.zeros(p)
        state = filt.after(state, r["n"]) + np.array(r["z"], dtype=float)
    begun = spark.sparkContext.broadcast(starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, z = None, np.zeros(p)
        for batch in batches:
            keys = batch.column("_iir_key")
            x, y = _samples(batch.column("_iir_x")), np.empty(batch.num_rows)
            for k, s, e in _runs(keys):
                if k != key:
                    z = np.zeros(p)
                    if key is None:
                        known = begun.value.get(batch.column("_iir_range")[s].as_py())
                        z = np.array(known[1], dtype=float) if known and known[0] == k else z
                    key = k
                y[s:e], z = filt.run(x[s:e], z)
            kept = [batch.column(c) for c in cols]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(y)], names=[*cols, out])

    kept = [f for f in df.schema.fields]
    if out in cols:
        raise ValueError(f"the result column {out!r} is there already")
    return laid.mapInArrow(run, StructType([*kept, StructField(out, DoubleType())]))
