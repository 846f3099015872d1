"""Distance work between two point tables as bounded blocks, without the driver.

Points belong to the Voronoi cells of a few pivots (`Pivots`); a row meets only the cells
that the triangle inequality leaves.  Near cells share a chunk of about ``chunk_rows``
references, a crowded cell is many chunks; every row is sent once to each chunk it must meet,
however many of the chunk's cells that are.  Every (point group, chunk) pair is one group of a
cogrouped pass, so no task holds more than two chunks; inside, distances are taken tile by
tile (a matrix product leaves out what is surely too far, differences decide the rest).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepframe._session import cut_lineage, ship_package

# Coordinates of a chunk (8 MB), rows on a side of a tile, pairs whose differences are held at once.
CHUNK_VALUES = 1 << 20
TILE = 1000
PAIRS = 100_000


def vector(features: Sequence[str] | str) -> Column:
    if isinstance(features, str):
        return F.col(features).cast("array<double>")
    return F.array(*[F.col(c).cast("double") for c in features])


def complete(v: Column) -> Column:
    return F.coalesce(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(False))


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differences first: large common offsets do not cancel."""
    out = np.zeros((len(x), len(y)))
    for k in range(x.shape[1]):
        d = x[:, k, None] - y[None, :, k]
        out += d * d
    return out


def pair_distances(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``squared_distances`` of the pairs ``(i, j)`` only, to the last bit."""
    out = np.zeros(len(i))
    for at in range(0, len(i), PAIRS):
        s = slice(at, at + PAIRS)
        a, b = x[i[s]], y[j[s]]
        for k in range(x.shape[1]):
            d = a[:, k] - b[:, k]
            out[s] += d * d
    return out


def rough_distances(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances by a matrix product about one of the points, and how far they may be off."""
    with np.errstate(invalid="ignore", over="ignore"):
        p, q = x - y[0], y - y[0]
        pp, qq = (p * p).sum(1), (q * q).sum(1)
        d2 = p @ q.T
        d2 *= -2.0
        d2 += pp[:, None]
        d2 += qq
        return d2, 8 * (x.shape[1] + 4) * np.finfo(float).eps * float(pp.max() + qq.max())


def close(x: np.ndarray, y: np.ndarray, most: float) -> np.ndarray:
    """``squared_distances(x, y) <= most``."""
    d2, room = rough_distances(x, y)
    hit = d2 <= most - room
    i, j = np.nonzero(~(hit | (d2 > most + room)))  # also what is not a number
    if len(i):
        hit[i, j] = pair_distances(x, y, i, j) <= most
    return hit


def matrix(v: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(v, pa.ChunkedArray):
        v = v.combine_chunks()
    if not len(v):
        return np.zeros((0, 0))
    long = pc.min_max(pc.list_value_length(v)).as_py()
    if long["min"] != long["max"]:
        raise ValueError(f"vectors of {long['min']} and of {long['max']} components")
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1).astype(np.float64, copy=False)


def integers(v: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(v, np.iinfo(np.int64).min).to_numpy()


# Pivots of a point table: at most so many, whatever its size.
MAX_PIVOTS = 256
# Room for rounding in bounds that follow from rounded distances.
SLACK = 1e-9


def _pieces(batches) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most TILE rows: distances to the pivots are held for one part."""
    for b in batches:
        for at in range(0, b.num_rows, TILE):
            yield b.slice(at, TILE)


class Pivots:
    """Voronoi cells of a few points of a table, with the radii of the cells.

    Every point belongs to the cell of its nearest pivot.  By the triangle inequality a row
    with distance D to the pivot of a cell has no point of that cell nearer than D - outer or
    inner - D, nor, if another pivot lies at distance G from it and E from the cell's, nearer
    than (D^2 - G^2) / (2 E)."""

    def __init__(self, points: DataFrame, chunk_rows: int | None = None):
        spark, rows = points.sparkSession, points.count()
        self.rows = rows
        wanted = min(MAX_PIVOTS, int(np.ceil(np.sqrt(rows))))
        drawn = points.select("_v") if rows <= 4 * wanted else points.select("_v").sample(fraction=4 * wanted / rows, seed=23)
        got = drawn.limit(wanted).collect()  # limit: at most MAX_PIVOTS rows
        self.at = np.unique(np.array([r["_v"] for r in got], dtype=np.float64), axis=0) if got else np.zeros((1, 0))
        self.between = np.sqrt(squared_distances(self.at, self.at))
        self.outer, self.inner, self.size = (np.zeros(len(self.at)) for _ in range(3))
        self.first, self.parts = (np.zeros(len(self.at), np.int32) for _ in range(2))
        self.chunk_rows = chunk_rows or max(TILE, CHUNK_VALUES // max(self.at.shape[1], 1))
        ship_package(spark)
        cells = self.own(points).groupBy("_cell").agg(
            F.max("_dp").alias("outer"), F.min("_dp").alias("inner"), F.count(F.lit(1)).alias("n"),
        )
        for r in cells.collect():  # one row per pivot
            self.outer[r["_cell"]], self.inner[r["_cell"]], self.size[r["_cell"]] = r["outer"], r["inner"], r["n"]
        self._chunks()

    def _chunks(self) -> None:
        """Cells to chunks: small neighbouring cells together, a crowded cell in parts of its own."""
        left, path = set(range(1, len(self.at))), [0]
        while left:  # every cell after the nearest one that is left
            path.append(min(left, key=lambda c: self.between[path[-1], c]))
            left.remove(path[-1])
        chunk, held = -1, np.inf
        for c in path:
            parts = max(1, int(np.ceil(self.size[c] / self.chunk_rows)))
            if parts > 1 or held + self.size[c] > self.chunk_rows:
                chunk, held = chunk + 1, 0
            self.first[c], self.parts[c] = chunk, parts
            held += self.size[c] if parts == 1 else np.inf
            chunk += parts - 1
        cell = np.repeat(np.arange(len(self.at)), self.parts)
        number = np.concatenate([f + np.arange(p) for f, p in zip(self.first, self.parts)])
        order = np.argsort(number, kind="stable")
        self.met_cell, self.met_chunk = cell[order].astype(np.int32), number[order].astype(np.int32)

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(squared_distances(x, self.at))

    def own(self, df: DataFrame) -> DataFrame:
        """Add ``_cell`` and ``_dp``, the distance to its pivot, and the chunks of the cell."""

        def run(batches):
            for part in _pieces(batches):
                d = self.distances(matrix(part.column("_v")))
                cell = d.argmin(1)
                more = [cell.astype(np.int64), d[np.arange(len(d)), cell], self.first[cell], self.parts[cell]]
                yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, more)], [*part.schema.names, "_cell", "_dp", "_first", "_parts"])

        return df.mapInArrow(run, _with(df, "_cell long, _dp double, _first int, _parts int"))

    def dealt(self, refs: DataFrame) -> DataFrame:
        """References with their ``_cell``, ``_dp`` and ``_chunk``."""
        chunk = (F.col("_first") + F.pmod(F.xxhash64("_rid"), F.col("_parts"))).cast("int")
        return self.own(refs).withColumn("_chunk", chunk).drop("_first", "_parts")

    def lower(self, d: np.ndarray) -> np.ndarray:
        """Least possible distances of rows (given theirs to the pivots) to the points of every cell."""
        own = d.argmin(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d**2 - d[np.arange(len(d)), own, None] ** 2) / (2 * self.between[own])
        plane = np.where(self.between[own] > 0, plane, 0.0)
        low = np.maximum(np.maximum(d - self.outer, self.inner - d), plane)
        return np.where(self.size > 0, low - SLACK * (1 + d + self.outer), np.inf)

    def within(self, df: DataFrame, radius: float | str, home: bool | None = None) -> DataFrame:
        """Add ``_reach``: the chunks, each with its cells, that may hold a point within ``radius``
        (a number or a column) of the row.  ``home``: only the row's own cell, or all but it."""

        def run(batches):
            for part in _pieces(batches):
                d = self.distances(matrix(part.column("_v")))
                most = part.column(radius).to_numpy(zero_copy_only=False)[:, None] if isinstance(radius, str) else radius
                rows, own = np.arange(len(d)), d.argmin(1)
                reach = np.zeros(d.shape, bool) if home else self.lower(d) <= most
                if home is not None:
                    reach[rows, own] = home
                row, col = np.nonzero(reach[:, self.met_cell])
                chunk = self.met_chunk[col]
                new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (chunk[1:] != chunk[:-1]))[: len(row)])
                cells = pa.ListArray.from_arrays(pa.array(np.append(new, len(row)), pa.int32()), pa.array(self.met_cell[col]))
                met = pa.StructArray.from_arrays([pa.array(chunk[new]), cells], ["chunk", "cells"])
                ends = pa.array(np.searchsorted(row[new], np.arange(len(d) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(ends, met)], [*part.schema.names, "_reach"])

        return df.mapInArrow(run, _with(df, "_reach array<struct<chunk: int, cells: array<int>>>"))


def _with(df: DataFrame, more: str):
    from pyspark.sql.types import StructType

    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


class Block:
    """A group of points ``a`` (vectors ``x``) and a chunk of references ``b`` (``y``), by cell and id."""

    def __init__(self, a: pa.Table, b: pa.Table):
        self.a, self.b = a, b.sort_by([("_cell", "ascending"), ("_rid", "ascending")])
        self.x, self.y = matrix(a["_v"]), matrix(self.b["_v"])
        self._bounds()

    def _bounds(self) -> None:
        self.cells, self.starts = np.unique(self.b["_cell"].to_numpy(), return_index=True)
        self.ends = np.append(self.starts[1:], len(self.y))

    def leave_copies(self, k: int) -> None:
        """Keep the first ``k`` references of every vector: the others are as far and have larger ids."""
        if not self.y.size:
            return
        bits = np.ascontiguousarray(self.y).view(np.dtype((np.void, self.y.itemsize * self.y.shape[1]))).ravel()
        same = np.unique(bits, return_inverse=True)[1]
        order = np.argsort(same, kind="stable")  # copies are of one cell, so by id
        rank = np.arange(len(same)) - np.searchsorted(same[order], same[order])
        kept = np.sort(order[rank < k])
        if len(kept) < len(same):
            self.b, self.y = self.b.take(kept), self.y[kept]
            self._bounds()

    def tiles(self) -> Iterator[Iterator[tuple[np.ndarray, slice, int]]]:
        """For every TILE points their tiles: points, references and the cell of these."""
        for at in range(0, len(self.x), TILE):
            yield self._of(at, self.a["_cells"].slice(at, TILE).combine_chunks())

    def _of(self, at: int, lists: pa.ListArray) -> Iterator[tuple[np.ndarray, slice, int]]:
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        cell = lists.flatten().to_numpy()
        for c, start, end in zip(self.cells, self.starts, self.ends):
            rows = at + row[cell == c]
            for s in range(start, end, TILE):
                if len(rows):
                    yield rows, slice(s, min(s + TILE, end)), c


def block_pass(points: DataFrame, refs: DataFrame, kernel: Callable[[Block], dict], schema: str, chunk_rows: int) -> DataFrame:
    """``kernel(Block)`` for every group of points and every chunk of references that it must meet.

    ``points`` has `_id`, `_v`, `_reach`; ``refs`` has `_rid`, `_v`, `_cell`, `_chunk` (and what the
    kernel reads)."""
    ship_package(points.sparkSession)
    points = cut_lineage(points)
    met = points.withColumn("_reach", F.explode("_reach")).withColumns({"_chunk": F.col("_reach.chunk"), "_cells": F.col("_reach.cells")}).drop("_reach")
    # one row per chunk: this side is sent around, never the one with the vectors
    groups = F.broadcast(cut_lineage(met.groupBy("_chunk").agg(F.ceil(F.count(F.lit(1)) / chunk_rows).cast("int").alias("_np"))))
    left = met.join(groups, "_chunk").withColumn("_p", F.pmod(F.xxhash64("_id"), F.col("_np")).cast("int")).drop("_np")
    right = refs.join(groups, "_chunk").withColumn("_p", F.explode(F.sequence(F.lit(0), F.col("_np") - 1))).drop("_np")
    right = right.toDF(*right.columns)  # columns of its own, also where both sides come from one table
    key = ["_chunk", "_p"]
    names = [c.split()[0] for c in schema.split(", ")]
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not (a.num_rows and b.num_rows):
            return kinds.empty_table()
        out = kernel(Block(a, b))
        return pa.Table.from_arrays([out[c] if isinstance(out[c], pa.ChunkedArray) else pa.array(out[c]) for c in names], names).cast(kinds)

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, schema)
