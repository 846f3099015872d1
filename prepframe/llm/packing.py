"""Operator 3: best-fit packing with exact-complement hashing.

Documents become token pieces of at most ``capacity`` tokens.  The plan is made on the
histogram of piece lengths (at most ``capacity`` entries, whatever the input), never on
pieces: ``SumIndex`` keys the single, pair and triple sums of the lengths; for every length,
longest first, the combinations under its gap are taken from the index and used as often as
all their lengths are available.  What remains is packed by best fit, again many sequences
at a time.  Pieces are then ranked within their length, in as many buckets as its count asks
for, so that a length shared by a third of the rows is no single task, and take the plan's
places.

Edge cases: a null or empty text is one piece holding only the end id; pieces of full
length are sequences of their own; repeated rows are separate documents; ties in length
are ordered by id and text; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepframe.llm.common import cut_lineage, map_batches, prepare
from prepframe.llm.tokens import encoder

CAPACITY = 2048
END_ID = 0
BUCKET_ROWS = 50_000  # pieces of one length ranked by one task, about


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than the capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(k, capacity) for k in range(first, n, capacity)]


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row."""
    end = np.array([end_id], "<u4").tobytes()

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(path)
        at, rows, ids = [], [], []
        for i, t in enumerate(b.column(1).to_pylist()):
            e = enc.encode(t) + end
            for k, (start, n) in enumerate(cut_points(len(e) // 4, capacity)):
                part = e[4 * start : 4 * (start + n)]
                at.append(i)
                rows.append((k, start, n, zlib.crc32(part)))
                ids.append(part)
        cols = list(zip(*rows))
        arrays = [b.column(0).take(pa.array(at)), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            arrays, names = [*arrays, pa.array(ids, pa.binary())], [*names, "ids"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    src = docs.select("doc_id", "text")
    schema = f"doc_id {dict(src.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return map_batches(src, fn, schema)


class SumIndex:
    """Lengths of a histogram by the sum that one, two or three of them make.

    Pairs are listed under their sum (at most capacity² / 4 of them).  A triple is its
    longest length and a pair listed under the rest, so triples need no list of their own.
    ``available`` counts the pieces left of each length and only ever falls: an entry that
    is passed over because a length has run out never comes back.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.available = np.zeros(capacity + 1, np.int64)
        for n, c in counts.items():
            self.available[n] = c
        self.lengths = np.flatnonzero(self.available)[::-1]
        rows = [(n, self.lengths[k:][self.lengths[k:] < capacity - n]) for k, n in enumerate(self.lengths)]
        first = np.concatenate([np.full(len(m), n) for n, m in rows] or [np.zeros(0, np.int64)])
        second = np.concatenate([m for _, m in rows] or [np.zeros(0, np.int64)])
        order = np.lexsort((-first, first + second))
        self._first, self._second = first[order], second[order]
        self._at = np.searchsorted(self._first + self._second, np.arange(capacity + 2))

    def _pairs(self, total: int, longest: int) -> Iterator[tuple[int, int]]:
        """Pairs listed under ``total``, none of their lengths above ``longest``, longest first."""
        part = slice(self._at[total], self._at[total + 1])
        a, b = self._first[part], self._second[part]
        for k in np.flatnonzero((a <= longest) & (self.available[a] > 0) & (self.available[b] > 0)):
            yield int(a[k]), int(b[k])

    def combinations(self, total: int) -> Iterator[tuple[int, ...]]:
        """Singles, pairs, then triples of available lengths that make ``total``."""
        if total > 0 and self.available[total]:
            yield (total,)
        yield from self._pairs(total, total)
        for a in self.lengths[(self.lengths < total) & (3 * self.lengths >= total)]:
            if self.available[a]:
                yield from ((int(a), *rest) for rest in self._pairs(total - int(a), int(a)))

    def times(self, lengths: tuple[int, ...]) -> int:
        """How often all of ``lengths`` are available together."""
        return min(int(self.available[n]) // lengths.count(n) for n in set(lengths))

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for n in lengths:
            self.available[n] -= times


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (how often, [(length, copies), ...]) that use every piece of the histogram."""
    index = SumIndex({n: c for n, c in counts.items() if c > 0}, capacity)
    out: list[tuple[int, list[tuple[int, int]]]] = []

    def use(lengths: tuple[int, ...], times: int) -> None:
        index.take(lengths, times)
        out.append((times, sorted(((n, lengths.count(n)) for n in set(lengths)), reverse=True)))

    if index.available[capacity]:
        use((capacity,), int(index.available[capacity]))
    for big in map(int, index.lengths):
        for found in index.combinations(capacity - big) if index.available[big] else ():
            times = index.times((big, *found))
            if times:
                use((big, *found), times)
            if not index.available[big]:
                break
    # Best fit for the rest: the longest piece first, filled with the longest that still fits.
    order = [int(n) for n in index.lengths[::-1] if index.available[n]]
    while order:
        gap, lengths = capacity, []
        taken: dict[int, int] = {}
        pos = len(order)
        while pos > 0 and gap >= order[0]:
            pos = bisect_left(order, gap + 1, 0, pos)
            while pos > 0:
                n = order[pos - 1]
                can = min(gap // n, int(index.available[n]) - taken.get(n, 0))
                if can:
                    taken[n] = taken.get(n, 0) + can
                    lengths += [n] * can
                    gap -= n * can
                    break
                pos -= 1
        use(tuple(lengths), index.times(tuple(lengths)))
        order = [n for n in order if index.available[n]]
    return out


def places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, copies, offset) of every pattern's lengths."""
    used: dict[int, int] = {}
    out, base = [], 0
    for times, parts in patterns:
        offset = 0
        for n, copies in parts:
            r = used.get(n, 0)
            out.append((n, r, r + times * copies, base, copies, offset))
            used[n] = r + times * copies
            offset += n * copies
        base += times
    return out


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Pieces with (sequence_id, offset): every piece in one place, sequences gapless from 0."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = token_pieces(docs, path, capacity, end_id, with_ids)
    pieces = cut_lineage(pieces)
    histogram = {r["length"]: r["c"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("c")).collect()}  # at most `capacity` rows
    table = places(plan(histogram, capacity))
    crowded = {n: -(-c // bucket_rows) for n, c in histogram.items() if c > bucket_rows}
    buckets = F.lit(1)
    if crowded:
        buckets = F.coalesce(F.get(F.array(*(F.lit(crowded.get(n, 1)) for n in range(capacity + 1))), F.col("length").cast("int")), buckets)
    pieces = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), buckets))
    cells = pieces.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("c"))
    # Ranks within a length: within (length, bucket) plus the buckets before.
    before = cells.withColumn("_before", F.sum("c").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select(F.col("length").alias("_l"), F.col("_bucket").alias("_b"), F.coalesce("_before", F.lit(0)).alias("_before"))
    # About one row of three numbers for every `bucket_rows` pieces, and a plan bounded by the number of lengths.
    own = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = pieces.withColumn("_own", own).join(before, (F.col("length") == F.col("_l")) & (F.col("_bucket") == F.col("_b")))
    ranked = ranked.withColumn("_rank", F.col("_own") + F.col("_before")).drop("_l", "_b", "_own", "_before", "_bucket")
    starts: dict[int, list] = {}
    for n, lo, _hi, base, copies, offset in table:
        starts.setdefault(n, []).append((lo, base, copies, offset))
    slots = spark.sparkContext.broadcast({n: tuple(np.array(c, np.int64) for c in zip(*v)) for n, v in starts.items()})
    keep = [c for c in ranked.columns if c != "_rank"]

    def place(b: pa.RecordBatch) -> pa.RecordBatch:
        length, rank = (np.asarray(b.column(b.schema.get_field_index(c))) for c in ("length", "_rank"))
        seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length):
            at = np.flatnonzero(length == n)
            lo, base, copies, offset = slots.value[int(n)]
            k = np.searchsorted(lo, rank[at], side="right") - 1
            d = rank[at] - lo[k]
            seq[at], off[at] = base[k] + d // copies[k], offset[k] + (d % copies[k]) * n
        return pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(seq), pa.array(off)], names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {t}" for c, t in ranked.dtypes if c != "_rank") + ", sequence_id long, offset long"
    return map_batches(ranked, place, schema)
