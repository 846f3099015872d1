"""Operator 5: BPE encoding by tree concatenation, and decoding.

A text longer than ``piece_chars`` is cut into pieces without regard to its content; the
pieces are encoded in parallel tasks and joined pairwise, level by level.  A join re-encodes
a window of the last tokens of the left and the first tokens of the right part, doubling
the window until its encoding agrees with both sides on a run of whole tokens (or covers
both parts whole); the ids are spliced inside the two runs.  A sequence in which every
adjacent pair of tokens occurs in a valid encoding is itself the encoding, so the splice
equals the encoding of the whole.

Edge cases: a null text counts as empty and has no ids; texts of any length, also without
any white space, are treated alike; special-token strings inside texts are encoded as the
library does; repeated rows give one result row each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepframe.llm.common import cut_lineage, map_batches, prepare
from prepframe.llm.tokens import byte_table, encoder

PIECE_CHARS = 32_768
RUN = 3  # tokens that must agree on each side of a join
WINDOW = 32  # tokens of each side in the first window


def _lengths(path: str) -> np.ndarray:
    got = _lengths.__dict__.get(path)
    if got is None:
        got = _lengths.__dict__[path] = np.array([len(b) for b in byte_table(path)], np.int64)
    return got


def _agree(x: np.ndarray, ex: np.ndarray, y: np.ndarray, ey: np.ndarray) -> tuple[int, int] | None:
    """First (i, j) such that x[i:i+RUN] and y[j:j+RUN] are equal and end at the same bytes."""
    common, i, j = np.intersect1d(ex, ey, return_indices=True)
    ok = np.array([x[a] == y[b] for a, b in zip(i, j)], bool)
    for k in range(len(common) - RUN + 1):
        if ok[k : k + RUN].all() and i[k + RUN - 1] - i[k] == RUN - 1 and j[k + RUN - 1] - j[k] == RUN - 1:
            return int(i[k]), int(j[k])
    return None


def join_parts(path: str, left: tuple[bytes, bytes], right: tuple[bytes, bytes]) -> tuple[bytes, bytes]:
    """(text bytes, ids) of the concatenation of two encoded parts."""
    (tl, il), (tr, ir) = left, right
    text = tl + tr
    a, b = np.frombuffer(il, "<u4"), np.frombuffer(ir, "<u4")
    size = _lengths(path)
    ea, eb = np.cumsum(size[a]), np.cumsum(size[b])
    enc = encoder(path)
    w = WINDOW
    while True:
        lo = max(0, len(a) - w)
        start = int(ea[lo - 1]) if lo else 0
        while start and tl[start] & 0xC0 == 0x80:  # inside a character: go back to its first byte
            start -= 1
        hi = min(len(b), w)
        end = int(eb[hi - 1]) if hi else 0
        while end < len(tr) and tr[end] & 0xC0 == 0x80:
            end += 1
        whole_left, whole_right = lo == 0, hi == len(b)
        ids = np.frombuffer(enc.encode(text[start : len(tl) + end].decode("utf-8")), "<u4")
        e = start + np.cumsum(size[ids])
        i = j = 0
        if not whole_left:
            # Only tokens that end before the join can be the left part's own; the first one may be cut.
            inner = (e <= len(tl)) & (np.arange(len(e)) > 0)
            got = _agree(a[lo:], ea[lo:], ids[inner], e[inner])
            if got is None:
                w *= 2
                continue
            i, j = lo + got[0], got[1] + 1
        else:
            i = 0
        if whole_right:
            tail = np.zeros(0, "<u4")
            k = len(ids)
        else:
            begin = np.flatnonzero(e - size[ids] >= len(tl))[:-1]  # whole tokens of the right part, but the last
            got = _agree(ids[begin], e[begin], b[:hi], len(tl) + eb[:hi]) if len(begin) else None
            if got is None:
                w *= 2
                continue
            k = int(begin[got[0]]) + RUN
            tail = b[got[1] + RUN :]
        return text, np.concatenate([a[:i], ids[j:k], tail]).astype("<u4").tobytes()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """(doc_id, ids) of every row; ids are little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(docs.dtypes)["doc_id"]

    def short(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(path)
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([enc.encode(t) for t in b.column(1).to_pylist()], pa.binary())], names=["doc_id", "ids"]
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40  # names the row, also among repeated ones
        for b in batches:
            for i, t in zip(b.column(0), b.column(1).to_pylist()):
                row += 1
                parts = [t[k : k + piece_chars] for k in range(0, len(t), piece_chars)]
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i.as_py()] * n, b.column(0).type), pa.array([row] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(parts)],
                    names=["doc_id", "row", "part", "text"],
                )

    def leaf(b: pa.RecordBatch) -> pa.RecordBatch:
        enc, texts = encoder(path), b.column(3).to_pylist()
        return pa.RecordBatch.from_arrays(
            [*b.columns[:3], pa.array([t.encode() for t in texts], pa.binary()), pa.array([enc.encode(t) for t in texts], pa.binary())],
            names=["doc_id", "row", "part", "text", "ids"],
        )

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        text, ids = rows[0]["text"], rows[0]["ids"]
        if len(rows) == 2:
            text, ids = join_parts(path, (text, ids), (rows[1]["text"], rows[1]["ids"]))
        return pa.table(
            {"doc_id": pa.array([rows[0]["doc_id"]], table.schema.field("doc_id").type), "row": pa.array([rows[0]["row"]], pa.int64()),
             "part": pa.array([rows[0]["part"] // 2], pa.int64()), "text": pa.array([text], pa.binary()), "ids": pa.array([ids], pa.binary())}
        )

    is_long = F.length("text") > piece_chars
    done = map_batches(docs.where(~is_long), short, f"doc_id {kind}, ids binary")
    nodes = f"doc_id {kind}, row long, part long, text binary, ids binary"
    # The pieces are written first: their row names stay as they are if a task is repeated.
    pieces = cut_lineage(docs.where(is_long).mapInArrow(cut, f"doc_id {kind}, row long, part long, text string"))
    most = pieces.agg(F.max("part")).collect()[0][0]  # one row
    if most is None:
        return done
    level = map_batches(pieces.repartition(F.col("row"), F.col("part")), leaf, nodes)
    parts = most + 1
    while parts > 1:
        level = level.withColumn("_pair", F.col("part").bitwiseAND(F.lit(-2)))
        level = level.groupBy("row", "_pair").applyInArrow(lambda t: merge(t.drop(["_pair"])), nodes)
        parts = (parts + 1) // 2
    return done.union(level.select("doc_id", "ids"))


def decode_ids(path: str, ids: bytes) -> str:
    table = byte_table(path)
    return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): the ids and the text they stand for, special tokens included."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [decode_ids(path, x) for x in b.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts)], names=["doc_id", "ids", "text"])

    return map_batches(encoded.select("doc_id", "ids"), fn, f"doc_id {dict(encoded.dtypes)['doc_id']}, ids binary, text string")
