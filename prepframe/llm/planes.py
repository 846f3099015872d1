"""Operator 9: token ids as compressed bit or byte planes with a chunk index.

Ids of all documents, in ascending id order with an end id after each, are cut into blocks
of a fixed number of ids per shard (a shard is a range of document ids).  A block is
transposed into planes: four byte planes, or 32 bit planes; each plane is compressed with
zstandard on its own, so planes of high bits cost almost nothing.  The store is two tables:

* ``chunks``: one row per block: shard, chunk, n_ids, payload (planes one after another),
  plane_sizes, and the document segments inside the block;
* ``index``: one row per block: shard, chunk, id_start (ids of all blocks before it),
  n_ids, plane offsets inside the payload.

A reader takes the blocks it needs from the index; documents that cross a block border are
put together again from their segments.

Edge cases: a null or empty text is its end id alone; rows with equal ids keep the order of
their text hash; null ids come first; an empty table makes an empty store and result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prepframe.llm.common import map_batches, prepare
from prepframe.llm.tokens import encoder

BLOCK_IDS = 65_536
END_ID = 1
LEVEL = 3


def to_planes(ids: np.ndarray, bits: bool = False) -> tuple[bytes, list[int]]:
    """Compressed planes of a block of ids, joined, and their sizes."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=LEVEL)
    raw = np.ascontiguousarray(ids, "<u4")
    if bits:
        flat = np.unpackbits(raw.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")  # id x 32
        planes = [np.packbits(flat[:, k], bitorder="little").tobytes() for k in range(32)]
    else:
        planes = [np.ascontiguousarray(raw.view(np.uint8).reshape(-1, 4)[:, k]).tobytes() for k in range(4)]
    done = [pack.compress(p) for p in planes]
    return b"".join(done), [len(p) for p in done]


def from_planes(payload: bytes, sizes: list[int], n: int) -> np.ndarray:
    import zstandard

    unpack, at, planes = zstandard.ZstdDecompressor(), 0, []
    for s in sizes:
        planes.append(np.frombuffer(unpack.decompress(payload[at : at + s], max_output_size=max(n, 1)), np.uint8))
        at += s
    if len(sizes) == 32:
        flat = np.stack([np.unpackbits(p, count=n, bitorder="little") for p in planes], 1)
        return np.packbits(flat, axis=1, bitorder="little").copy().view("<u4").reshape(-1)
    return np.ascontiguousarray(np.stack(planes, 1)).view("<u4").reshape(-1)


SEGMENT = "struct<doc_id:bigint,doc:bigint,part:int,n:bigint>"
CHUNK = f"shard int, chunk int, n_ids long, plane_sizes array<int>, payload binary, segments array<{SEGMENT}>"


def write_store(
    docs: DataFrame, path: str, out: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS, bits: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encode ``docs`` and write the store to the shared folder ``out``."""
    spark = docs.sparkSession
    prepare(spark)
    end = np.array([end_id], "<u4").tobytes()
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = src.withColumn("_h", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "_h").sortWithinPartitions("doc_id", "_h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, chunk, doc = encoder(path), TaskContext.get().partitionId(), 0, -1
        held, segments, room = [], [], block_ids

        def block() -> pa.RecordBatch:
            payload, sizes = to_planes(np.frombuffer(b"".join(held), "<u4"), bits)
            n = sum(s["n"] for s in segments)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([chunk], pa.int32()), pa.array([n], pa.int64()), pa.array([sizes], pa.list_(pa.int32())),
                 pa.array([payload], pa.binary()),
                 pa.array([segments], pa.list_(pa.struct([("doc_id", pa.int64()), ("doc", pa.int64()), ("part", pa.int32()), ("n", pa.int64())])))],
                names=["shard", "chunk", "n_ids", "plane_sizes", "payload", "segments"],
            )

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids, doc, part, at = enc.encode(t) + end, doc + 1, 0, 0
                while at < len(ids):
                    piece = ids[at : at + 4 * room]
                    held.append(piece)
                    segments.append({"doc_id": i, "doc": doc, "part": part, "n": len(piece) // 4})
                    at, part, room = at + len(piece), part + 1, room - len(piece) // 4
                    if not room:
                        yield block()
                        chunk, held, segments, room = chunk + 1, [], [], block_ids
        if held:
            yield block()

    ordered.select("doc_id", "text").mapInArrow(run, CHUNK).write.parquet(f"{out}/chunks")
    chunks = spark.read.schema(CHUNK).parquet(f"{out}/chunks").select("shard", "chunk", "n_ids", "plane_sizes")
    # One row per shard: where its ids start.
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    base = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    index = chunks.join(shards.select("shard", base.alias("base")), "shard").withColumn("id_start", F.col("base") + inside)
    index = index.withColumn(
        "plane_offsets", F.transform("plane_sizes", lambda _x, i: F.aggregate(F.slice("plane_sizes", 1, i), F.lit(0), lambda a, s: a + s))
    )
    index.select("shard", "chunk", "id_start", "n_ids", "plane_offsets").write.parquet(f"{out}/index")


def read_documents(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document, from the store alone."""
    prepare(spark)
    chunks = spark.read.schema(CHUNK).parquet(f"{out}/chunks")
    index = spark.read.schema("shard int, chunk int, id_start long").parquet(f"{out}/index")

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for r in b.to_pylist():
            ids, at = from_planes(r["payload"], r["plane_sizes"], r["n_ids"]), 0
            for k, s in enumerate(r["segments"]):
                raw = ids[at : at + s["n"]].tobytes()
                # Only the first and the last segment of a block can go on in another one.
                inner = 0 < k < len(r["segments"]) - 1
                rows.append((s["doc_id"], r["shard"], s["doc"], s["part"], r["id_start"] + at, s["n"], zlib.crc32(raw) if inner else None, raw, inner))
                at += s["n"]
        c = list(zip(*rows))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
        names = ["doc_id", "shard", "doc", "part", "start", "n", "crc", "ids", "inner"]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(c, kinds)], names=names)

    schema = "doc_id long, shard int, doc long, part int, start long, n long, crc long, ids binary, inner boolean"
    parts = map_batches(chunks.join(index, ["shard", "chunk"]).drop("n"), run, schema)
    whole = parts.where("inner").select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"), "ids")
    # Documents at block borders: at most two segments per block take part.
    crossing = parts.where("NOT inner").groupBy("shard", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("segments"),
    )
    ids = F.aggregate("segments", F.lit(b""), lambda a, s: F.concat(a, s["ids"]))
    crossing = crossing.withColumn("ids", ids).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"), "ids")
    return whole.union(crossing)
