"""Operator 11: WARC archives as a chunked record table.

``write_archives`` writes real WARC/1.1 text through Spark's own text sink: one archive per
task, every segment of a record is one row of the sink.  A payload over ``chunk_bytes``
becomes several segments, each a WARC record of its own (``response``, then
``continuation``) that names its record and its number, so no row, Arrow cell or buffer
after the input cell is ever larger than one chunk.

``read_chunks`` reads archives with Spark's text source, split at the line that begins a
record, and gives the chunked record table: one row per (record, chunk number) with the
chunk's bytes.  ``read_records`` sorts those rows by record and chunk and carries one
running digest per record from row to row: a payload is never put together.  Payloads that
fit one chunk are digested where they are read and only their description is shuffled.

The start of a record can never appear inside a payload: the writer ends a segment inside
any ``WARC/1.1`` line that a payload holds, and WARC allows a segment to end anywhere.

Of the records with equal payloads of at least ``min_bytes`` those with the smallest id are
responses, the others are revisits without a payload.  Who comes first is decided on
(digest, id) alone; only rows whose digest occurs more than once are shuffled with their
payload, and a digest held by a third of all rows is split by Spark's skewed join.

Edge cases: a null payload is empty; null ids are never the smallest (all of them
responses where every id is null); rows that repeat the smallest id with the same payload
are all responses; null or odd urls are kept as given, other columns are ignored; an empty
table makes empty archives and an empty result.  A damaged archive (a length, number or
digest that does not fit) raises an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepframe.llm.common import bitmap_flag, cut_lineage, map_batches, prepare

CHUNK_BYTES = 1 << 18
MIN_BYTES = 100
# Bytes of rows that a task gathers before it hands them to Spark.
BATCH_BYTES = 1 << 22

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def pieces(payload: memoryview, chunk_bytes: int) -> Iterator[memoryview]:
    """The payload's chunks: whole characters, and no chunk holds the first line of a record."""
    raw, at, n = payload.obj, 0, len(payload)
    start = raw.find(VERSION)
    while True:
        end = min(n, at + chunk_bytes)
        while start >= 0 and start + 5 <= at:
            start = raw.find(VERSION, start + 1)
        if 0 <= start < end:
            end = start + 5
        elif end < n:
            while end > at + 1 and raw[end] & 0xC0 == 0x80:
                end -= 1
        yield payload[at:end]
        at = end
        if at >= n:
            return


def _segment(fields: list[tuple[str, object]], head: bytes, body: memoryview) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(head) + len(body))])
    # The sink's line end is the last byte of the record's end.
    return b"".join([VERSION, lines.encode(), b"\r\n", head, body, END[:-1]])


def _records(row: dict, date: str, copy: str, chunk_bytes: int) -> Iterator[bytes]:
    known = "" if row["id"] is None else str(row["id"])
    record = f"<urn:record:{known}:{row['digest']}>"
    common = [
        ("WARC-Date", date), ("WARC-Payload-Digest", f"sha256:{row['digest']}"), ("Page-ID", known),
        ("Payload-Length", row["n"]), ("Archive-Row", copy),
    ]
    uri = [] if row["url"] is None else [("WARC-Target-URI", quote(row["url"], safe="/:?#[]@!$&'()*+,;=-._~"))]
    if row["first"] is not None:
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", record), *uri, *common, ("WARC-Profile", PROFILE)]
        fields += [("WARC-Refers-To", f"<urn:record:{row['first']}:{row['digest']}>"), ("Refers-To-Page", row["first"])]
        yield _segment([*fields, ("Content-Type", "application/http;msgtype=response")], HTTP, memoryview(b""))
        return
    parts = pieces(memoryview((row["payload"] or "").encode()), chunk_bytes)
    part, k = next(parts), 0
    while part is not None:
        after, k = next(parts, None), k + 1
        kind = [("WARC-Type", "response" if k == 1 else "continuation"), ("WARC-Record-ID", record if k == 1 else f"{record[:-1]}:{k}>")]
        own = [] if k == 1 and after is None else [("WARC-Segment-Number", k)]
        if k > 1:
            own.append(("WARC-Segment-Origin-ID", record))
            if after is None:
                own.append(("WARC-Segment-Total-Length", len(HTTP) + row["n"]))
        else:
            own += [*uri, ("Content-Type", "application/http;msgtype=response")]
        yield _segment([*kind, *common, *own], HTTP if k == 1 else b"", part)
        part = after


def write_archives(
    pages: DataFrame, out: str, chunk_bytes: int = CHUNK_BYTES, min_bytes: int = MIN_BYTES, compression: str | None = "gzip",
    id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: datetime | None = None,
) -> None:
    """Write ``pages`` as WARC archives to the shared folder ``out`` (ids must be whole numbers)."""
    if chunk_bytes < 16:
        raise ValueError("a chunk holds at least 16 bytes")
    prepare(pages.sparkSession)
    when = (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    src = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
    )
    src = src.withColumns({"digest": F.sha2("payload", 256), "n": F.octet_length("payload").cast("long")})
    # Narrow: payloads that occur more than once, and the smallest id that has them.
    groups = src.where(F.col("n") >= min_bytes).groupBy("digest").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("c"))
    firsts = cut_lineage(groups.where("c > 1 AND low IS NOT NULL").select("digest", "low"))
    marked = bitmap_flag(src, "digest", firsts.select("digest"))
    plain = marked.where("NOT _maybe").drop("_maybe").withColumn("first", F.lit(None).cast("long"))
    shared = marked.where("_maybe").drop("_maybe").join(firsts, "digest", "left")
    again = F.col("low").isNotNull() & (F.col("n") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("low"))
    shared = shared.withColumn("first", F.when(again, F.col("low"))).withColumn("payload", F.when(~again, F.col("payload")))
    cols = ["id", "url", "digest", "n", "first", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, row = [], 0, 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x.decode() for x in held], pa.string())], names=["value"])

        for b in batches:
            for k in range(b.num_rows):
                row += 1
                one = {c: b.column(j)[k].as_py() for j, c in enumerate(cols)}
                for segment in _records(one, when, f"{TaskContext.get().partitionId()}.{row}", chunk_bytes):
                    held.append(segment)
                    size += len(segment)
                    if size >= BATCH_BYTES:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    lines = plain.select(*cols).union(shared.select(*cols)).mapInArrow(run, "value string")
    sink = lines.write.option("lineSep", "\n")
    (sink.option("compression", compression) if compression else sink).text(out)


CHUNK = (
    "record_id string, copy string, chunk int, last boolean, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, chunk_bytes long, digested string, payload binary"
)


def _parse(value: bytes, payloads: bool) -> tuple | None:
    """One row of the chunk table from one segment; None for kinds other than page records."""
    raw = value[len(VERSION) :] if value.startswith(VERSION) else value
    head, _, block = raw.partition(END)
    f = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        k, _, v = line.partition(":")
        f[k.strip().lower()] = v.strip()
    kind = f.get("warc-type")
    if kind not in ("response", "revisit", "continuation") or "page-id" not in f:
        return None
    n = int(f["content-length"])
    if len(block) < n or block[n:] not in (END[:-1], END):
        raise ValueError(f"damaged record {f.get('warc-record-id')}: {len(block)} bytes where {n} are announced")
    body = block[:n] if kind == "continuation" else block[:n].partition(END)[2]
    number = int(f.get("warc-segment-number", 1))
    last = "warc-segment-number" not in f or "warc-segment-total-length" in f
    alone = last and number == 1
    known, digest = f["page-id"], f["warc-payload-digest"].removeprefix("sha256:")
    url = unquote(f["warc-target-uri"]) if "warc-target-uri" in f else None
    own = hashlib.sha256(body).hexdigest() if alone and kind == "response" else None
    refers = int(f["refers-to-page"]) if kind == "revisit" else None
    return (
        f["warc-segment-origin-id"] if kind == "continuation" else f["warc-record-id"], f.get("archive-row", ""), number, last,
        int(known) if known else None, url, "revisit" if kind == "revisit" else "response", refers,
        int(f["payload-length"]), digest, len(body), own, body if payloads or not alone else None,
    )


def read_chunks(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The chunked record table of the archives under ``path``: a row per (record, copy, chunk).

    Without ``payloads`` the bytes of payloads that fit one chunk stay behind (their digest,
    ``digested``, is taken while they are read)."""
    prepare(spark)
    kinds = [pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.int64(),
             pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in CHUNK.split(", ")]

    def run(b: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = [r for v in b.column(0).to_pylist() if v and (r := _parse(v, payloads))]
        if not rows:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    lines = spark.read.option("lineSep", "\n" + VERSION.decode()).text(path)
    return map_batches(lines.select(F.col("value").cast("binary").alias("value")), run, CHUNK)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every record.

    Lengths and digests of responses come from the bytes read and are held against the
    headers; those of revisits come from their headers."""
    out = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = [c.split()[0] for c in out.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The running digest of the open record: carried over rows and batches.
        open_, digest, size, url = None, None, 0, None
        for b in batches:
            done = []
            for r in b.to_pylist():
                if r["chunk"] == 1:
                    if open_ is not None:
                        raise ValueError(f"record {open_[0]} has no end")
                    open_, digest, size, url = (r["record_id"], r["copy"], 0), hashlib.sha256(), 0, r["url"]
                if open_ is None or open_ != (r["record_id"], r["copy"], r["chunk"] - 1):
                    raise ValueError(f"record {r['record_id']} lacks a chunk before {r['chunk']}")
                open_ = (r["record_id"], r["copy"], r["chunk"])
                size += r["chunk_bytes"]
                if r["digested"] is None and r["payload"] is not None:
                    digest.update(r["payload"])
                if not r["last"]:
                    continue
                open_ = None
                if r["record_type"] == "response":
                    found = r["digested"] or digest.hexdigest()
                    if (size, found) != (r["payload_bytes"], r["payload_digest"]):
                        raise ValueError(f"record {r['record_id']}: payload differs from its digest")
                done.append((r["page_id"], url, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
        if open_ is not None:
            raise ValueError(f"record {open_[0]} has no end")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = read_chunks(spark, path, payloads=False).repartition(parts, "record_id", "copy")
    return chunks.sortWithinPartitions("record_id", "copy", "chunk").mapInArrow(run, out)
