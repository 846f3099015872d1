import hashlib
import random

import pytest

from prepframe.llm import warc as W
from prepframe.llm.common import scratch_path


def expected(rows):
    low = {}
    for i, _u, h in rows:
        p = (h or "").encode()
        if len(p) >= 100 and i is not None:
            low[p] = min(low.get(p, i), i)
    out = []
    for i, u, h in rows:
        p = (h or "").encode()
        first = low.get(p) if len(p) >= 100 else None
        again = first is not None and i != first
        out.append((i, u, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def rows_for_test():
    r = random.Random(3)
    odd = ["", "a", "é" * 300, "x" * 99, "y" * 100, "WARC/1.1\r\n" * 30, "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 20,
           "tail\r\n\r\n\r\n" * 40, "\n" * 500, "𝄞é\r" * 200, "z" * 5000, None, "W" * 200 + "WARC/1.1\r", "\x00\x01" * 80]
    rows = [(i, f"http://h/{i}?q=ä b", h) for i, h in enumerate(odd)]
    rows += [(100 + i, None if i % 5 == 0 else "u\r\nX: y", r.choice(odd)) for i in range(120)]
    rows += [(-5, "again", "y" * 100), (-5, "again", "y" * 100), (None, "none", "y" * 100), (None, None, "only nulls " * 20), (None, None, "only nulls " * 20)]
    rows += [(1000 + i, "hot", "copy " * 60) for i in range(300)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk,compression", [(16, None), (64, "gzip"), (1 << 18, None)])
def test_round_trip(spark, chunk, compression):
    rows = rows_for_test()
    df = spark.createDataFrame([(*x, "c", 1) for x in rows], "page_id long, url string, html string, chunk string, digest int").repartition(5)
    out = scratch_path(spark, "warc")
    W.write_archives(df, out, chunk_bytes=chunk, compression=compression)
    got = W.read_records(spark, out).collect()
    assert sorted((tuple(g) for g in got), key=repr) == expected(rows)
    chunks = W.read_chunks(spark, out).collect()
    whole = {}
    for c in sorted(chunks, key=lambda c: (c["copy"], c["chunk"])):
        assert len(c["payload"]) <= chunk
        if c["record_type"] == "response":
            whole.setdefault((c["page_id"], c["copy"]), []).append(c["payload"])
    # Every payload comes back byte for byte.
    assert sorted(b"".join(v) for v in whole.values()) == sorted((h or "").encode() for i, _, h in rows if not again(rows, i, h))


def again(rows, i, h):
    return any(e[0] == i and e[4] == "revisit" and e[3] == hashlib.sha256((h or "").encode()).hexdigest() for e in expected(rows))


def test_archive_is_plain_warc(spark):
    out = scratch_path(spark, "warc")
    df = spark.createDataFrame([(1, "http://a/", "<p>one</p>" * 30), (2, "http://b/", "<p>one</p>" * 30)], "page_id long, url string, html string")
    W.write_archives(df.coalesce(1), out, chunk_bytes=128, compression=None)
    raw = b"\n".join(r[0] for r in spark.read.format("binaryFile").load(out + "/*.txt").select("content").collect())
    # An independent reader: only versions, header lines and lengths.
    kinds, at = [], 0
    while at < len(raw):
        assert raw.startswith(b"WARC/1.1\r\n", at)
        end = raw.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in raw[at:end].decode().split("\r\n")[1:])
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(head)
        kinds.append(head["WARC-Type"])
        at = end + 4 + int(head["Content-Length"])
        assert raw[at : at + 4] == b"\r\n\r\n"
        at += 4
    assert sorted(kinds) == ["continuation", "continuation", "response", "revisit"]


def test_damage_is_an_error_and_empty_is_empty(spark):
    df = spark.createDataFrame([(1, "u", "hello " * 50)], "page_id long, url string, html string")
    out = scratch_path(spark, "warc")
    W.write_archives(df, out, compression=None, chunk_bytes=64)
    lines = spark.read.option("lineSep", "\x00").text(out)
    bad = scratch_path(spark, "warc")
    lines.where("value != ''").selectExpr("replace(value, 'hello', 'hullo') AS value").coalesce(1).write.text(bad)
    with pytest.raises(Exception, match="digest|damaged"):
        W.read_records(spark, bad).collect()
    none = scratch_path(spark, "warc")
    W.write_archives(df.limit(0), none)
    assert W.read_records(spark, none).collect() == []
