import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from prepframe.llm import planes as P
from prepframe.llm.common import scratch_path
from prepframe.llm.tokens import tokenizer_path


def test_planes_round_trip():
    r = np.random.RandomState(1)
    for n in (1, 7, 8, 1000, 4097):
        for top in (2, 49408, 2**32):
            ids = r.randint(0, top, n, dtype=np.uint64).astype("<u4")
            for bits in (False, True):
                payload, sizes = P.to_planes(ids, bits)
                assert sum(sizes) == len(payload) and len(sizes) == (32 if bits else 4)
                assert (P.from_planes(payload, sizes, n) == ids).all()


def test_store_round_trip(spark):
    path, r = tokenizer_path("word_bpe_49k.json"), random.Random(4)
    t = Tokenizer.from_file(path)
    rows = [(i, " ".join(r.choice("the of Thing worth an 12 é".split()) for _ in range(r.choice([1, 3, 9, 40, 200])))) for i in range(-40, 200)]
    rows += [(700, None), (701, ""), (900, "x " * 900), (901, "y"), (901, "y")]
    r.shuffle(rows)
    want, start = [], 0
    for i, x in sorted(rows, key=lambda z: z[0]):
        e = [*t.encode(x or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(e), zlib.crc32(np.array(e, "<u4").tobytes())))
        start += len(e)
    df = spark.createDataFrame([(i, x, 9) for i, x in rows], "doc_id long, text string, shard int").repartition(3)
    for bits in (False, True):
        out = scratch_path(spark, "planes")
        P.write_store(df, path, out, block_ids=128, bits=bits)
        got = P.read_documents(spark, out).collect()
        assert sorted((g["doc_id"], g["start"], g["n_tokens"], g["ids_crc32"]) for g in got) == sorted(want)
        assert all(zlib.crc32(g["ids"]) == g["ids_crc32"] for g in got)
    out = scratch_path(spark, "planes")
    P.write_store(df.limit(0), path, out)
    assert P.read_documents(spark, out).collect() == []
