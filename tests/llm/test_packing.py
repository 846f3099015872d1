import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from prepframe.llm.packing import SumIndex, cut_points, pack, plan
from prepframe.llm.tokens import tokenizer_path


def test_cut_points():
    assert cut_points(1, 4) == [(0, 1)] and cut_points(4, 4) == [(0, 4)]
    assert cut_points(9, 4) == [(0, 1), (1, 4), (5, 4)] and cut_points(8, 4) == [(0, 4), (4, 4)]


def test_plan_uses_every_piece_once_and_is_tight():
    r = random.Random(3)
    for cap, n in ((10, 50), (64, 2000), (2048, 5000), (2048, 40)):
        counts = Counter(min(cap, 1 + int(r.expovariate(3 / cap))) for _ in range(n))
        got, total = Counter(), 0
        for times, parts in plan(dict(counts), cap):
            assert times > 0 and sum(n * k for n, k in parts) <= cap
            total += times
            for n_, k in parts:
                got[n_] += times * k
        assert got == counts
        least = -(-sum(k * v for k, v in counts.items()) // cap)
        assert total <= least * 1.03 + 1


def test_index_lists_every_combination_once():
    r = random.Random(5)
    for cap in (1, 2, 12, 40):
        have = {n: 9 for n in range(1, cap + 1) if r.random() < 0.6}
        index = SumIndex(have, cap)
        for total in range(cap):
            want = [(a,) for a in have if a == total]
            want += [(a, b) for a in have for b in have if a >= b and a + b == total]
            want += [(a, b, total - a - b) for a in have for b in have if a >= b >= total - a - b and total - a - b in have]
            got = list(index.combinations(total))
            assert sorted(got) == sorted(want) and len(set(got)) == len(got)
    index = SumIndex({3: 1, 2: 1, 1: 4}, 9)
    assert list(index.combinations(6)) == [(3, 3), (3, 2, 1), (2, 2, 2)] and index.times((3, 3)) == 0
    assert index.times((2, 2, 2)) == 0 and index.times((1, 1)) == 2


def test_exact_fills_come_first():
    for counts in ({6: 3, 4: 3}, {5: 2, 3: 4, 2: 2, 4: 1}, {4: 3, 3: 6}, {7: 1, 1: 3}):
        got = plan(counts, 10)
        full = sum(t for t, parts in got if sum(n * k for n, k in parts) == 10)
        assert full >= sum(n * c for n, c in counts.items()) // 10 - 1


def test_plan_of_every_length_is_quick():
    import time

    r = random.Random(6)
    start = time.perf_counter()
    for counts in ({n: 1 + r.randrange(9) for n in range(1, 2049)}, {n: 10**9 for n in range(1, 2049)}, {n: 2 for n in range(600, 2049)}):
        got = plan(counts, 2048)
        assert sum(t * n * k for t, parts in got for n, k in parts) == sum(n * c for n, c in counts.items())
    assert time.perf_counter() - start < 30


def test_pack_places(spark):
    path, r = tokenizer_path("byte_bpe_50k.json"), random.Random(4)
    t = Tokenizer.from_file(path)
    rows = [(i, " ".join(r.choice("the of thing worth an 12 é".split()) for _ in range(r.choice([1, 3, 9, 40, 90])))) for i in range(300)]
    rows += [(i, "the same text") for i in range(300, 500)] + [(600, None), (601, ""), (602, "x " * 200), (602, "x " * 200)]
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], "doc_id long, text string, length int").repartition(5)
    got = pack(df, path, capacity=64, bucket_rows=60).collect()
    seqs = defaultdict(list)
    for g in got:
        seqs[g["sequence_id"]].append((g["offset"], g["length"]))
    for s in seqs.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and s[-1][0] + s[-1][1] <= 64
    want = Counter()
    for i, x in rows:
        e = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        for k, (a, n) in enumerate(cut_points(len(e), 64)):
            want[i, k, a, n, zlib.crc32(np.array(e[a : a + n], "<u4").tobytes())] += 1
    assert Counter((g["doc_id"], g["piece"], g["start"], g["length"], g["ids_crc32"]) for g in got) == want
    assert len(seqs) <= -(-sum(g["length"] for g in got) // 64) * 1.05 + 1
    assert pack(df.limit(0), path).collect() == []
