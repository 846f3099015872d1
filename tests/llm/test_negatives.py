import math
import random

import numpy as np
import pytest

from prepframe.llm import negatives as N
from prepframe.llm.common import scratch_path
from pyspark.sql import functions as F


def brute(rows, anchor, positives=5, negatives=10):
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        key = (label, v)
        if i not in kept or key < kept[i]:
            kept[i] = key
    q = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in kept.items()}
    out = []
    for a, (la, va) in q.items():
        if not anchor(a):
            continue
        score = {i: sum(x * y for x, y in zip(va, v)) for i, (_, v) in q.items() if len(v) == len(va)}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if i != a and q[i][0] == la][:positives]:
            hit = [i for i in order if q[i][0] != la and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(hit[:negatives])]
    return sorted(out)


def vectors(seed, d, n, spread):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(d)] for _ in range(4)]
    rows = [(i, r.choice([0, 0, 0, 1, 2, 9]), [c + r.gauss(0, spread) for c in r.choice(centres)]) for i in range(n)]
    rows += [(n + i, 1 + i % 2, [1.0] * d) for i in range(60)]  # one common vector
    rows += [(0, 0, rows[0][2]), (0, 0, rows[0][2]), (None, 1, [0.0] * d), (5000, None, [0.0] * d), (5001, 1, None), (5002, 1, []), (5003, 2, [])]
    rows += [(5010, 1, [float("nan")] * d), (5020, 1, [None] * d), (5030, 1, [float("inf")] * d), (5040, 1, [1.0] * (d + 1)), (5050, 2, [0.5] * (d + 1))]
    rows += [(5060, 1, [0.0] * d), (-10, 2, [1.0] * d)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("d,spread,block", [(1, 0.5, 1 << 19), (5, 0.3, 40), (64, 0.05, 1 << 19), (64, 1.0, 640)])
def test_against_brute_force(spark, d, spread, block):
    rows = vectors(d, d, 300, spread)
    df = spark.createDataFrame([(*x, "s", 1) for x in rows], "vec_id long, label int, embedding array<double>, means string, slot int").repartition(4)
    out = scratch_path(spark, "segments")
    N.build_store(df, out)
    got = N.mine(spark, out, F.col("vec_id") % 10 == 0, block_values=block).collect()
    assert sorted(tuple(g) for g in got) == brute(rows, lambda i: math.fmod(i, 10) == 0)


def test_bounds_hold_and_tighten():
    r = np.random.RandomState(2)
    for d in (1, 3, 8, 13, 64):
        q = r.randint(-400, 400, (40, d)) + r.randint(-300, 300, (40, 1))
        lengths, m, v = N.summaries(q)
        score, widths = q @ q.T, []
        for parts in (1, 2, 4, 8):
            u, dev = N.joined(lengths, m, v, parts)
            mid, room = u @ u.T, dev @ dev.T
            assert (score <= mid + room + 1e-6 * (1 + np.abs(mid) + room)).all() and (score >= mid - room - 1e-6 * (1 + np.abs(mid) + room)).all()
            widths.append(room.sum())
        assert all(a >= b - 1e-6 * a for a, b in zip(widths, widths[1:]))


def test_pairs_outside_the_bounds_are_not_scored():
    r = np.random.RandomState(3)
    base = np.repeat(np.array([[900], [-900]]), 64, 1)
    q = np.concatenate([base[[k % 2]] + r.randint(-30, 30, (1, 64)) for k in range(200)])
    side = N.Side(np.arange(200), np.zeros(200, int), q, *N.summaries(q))
    scored = []
    real = N.exact_pairs

    def counted(a, b, i, j):
        scored.append(len(i))
        return real(a, b, i, j)

    N.exact_pairs = counted
    try:
        low = np.full(200, np.sort(q @ q.T, axis=1)[:, -4].min())
        i, j, score = N.candidates(side, side, low, np.full(200, 2**62), np.ones((200, 200), bool))
    finally:
        N.exact_pairs = real
    want = np.argwhere(q @ q.T >= low[:, None])
    assert sorted(zip(i, j)) == sorted(map(tuple, want))
    assert sum(scored) < 0.25 * 200 * 200


def test_large_components_and_empty(spark):
    big = [(0, 1, [2.0**40, 1.0]), (10, 1, [2.0**40, 3.0])]
    out = scratch_path(spark, "segments")
    df = spark.createDataFrame(big, "vec_id long, label int, embedding array<double>")
    N.build_store(df, out)
    with pytest.raises(Exception, match="long"):
        N.mine(spark, out, F.col("vec_id") % 10 == 0).collect()
    none = scratch_path(spark, "segments")
    N.build_store(df.limit(0), none)
    assert N.mine(spark, none, F.col("vec_id") % 10 == 0).collect() == []
