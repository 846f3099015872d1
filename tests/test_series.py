"""Series filters over many ranges against plain Python: null series, odd payloads, hot series."""

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from prepframe.operators import series as SE
from prepframe.operators.ordering import with_halo


def by_series(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r[1]):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.fixture(scope="module")
def rows():
    r = random.Random(9)
    got = []
    for t in range(900):  # a hot series, a null one, and many short ones
        g = None if t % 5 < 2 else "hot" if t % 5 < 4 else f"s{r.randrange(60)}"
        got.append((g, t, None if t % 17 == 0 else r.uniform(-5, 5)))
    r.shuffle(got)
    return got


@pytest.fixture(scope="module")
def frame(spark, rows):
    df = spark.createDataFrame(rows, "g string, t long, x double").repartition(4)
    # payload that pandas cannot hold and that has no order
    return df.withColumn("m", F.create_map(F.lit("k"), F.col("t"))).withColumn("d", F.expr("timestamp_ntz'9999-12-31 23:59:59'"))


@pytest.mark.parametrize("buckets", [1, 5, 40])
def test_fir_and_median(spark, rows, frame, buckets):
    taps = [0.5, -0.25, 1.0, 2.0]
    want_f, want_m = {}, {}
    for group in by_series(rows).values():
        xs = [x for _, _, x in group]
        for n, (_, t, _) in enumerate(group):
            want_f[t] = sum(h * (xs[n - i] or 0.0) for i, h in enumerate(taps) if n >= i)
            seen = [x for x in xs[max(0, n - 3) : n + 4] if x is not None]
            want_m[t] = statistics.median(seen) if seen else None
    fir = SE.fir_filter(frame, "g", "t", "x", taps, nbuckets=buckets).collect()
    assert len(fir) == len(rows)
    for r in fir:
        assert r["fir"] == pytest.approx(want_f[r["t"]], abs=1e-12) and r["m"] == {"k": r["t"]} and r["d"].year == 9999
    med = SE.median_filter(frame, "g", "t", "x", 3, nbuckets=buckets).collect()
    assert {r["t"]: r["median"] for r in med} == pytest.approx(want_m)


@pytest.mark.parametrize("buckets", [1, 7, 40])
def test_iir_over_ranges(spark, rows, frame, buckets):
    b, a = [0.3, 0.2, 0.1], [2.0, -0.9, 0.3, -0.05]
    want = {}
    for group in by_series(rows).values():
        y = []
        for n in range(len(group)):
            acc = sum(c * (group[n - i][2] or 0.0) for i, c in enumerate(b) if n >= i) - sum(c * y[n - j] for j, c in enumerate(a) if 0 < j <= n)
            y.append(acc / a[0])
        want |= {g[1]: v for g, v in zip(group, y)}
    got = SE.iir_filter(frame, "g", "t", "x", b, a, nbuckets=buckets).collect()
    assert len(got) == len(rows) and all(r["m"] == {"k": r["t"]} and r["d"] == dt.datetime(9999, 12, 31, 23, 59, 59) for r in got)
    assert {r["t"]: r["iir"] for r in got} == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("b,a", [([0.4], [1.0]), ([1.0], [1.0, -1.0]), ([0.2, 0.1], [1.0, -0.5, 0.2])])
def test_blocks_are_the_recursion(b, a):
    x = np.random.RandomState(0).normal(size=777)
    y = []
    for n in range(len(x)):
        y.append((sum(c * x[n - i] for i, c in enumerate(b) if n >= i) - sum(c * y[n - j] for j, c in enumerate(a) if 0 < j <= n)) / a[0])
    f = SE.Recursion(b, a)
    z, out = np.zeros(f.order), []
    for part in np.array_split(x, [1, 100, 163, 500]):
        before = z
        one, z = f.run(part, z)
        out.append(one)
        _, alone = f.run(part, np.zeros(f.order))
        assert np.allclose(f.after(before, len(part)) + alone, z)  # the affine map of the part
    assert np.allclose(np.concatenate(out), y)


def test_halo_holds_what_windows_need_and_little_more(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), "id", F.lit(1).alias("x"))
    near = with_halo(df, ["id"], ["g"], 4, 2, "b", "o", nbuckets=10)
    assert near.where("o").count() == 20_000 and near.count() < 1.35 * 20_000
    w = Window.partitionBy("b", "g").orderBy("id").rowsBetween(-4, 2)
    got = near.select("g", "id", "o", F.collect_list("id").over(w).alias("l")).where("o").collect()
    assert all(r["l"] == [i for i in range(r["id"] - 12, r["id"] + 7, 3) if 0 <= i < 20_000] for r in got)
    assert with_halo(df.limit(0), ["id"], ["g"], 4, 2, "b", "o").collect() == []


def test_long_filters_still_get_their_rows(spark):
    df = spark.range(3000).select(F.lit("a").alias("g"), "id", F.lit(1.0).alias("x"))
    got = {r["id"]: r["fir"] for r in SE.fir_filter(df, "g", "id", "x", [1.0] * 700, nbuckets=30).collect()}
    assert all(got[i] == min(i + 1, 700) for i in range(3000))
