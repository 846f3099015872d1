"""k-NN and DBSCAN against brute force on the two_blobs fixture."""

import numpy as np
import pytest

from prepframe.operators.density import dbscan
from prepframe.operators.neighbors import knn_classify


@pytest.fixture(scope="module")
def two_blobs():
    rng = np.random.default_rng(7)
    a = rng.normal(0, 0.2, size=(40, 2))
    b = rng.normal(4, 0.2, size=(40, 2))
    noise = np.array([[2.0, 2.0], [10.0, -10.0]])
    return np.vstack([a, b, noise])


def test_knn_matches_brute_force(spark, two_blobs):
    x = two_blobs
    lab = [0] * 40 + [1] * 40 + [1, 0]
    rows = [(i, float(p[0]), float(p[1]), lab[i]) for i, p in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    train, test = df.where("id % 4 != 0"), df.where("id % 4 = 0")
    got = {r["id"]: r["prediction"] for r in knn_classify(train, test, ["a", "b"], "y", k=3, chunk_rows=7).collect()}
    tr = [r for r in rows if r[0] % 4 != 0]
    for qid, qa, qb, _ in (r for r in rows if r[0] % 4 == 0):
        d = sorted(((qa - ta) ** 2 + (qb - tb) ** 2, tid, ty) for tid, ta, tb, ty in tr)[:3]
        votes = {}
        for _, _, ty in d:
            votes[ty] = votes.get(ty, 0) + 1
        want = min(votes, key=lambda v: (-votes[v], v))
        assert got[qid] == want


def test_dbscan_two_blobs(spark, two_blobs):
    rows = [(i, float(p[0]), float(p[1])) for i, p in enumerate(two_blobs)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    out = {r["id"]: r["cluster"] for r in dbscan(df, "id", ["a", "b"], eps=0.5, min_points=4, chunk_rows=25).collect()}
    assert len({out[i] for i in range(40)}) == 1 and len({out[i] for i in range(40, 80)}) == 1
    assert out[0] != out[40] and out[80] == -1 and out[81] == -1
    assert out[0] == min(i for i in range(40) if out[i] == out[0])


def test_far_from_the_origin_and_missing_features(spark):
    # offsets of 1e8 must not cancel; a chain of 300 points is one cluster; nothing is dropped
    rows = [(i, 1e8 + 0.9 * i, -1e8) for i in range(300)] + [(400 + i, 1e8 + 0.9 * i, -1e8 + 5.0) for i in range(5)] + [(900, None, 1.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    out = {r["id"]: (r["cluster"], r["is_core"]) for r in dbscan(df, "id", ["a", "b"], eps=1.0, min_points=2, chunk_rows=40).collect()}
    assert len(out) == 306 and {out[i][0] for i in range(300)} == {0} and {out[400 + i][0] for i in range(5)} == {400}
    assert out[900] == (None, False)
    train = spark.createDataFrame([(1, 1e8, 0.0, "x"), (6, 1e8 + 3, 0.0, "y")], "id long, a double, b double, y string")
    test = spark.createDataFrame([(10, 1e8 + 2.0, 0.0), (11, None, 0.0)], "id long, a double, b double")
    got = {r["id"]: r["prediction"] for r in knn_classify(train, test, ["a", "b"], "y", k=1).collect()}
    assert got == {10: "y", 11: None}


def test_pivots_leave_out_most_distances(spark):
    from prepframe.operators.neighbors import knn_neighbours, knn_work

    rng = np.random.default_rng(3)
    centres = rng.normal(0, 10, size=(12, 24))
    x = np.vstack([centres[i % 12] + rng.normal(0, 0.3, 24) for i in range(1200)] + [centres[0]] * 30)
    rows = [(i, [float(v) for v in p], i % 3) for i, p in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y int")
    train, test = df.where("id % 5 != 0"), df.where("id % 5 = 0")
    near = {}
    for r in knn_neighbours(train, test, "v", "y", 4, "id", "id", chunk_rows=50).collect():
        near.setdefault(r["id"], []).append((r["rank"], r["ref_id"]))
    refs = [r for r in rows if r[0] % 5]
    at = np.array([r[1] for r in refs])
    for i, v, _ in rows[::5]:
        d2 = ((at - np.array(v)) ** 2).sum(1)
        want = sorted(range(len(refs)), key=lambda j: (round(d2[j], 9), refs[j][0]))[:4]
        assert [j for _, j in sorted(near[i])] == [refs[j][0] for j in want]
    work = knn_work(train, test, "v", "y", 4, "id", "id", chunk_rows=50).collect()[0]
    assert work["distances"] < 0.25 * work["all_pairs"]
    # fewer rows than k, and none
    few = knn_classify(train.limit(2), test.limit(3), "v", "y", k=5, train_id="id").collect()
    assert len(few) == 3 and all(r["prediction"] is not None for r in few)
    none = knn_classify(train.limit(0), test.limit(3), "v", "y", k=5, train_id="id").collect()
    assert len(none) == 3 and all(r["prediction"] is None for r in none)


def test_dbscan_in_many_dimensions(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(c * 5, 0.4, size=(60, 16)) for c in range(3)] + [rng.uniform(-40, 40, size=(10, 16))])
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, v array<double>")
    got = {r["id"]: (r["cluster"], r["is_core"]) for r in dbscan(df, "id", "v", eps=2.2, min_points=5, chunk_rows=20).collect()}
    close = ((x[:, None] - x[None]) ** 2).sum(2) <= 2.2**2
    core = close.sum(1) >= 5
    lab = np.where(core, np.arange(len(x)), -1)
    while True:
        new = np.array([min([lab[j] for j in np.flatnonzero(close[i] & core)] + [lab[i]]) if core[i] else -1 for i in range(len(x))])
        if (new == lab).all():
            break
        lab = new
    for i in range(len(x)):
        edge = [lab[j] for j in np.flatnonzero(close[i] & core)]
        assert got[i] == (lab[i] if core[i] else min(edge, default=-1), bool(core[i]))
    assert dbscan(df.limit(0), "id", "v", eps=1.0).collect() == []


def test_close_decides_like_differences():
    from prepframe.operators import blocks as B

    rng = np.random.default_rng(5)
    x = 1e8 + rng.integers(0, 6, size=(200, 3)).astype(float)  # many distances are exactly the bound
    x[3, 1], x[9, 0] = np.inf, -np.inf
    with np.errstate(invalid="ignore"):
        assert (B.close(x, x[50:], 9.0) == (B.squared_distances(x, x[50:]) <= 9.0)).all()
    unit = rng.normal(size=(300, 64))
    unit /= np.sqrt((unit**2).sum(1))[:, None]
    d2 = B.squared_distances(unit, unit)
    assert (B.close(unit, unit, d2[4, 7]) == (d2 <= d2[4, 7])).all()


def test_rows_go_once_to_a_chunk_of_cells(spark):
    # without clusters a row must meet nearly all cells: a copy per cell was too much to send
    from pyspark.sql import functions as F

    from prepframe.operators import blocks as B

    x = np.random.default_rng(6).normal(size=(900, 48))
    x /= np.sqrt((x**2).sum(1))[:, None]
    points = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "_id long, _v array<double>").cache()
    pivots = B.Pivots(points, 300)
    met = pivots.within(points, 1.3)
    assert met.count() == 900
    chunks = met.select(F.explode("_reach").alias("r")).select("r.chunk", F.size("r.cells").alias("n")).agg(F.count("*"), F.sum("n")).collect()[0]
    assert chunks[0] <= 900 * 6 and chunks[1] > 900 * 20
    dealt = pivots.dealt(points.withColumnRenamed("_id", "_rid"))
    assert max(r["count"] for r in dealt.groupBy("_chunk").count().collect()) <= 300


def test_neighbours_without_clusters_equal_brute_force(spark):
    from prepframe.operators.neighbors import knn_neighbours

    x = np.random.default_rng(8).normal(size=(700, 32))
    x /= np.sqrt((x**2).sum(1))[:, None]
    x[100:140] = x[100]  # equal vectors: ties by id
    df = spark.createDataFrame([(i, [float(v) for v in p], i % 4) for i, p in enumerate(x)], "id long, v array<double>, y int")
    got = {}
    for r in knn_neighbours(df.where("id % 5 != 0"), df.where("id % 5 = 0"), "v", "y", 6, "id", "id", chunk_rows=150).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["ref_id"], r["y"]))
    refs = np.array([i for i in range(700) if i % 5])
    for i in range(0, 700, 5):
        d2 = np.zeros(len(refs))
        for k in range(32):
            d2 += (x[i, k] - x[refs, k]) ** 2
        first = refs[np.lexsort((refs, d2))[:6]]
        assert sorted(got[i]) == [(n + 1, j, j % 4) for n, j in enumerate(first)]


def test_many_copies_of_a_vector_are_few_candidates():
    # every pair of a tile was a candidate, held and sorted: here 83 MB
    import tracemalloc

    import pyarrow as pa

    from prepframe.operators import blocks as B
    from prepframe.operators.neighbors import _best

    rng = np.random.default_rng(9)
    y = np.tile(rng.normal(size=8), (3000, 1))
    y[::100] = rng.normal(size=(30, 8))
    x = np.vstack([y[1:1200], rng.normal(size=(10, 8))])
    rid = rng.permutation(3000)

    def rows(v, **more):
        return pa.table({"_v": pa.array(v.tolist(), pa.list_(pa.float64()))} | more)

    at = np.zeros((1, 8))
    a = rows(x, _id=pa.array(np.arange(len(x))), _radius=pa.array(np.full(len(x), np.inf)), _cells=pa.array([[0]] * len(x), pa.list_(pa.int32())))
    dp = np.sqrt(B.squared_distances(y, at)[:, 0])
    b = rows(y, _rid=pa.array(rid), _dp=pa.array(dp), _cell=pa.array(np.zeros(3000, np.int64)), _lab=pa.array(rid % 3))
    tracemalloc.start()
    out = _best(4, at)(B.Block(a, b))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = {}
    for i, r, lab in zip(out["_id"].to_pylist(), out["_rid"].to_pylist(), out["_lab"].to_pylist()):
        got.setdefault(i, []).append((r, lab))
    for i in range(0, len(x), 7):
        first = rid[np.lexsort((rid, B.squared_distances(x[i : i + 1], y)[0]))[:4]]
        assert sorted(got[i]) == sorted((r, r % 3) for r in first)
    assert sum(map(len, got.values())) == 4 * len(x) and most < 20e6, most
