"""Model plumbing and independent checks (closed forms, invariants, brute force)."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from prepframe.operators import features as FE
from prepframe.operators import models as MO

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(0, 0.3, size=(60, 2))
    b = rng.normal(5, 0.3, size=(60, 2))
    rows = [(i, float(x), float(y), "yes" if i >= 60 else "no") for i, (x, y) in enumerate(np.vstack([a, b]))]
    return spark.createDataFrame(rows, "id long, x double, y double, label string")


def test_binary_string_labels_decode_and_probabilities(blobs):
    m = MO.fit(blobs, ["x", "y"], "label", MO.make_estimator("binary", "random_forest", treeNum=5, maxDepth=3), "binary")
    s = MO.score(m, blobs.drop("label"))  # scoring never needs the label column
    rows = s.select("id", "prediction", "p_yes", "p_no").collect()
    assert {r["prediction"] for r in rows} <= {"yes", "no"}
    assert all(abs(r["p_yes"] + r["p_no"] - 1) < 1e-9 for r in rows)
    acc = sum((r["prediction"] == "yes") == (r["id"] >= 60) for r in rows) / len(rows)
    assert acc > 0.95


def test_binary_needs_two_classes(spark, blobs):
    three = blobs.withColumn("label", F.when(F.col("id") % 3 == 0, "maybe").otherwise(F.col("label")))
    with pytest.raises(ValueError):
        MO.fit(three, ["x", "y"], "label", MO.make_estimator("binary", "logistic_regression"), "binary")


@pytest.mark.parametrize("algo", ["decision_tree", "gbdt", "logistic_regression", "naive_bayes", "svm"])
def test_multiclass_estimators_run(blobs, algo):
    data = blobs.withColumn("label", F.when(F.col("x") > 4, "b").when(F.col("id") % 2 == 0, "a").otherwise("c"))
    m = MO.fit(data, ["x", "y"], "label", MO.make_estimator("multiclass", algo), "multiclass")
    assert MO.score(m, data).where(F.col("prediction").isNull()).count() == 0


def test_kmeans_rows_take_nearest_centre(spark, blobs):
    m = MO.fit_kmeans(blobs, ["x", "y"], K=2, n_init=2, seed=1)
    scored = MO.assign_clusters(m, blobs)
    again = MO.assign_to_centres(scored, ["x", "y"], MO.centres_table(m, spark), out="nearest")
    assert again.where(F.col("prediction") != F.col("nearest")).count() == 0
    sizes = sorted(r[0] for r in scored.groupBy("prediction").count().select("count").collect())
    assert sizes == [60, 60]


def test_ols_matches_closed_form(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    m = MO.fit(li, ["l_quantity"], "l_extendedprice", MO.make_estimator("regression", "linear_regression", solver="normal"), "regression")
    lr = m.pipeline.stages[-1]
    slope = li.agg(F.regr_slope("l_extendedprice", "l_quantity")).collect()[0][0]
    assert lr.coefficients[0] == pytest.approx(slope, rel=1e-6)


def test_pca_matches_numpy(spark):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    fit = FE.fit_pca(li, cols, 2)
    x = np.array(li.select(*cols).collect(), dtype=float)
    xc = x - x.mean(axis=0)
    vals, vecs = np.linalg.eigh(np.cov(xc, rowvar=False))
    top = vecs[:, np.argsort(vals)[::-1][:2]]
    for j in range(2):
        col = top[:, j] * np.sign(top[np.argmax(np.abs(top[:, j])), j])
        assert np.allclose(fit.components[:, j], col, atol=1e-8)
    proj = np.array(fit.transform(li).select("pca_0", "pca_1").collect())
    assert np.allclose(proj.mean(axis=0), 0, atol=1e-6)
    plan = fit.transform(li)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_frequent_itemsets_brute_force(spark):
    baskets = {1: ["a", "b", "c"], 2: ["a", "b"], 3: ["a", "c"], 4: ["b"], 5: ["a", "b", "c"]}
    df = spark.createDataFrame([(k, i) for k, items in baskets.items() for i in items], "o int, i string")
    items, _ = MO.frequent_itemsets(df, "o", "i", min_support=0.4)
    got = {tuple(sorted(r["items"])): r["freq"] for r in items.collect()}
    want = {}
    for size in (1, 2, 3):
        for combo in itertools.combinations("abc", size):
            f = sum(1 for v in baskets.values() if set(combo) <= set(v))
            if f >= 2:
                want[combo] = f
    assert got == want


def test_cross_validate_and_tune(blobs):
    cv = MO.cross_validate(blobs, ["x", "y"], "label", lambda: MO.make_estimator("binary", "logistic_regression"), "binary", "id", k=3)
    assert sorted(r["fold"] for r in cv.collect()) == [0, 1, 2]
    table, best = MO.tune(blobs, ["x", "y"], "label", "binary", [("random_forest", {"treeNum": 3}), ("logistic_regression", {})],
                          "id", "accuracy")
    assert table.count() == 2 and best is not None


def test_svd_and_flda_shapes(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    s = FE.fit_svd(li, ["l_quantity", "l_extendedprice"], 1)
    x = np.array(li.select("l_quantity", "l_extendedprice").collect(), dtype=float)
    assert s.values[0] == pytest.approx(np.linalg.svd(x, compute_uv=False)[0], rel=1e-9)
    lda = FE.fit_flda(li, ["l_quantity", "l_extendedprice", "l_discount"], "l_returnflag")
    assert lda.components.shape == (3, 2)


def test_nearest_centres_and_silhouette_match_spark_ml(spark, blobs):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from prepframe.operators import evaluate as E

    m = MO.fit_kmeans(blobs, ["x", "y"], K=3, seed=3)
    scored = MO.assign_clusters(m, blobs)
    ours = {r["id"]: r["prediction"] for r in MO.assign_to_centres(blobs, ["x", "y"], MO.centres_table(m, spark)).collect()}
    assert ours == {r["id"]: r["prediction"] for r in scored.collect()}
    a = E.silhouette(scored, ["x", "y"]).collect()[0][0]
    v = scored.select(array_to_vector(F.array("x", "y")).alias("f"), F.col("prediction").cast("double").alias("p"))
    assert a == pytest.approx(ClusteringEvaluator(featuresCol="f", predictionCol="p").evaluate(v), abs=1e-9)


def test_many_centres_and_any_payload(spark):
    """12,000 centres of 10 features, and columns that pandas could not hold."""
    from pyspark.sql import functions as F

    r = np.random.default_rng(8)
    m, x = r.normal(0, 9, (12_000, 10)), r.normal(0, 9, (300, 10))
    cents = spark.createDataFrame([(i * 2, [float(t) for t in c]) for i, c in enumerate(m)], "cluster int, centre array<double>")
    df = spark.createDataFrame([(i, [float(t) for t in v]) for i, v in enumerate(x)], "id int, v array<double>").repartition(3)
    df = df.select("id", "v", F.expr("timestamp'9999-12-31 23:59:59'").alias("end"), F.create_map(F.lit("k"), "id").alias("m"), F.lit("old").alias("prediction"))
    got = {g["id"]: g for g in MO.assign_to_centres(df, "v", cents).withColumn("end", F.col("end").cast("string")).collect()}
    best = ((x[:, None] - m[None]) ** 2).sum(2).argmin(1) * 2
    assert all(got[i]["prediction"] == best[i] and got[i]["m"] == {"k": i} and got[i]["end"] == "9999-12-31 23:59:59" for i in range(300))
    assert MO.assign_to_centres(df, "v", cents.limit(0)).where("prediction IS NOT NULL").count() == 0
    assert MO.assign_to_centres(df.limit(0), "v", cents).collect() == []


def test_offsets_and_missing_values(spark):
    from prepframe.operators import evaluate as E

    nan, inf = float("nan"), float("inf")
    rows = [(i, [1e8 + (i % 3) + 0.01 * (i % 7), -1e8 + 0.02 * (i % 5)], i % 3) for i in range(60)]
    rows += [(100, [None, 1.0], 0), (101, None, 0), (102, [nan, 1.0], 1), (103, [1e8, inf], 1), (104, [1.0], 2)]
    df = spark.createDataFrame([r for r in rows], "id int, v array<double>, c int")
    cents = spark.createDataFrame([(i, [1e8 + i + 0.03, -1e8 + 0.04]) for i in range(3)], "cluster int, centre array<double>")
    full = df.where("id < 60")

    a = {r["id"]: r["prediction"] for r in MO.assign_to_centres(df, "v", cents).collect()}
    sa = E.silhouette(full.union(df.where("id IN (100, 101, 102, 103)")), "v", "c").collect()[0][0]
    assert all(a[i] == (i % 3 if i < 60 else None) for i in a)
    x = np.array([r[1] for r in rows[:60]])
    lab = np.array([r[2] for r in rows[:60]])
    x = x - x.mean(0)
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    one = []
    for i in range(60):
        own = d[i][lab == lab[i]].sum() / ((lab == lab[i]).sum() - 1)
        other = min(d[i][lab == k].mean() for k in range(3) if k != lab[i])
        one.append((other - own) / max(own, other))
    assert sa == pytest.approx(np.mean(one), abs=1e-6)
    r = np.random.default_rng(5)
    z = np.stack([1e8 + r.normal(0, 1.3, 300), -1e8 + r.normal(0, 0.5, 300)], 1)
    vals = FE.fit_pca(spark.createDataFrame([tuple(map(float, t)) for t in z], "a double, b double"), ["a", "b"], 2).values
    assert np.allclose(sorted(vals), sorted(np.linalg.eigvalsh(np.cov((z - z.mean(0)).T))), rtol=1e-3)


def test_moments_match_numpy(spark):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    a = FE.fit_pca(li, cols, 2)
    x = li.select(*cols).toPandas().to_numpy(float)
    vals, vecs = np.linalg.eigh(np.cov(x.T))
    top = vecs[:, ::-1][:, :2]
    assert np.allclose(np.abs(a.components), np.abs(top), atol=1e-6) and np.allclose(a.centre, x.mean(0))
    assert np.allclose(a.values, vals[::-1][:2])


def test_moments_of_500_columns_and_10_classes(spark):
    r = np.random.default_rng(11)
    names = [f"c{i}" for i in range(500)]
    y = np.arange(1200) % 10
    x = r.normal(0, 1, (1200, 500)) + 1e6
    x[:, 3] += 5 * y
    rows = [(int(k), v.tolist()) for k, v in zip(y, x)] + [(1, [None] + [0.0] * 499), (2, [float("nan")] + [0.0] * 499)]
    df = spark.createDataFrame(rows, "y int, v array<double>").repartition(7)
    df = df.select("y", *[F.col("v")[i].alias(n) for i, n in enumerate(names)])
    stats, cross, shift = FE._moments(df, names, group="y")
    assert len(stats) == 10 and all(n == 120 for n, _ in stats.values()) and np.allclose(shift, x.mean(0))
    z = x - shift
    assert np.allclose(cross, z.T @ z, atol=1e-4) and all(np.allclose(s, z[y == k].sum(0), atol=1e-4) for k, (_, s) in stats.items())
    lda = FE.fit_flda(df, names[:80], "y", k=1)
    assert np.argmax(np.abs(lda.components[:, 0])) == 3
    got = lda.transform(df.where("c0 IS NOT NULL AND NOT isnan(c0)")).select("y", "lda_0").toPandas()
    assert np.allclose(sorted(got["lda_0"]), sorted((x[:, :80] - lda.centre) @ lda.components[:, 0]), atol=1e-3)
    assert np.allclose(FE._moments(df.where("y > 99"), names[:2])[1], 0)


def test_moments_with_large_offsets(spark):
    import numpy as np

    from prepframe.operators import features as FE

    r = np.random.default_rng(3)
    x = np.stack([1e9 + r.normal(0, 1.3, 500), -1e9 + r.normal(0, 0.07, 500)], 1)
    df = spark.createDataFrame([tuple(map(float, v)) for v in x], "a double, b double")
    got = FE.fit_pca(df, ["a", "b"], 2).values
    assert np.allclose(sorted(got), sorted(np.linalg.eigvalsh(np.cov((x - x.mean(0)).T))), rtol=1e-3)


def test_many_classes_margins_and_missing_features(spark):
    from prepframe.operators import models as M

    df = spark.range(3000).select(F.col("id").cast("string").alias("lab"), F.col("id").cast("double").alias("x"))
    labels, numeric = M._label_index(df, "lab")
    assert M._encode_label(df, "lab", labels, numeric).where("_label_idx IS NULL").count() == 0
    two = spark.createDataFrame([(float(i), "p" if i > 20 else "q") for i in range(60)] + [(None, "p")], "x double, lab string")
    table, best = M.tune(two, ["x"], "lab", "binary", [("svm", {"maxIter": 5}), ("logistic_regression", {"maxIter": 5})], "x", "auc")
    assert table.count() == 2 and best is not None
    m = M.fit(two, ["x"], "lab", M.make_estimator("binary", "svm", maxIter=10), "binary")
    assert M.score(m, two).count() == 61
    km = M.fit_kmeans(two, ["x"], K=2)
    assert M.assign_clusters(km, two).where("prediction IS NULL").count() == 1


def test_successive_halving_trains_few_on_all(spark):
    import threading

    from prepframe.operators import models as M

    df = spark.range(4000).select("id", (F.col("id") % 97).cast("double").alias("x"), (F.col("id") % 97 * 2.0 + 1).alias("y"))
    grid = [("linear_regression", {"regParam": float(r)}) for r in (8, 4, 0, 2, 1, 16, 32, 64)]
    seen, real, lock, threads = [], M.fit, threading.Lock(), set()

    def counted(rows, *a, **k):
        with lock:
            seen.append(rows.count())
            threads.add(threading.get_ident())
        return real(rows, *a, **k)

    M.fit = counted
    try:
        table, best = M.tune(df, ["x"], "y", "regression", grid, "id", "rmse", higher_is_better=False, halving=2, parallelism=3)
    finally:
        M.fit = real
    rungs = {eval(r["params"])[0][1]: r["rung"] for r in table.collect()}
    assert best.extra["params"] == "[('regParam', 0.0)]" and rungs[0.0] == 3 and sorted(rungs.values()) == [1, 1, 1, 1, 2, 2, 3, 3]
    assert len(seen) == 8 + 4 + 2 and len(threads) > 1
    assert max(seen[:8]) < 0.35 * max(seen) and seen[-1] == max(seen)


def test_chi2_against_spark(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    from prepframe.operators import features as FE

    df = spark.range(3000).select(
        (F.col("id") % 2).cast("double").alias("y"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") * F.col("id") % 13).cast("double").alias("b"),
        F.when(F.col("id") % 10 < 8, F.col("id") % 2).otherwise(F.col("id") % 3).cast("double").alias("c"), F.lit(1.0).alias("one"),
        F.floor(F.col("id") / 6).cast("double").alias("many"),
    )
    names = ["a", "b", "c", "one", "many"]
    got = {r["feature"]: r for r in FE.rank_chi2(df, names, "y").collect()}
    ref = ChiSquareTest.test(VectorAssembler(inputCols=names, outputCol="v").transform(df), "v", "y", flatten=True).collect()
    for r in ref:
        mine = got[names[r["featureIndex"]]]
        assert mine["statistic"] == pytest.approx(r["statistic"], abs=1e-6) and mine["dof"] == r["degreesOfFreedom"]
        assert mine["p_value"] == pytest.approx(r["pValue"], abs=1e-9)
    assert got["c"]["rank"] == 1 and FE.select_chi2(df, names, "y", 1) == ["c"]
    empty = FE.rank_chi2(df.withColumn("gone", F.lit(None).cast("string")), ["gone", "a"], "y").collect()
    assert [r["feature"] for r in empty] == ["a", "gone"] and empty[1]["p_value"] is None


def test_one_hot_vector_of_many_labels(spark):
    from pyspark.ml.linalg import SparseVector

    from prepframe.operators import categories as C

    df = spark.range(100_000).select(F.concat(F.lit("v"), "id").alias("s"))
    codes = C.fit_categories(df, ["s"], "alphabetAsc")
    new = spark.createDataFrame([("v0",), ("v99999",), ("zz",), (None,)], "s string")
    got = {r["s"]: r["s_vec"] for r in C.one_hot_vector(new, "s", codes, drop=False).collect()}
    assert got["v0"] == SparseVector(100_000, [0], [1.0]) and got["v99999"] == SparseVector(100_000, [99_999], [1.0])
    assert got["zz"] == got[None] == SparseVector(100_000, [], [])


def test_labels_are_numbered_without_a_shuffle_by_class(spark):
    from prepframe.operators import models as M

    df = spark.createDataFrame([(float(i), ("low", "mid", None)[i % 3]) for i in range(60)], "x double, y string")
    out = M._encode_label(df, "y", ["low", "mid"], False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {(r["y"], r["_label_idx"]) for r in out.collect()} == {("low", 0.0), ("mid", 1.0), (None, None)}


def test_learners_read_bounded_partitions(spark, monkeypatch):
    from prepframe.operators import models as M

    df = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 7 AS DOUBLE) AS y").coalesce(1)
    same = M._in_tasks(df)
    assert same.rdd.getNumPartitions() == 1  # few rows stay as they are
    same.unpersist()
    monkeypatch.setattr(M, "ROWS_PER_TASK", 100)
    dealt = M._in_tasks(df)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 1000 and len(sizes) >= 8 and max(sizes) < 250
    assert dealt.agg(F.sum("x")).collect()[0][0] == 499500.0
    m = M.fit(df, ["x"], "y", M.make_estimator("regression", "linear_regression"), "regression")
    assert M.score(m, df).where("prediction IS NOT NULL").count() == 1000


@pytest.fixture(scope="module")
def grades(spark):
    """Features of 20 and 9 values, one of them rare, nulls and NaN, three classes."""
    rng = np.random.default_rng(21)
    rows = [(i, float(rng.integers(1, 21)), float(rng.integers(0, 8)) / 100) for i in range(4000)]
    rows = [(i, a, b, "low" if a + 40 * b < 7 else "mid" if a < 15 or rng.random() < 0.1 else "top") for i, a, b in rows]
    rows += [(4000, 3.0, 9.0, "top"), (4001, None, 0.01, "mid"), (4002, 4.0, float("nan"), "low"), (4003, 5.0, 0.02, None)]
    return spark.createDataFrame(rows, "id int, a double, b double, y string").repartition(5).cache()


def _by_cells_and_rows(monkeypatch, df, kind, algo, **params):
    out = []
    for cells in (10_000, 0):
        monkeypatch.setattr(MO, "MAX_CELLS", cells)
        m = MO.fit(df, ["a", "b"], "y", MO.make_estimator(kind, algo, **params), kind)
        out.append((m, {r["id"]: r for r in MO.score(m, df).collect()}))
    assert len(out[0][0].pipeline.stages) == 3 and len(out[1][0].pipeline.stages) == 2
    return out


@pytest.mark.parametrize("kind,algo", [("multiclass", "decision_tree"), ("multiclass", "gbdt"), ("binary", "decision_tree"), ("binary", "gbdt")])
def test_trees_over_cells_are_those_over_rows(grades, monkeypatch, kind, algo):
    df = grades if kind == "multiclass" else grades.where("y <> 'mid' OR y IS NULL")
    (_, a), (_, b) = _by_cells_and_rows(monkeypatch, df, kind, algo, maxDepth=4, **({"maxIter": 3} if algo == "gbdt" else {}))
    assert a.keys() == b.keys() and next(iter(a.values())).asDict().keys() == next(iter(b.values())).asDict().keys()
    for i, r in a.items():
        for c, v in r.asDict().items():
            assert v == pytest.approx(b[i][c], abs=1e-9, nan_ok=True) if isinstance(v, float) else v == b[i][c], (i, c)
    assert a[4002]["prediction"] is None
    assert a[4000]["prediction"] == "top"  # one row in 4,000 beyond all others has its threshold


def test_forest_over_cells(spark, grades, monkeypatch, tmp_path):
    (m, a), (_, b) = _by_cells_and_rows(monkeypatch, grades, "multiclass", "random_forest", treeNum=7, maxDepth=4)
    assert np.mean([a[i]["prediction"] == b[i]["prediction"] for i in a]) > 0.97
    names = ["p_low", "p_mid", "p_top"]
    got, want = (np.array([[r[n] for n in names] for i, r in sorted(x.items()) if i not in (4001, 4002)]) for x in (a, b))
    assert np.allclose(got.sum(1), 1) and np.abs(got - want).mean() < 0.03
    forest = m.pipeline.stages[-1]
    assert forest.getNumTrees == 7 and forest.numClasses == 3 and len({t.toDebugString for t in forest.trees}) > 1  # drawn anew for each tree
    monkeypatch.setattr(MO, "MAX_CELLS", 10_000)
    again = MO.fit(grades, ["a", "b"], "y", MO.make_estimator("multiclass", "random_forest", treeNum=7, maxDepth=4), "multiclass")
    assert [t.toDebugString.split("\n", 1)[1] for t in again.pipeline.stages[-1].trees] == [t.toDebugString.split("\n", 1)[1] for t in forest.trees]
    m.save(str(tmp_path / "m"))
    back = {r["id"]: r for r in MO.score(MO.FittedModel.load(spark, str(tmp_path / "m")), grades).collect()}
    assert all(back[i]["prediction"] == r["prediction"] and back[i]["p_top"] == r["p_top"] for i, r in a.items())
    one = m.pipeline.transform(grades.where("id < 50")).collect()  # the pipeline itself gives what the cells give
    assert all(m.labels[int(r["_pred"])] == a[r["id"]]["prediction"] for r in one)


@pytest.mark.parametrize("algo,params", [("decision_tree", {}), ("random_forest", {"treeNum": 3}), ("gbdt", {"maxIter": 2, "maxDepth": 2})])
def test_learners_of_few_features_get_cells_not_rows(spark, monkeypatch, algo, params):
    from pyspark.ml import classification as C

    rng = np.random.default_rng(4)
    x = rng.lognormal(0, 2, (30_000, 2))
    df = spark.createDataFrame(x.tolist(), "a double, b double").withColumn("y", F.when(F.col("a") < 0.5, "p").when(F.col("b") < 2, "q").otherwise("r"))
    df, seen = df.cache(), []
    for k in (C.DecisionTreeClassifier, C.RandomForestClassifier, C.GBTClassifier):
        real = k._fit
        monkeypatch.setattr(k, "_fit", lambda self, d, real=real: (seen.append(d.count()), real(self, d))[1])
    m = MO.fit(df, ["a", "b"], "y", MO.make_estimator("multiclass", algo, **params), "multiclass")
    assert seen and max(seen) <= 3 * 32 * 32
    s = MO.score(m, df)
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert s.where("prediction = y").count() > 0.97 * 30_000 and s.count() == 30_000


def test_thresholds_and_what_keeps_its_rows(spark, blobs):
    assert MO._thresholds([], 32) == MO._thresholds([5.0] * 9, 32) == []
    assert MO._thresholds([1.0, 3.0, 3.0, 7.0], 4) == [2.0, 5.0]
    even = MO._thresholds([float(i) for i in range(10_000)], 32)
    assert len(even) == 31 and np.allclose(np.diff(even), 312.5, atol=1)
    heavy = MO._thresholds([0.0] * 9000 + [float(i) for i in range(1, 1001)], 32)
    assert heavy[0] == 0.5 and len(heavy) <= 31
    near = np.nextafter(1.0, 2.0)
    assert MO._thresholds([1.0, near, float("inf")], 32) == [1.0, near] and MO._thresholds([-float("inf"), float("inf")], 32) == [-float("inf")]
    bins = [MO._cell_bins(MO.make_estimator(kind, algo, **p), blobs, f, n) for kind, algo, p, f, n in (
        ("binary", "random_forest", {}, ["x", "y"], 2), ("multiclass", "gbdt", {}, ["x", "y"], 9), ("multiclass", "gbdt", {}, ["x", "y"], 10),
        ("binary", "decision_tree", {}, ["x", "y", "id"], 2), ("binary", "random_forest", {"minSamplesLeaf": 2}, ["x"], 2), ("multiclass", "svm", {}, ["x"], 3),
        ("binary", "logistic_regression", {}, ["x"], 2), ("binary", "decision_tree", {}, ["label"], 2))]
    assert bins == [32, 32, 0, 0, 0, 0, 0, 0]
    flat = blobs.withColumn("x", F.lit(2.0))  # a feature of one value
    m = MO.fit(flat, ["x", "y"], "label", MO.make_estimator("binary", "decision_tree"), "binary")
    assert MO.score(m, flat).where("prediction = label").count() == 120
