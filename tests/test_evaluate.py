"""Metrics against hand-computed values and brute force."""

import math

import pytest
from pyspark.sql import functions as F

from prepframe.operators import evaluate as E


def _brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_with_ties_equals_brute_force(spark):
    rows = [(1, 0.5), (0, 0.5), (1, 1.0), (0, 0.0), (1, 0.5), (0, 1.0), (0, 0.0), (1, 0.0)] * 3
    df = spark.createDataFrame(rows, "y int, s double")
    got = E.binary_auc(df, "y", "s").collect()[0][0]
    assert got == pytest.approx(_brute_auc(rows))


def test_single_class_auc_is_null(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.9)], "y int, s double")
    assert E.binary_auc(df, "y", "s").collect()[0][0] is None
    curve = E.roc_pr_curve(df, "y", "s").collect()
    assert len(curve) == 101 and all(r["tpr"] is None for r in curve)


def test_binary_counts_and_null_precision(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    m = E.binary_metrics(df, "y", "p").collect()[0]
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == (2, 0, 1, 0)
    assert m["precision"] is None and m["recall"] == 0.0 and m["accuracy"] == pytest.approx(2 / 3)


def test_string_labels(spark):
    df = spark.createDataFrame([("yes", "yes"), ("no", "yes"), ("yes", "no")], "y string, p string")
    m = E.binary_metrics(df, "y", "p", pos_label="yes").collect()[0]
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (1, 1, 1, 0)


def test_roc_curve_monotone_and_strict(spark):
    rows = [(i % 2, (i % 11) / 10.0) for i in range(200)]
    df = spark.createDataFrame(rows, "y int, s double")
    curve = E.roc_pr_curve(df, "y", "s").collect()
    assert [r["threshold"] for r in curve] == [i / 100 for i in range(100, -1, -1)]
    tprs = [r["tpr"] for r in curve]
    assert all(a <= b + 1e-12 for a, b in zip(tprs, tprs[1:]))
    for r in curve:  # strict: score > threshold
        tp = sum(1 for y, s in rows if y == 1 and s > r["threshold"])
        assert r["tpr"] == pytest.approx(tp / 100)


def test_multiclass_missing_prediction_class(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c"), ("c", "c")], "y string, p string")
    m = E.multiclass_metrics(df, "y", "p").collect()[0]
    assert m["accuracy"] == 0.75
    # b is never predicted: precision 0 for b; macro over {a, b, c}
    assert m["macro_recall"] == pytest.approx((1 + 0 + 1) / 3)
    cm = {r["label"]: r for r in E.confusion_table(df, "y", "p", ["a", "b", "c"]).collect()}
    assert (cm["b"]["a"], cm["b"]["b"]) == (1, 0)
    total = sum(r["n"] for r in E.confusion_counts(df, "y", "p").collect())
    assert total == 4


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0), (4.0, 5.0)], "y double, p double")
    m = E.regression_metrics(df, "y", "p").collect()[0]
    sse = 0.25 + 0 + 1 + 1
    sst = sum((v - 2.5) ** 2 for v in [1, 2, 3, 4])
    assert m["sse"] == pytest.approx(sse) and m["sst"] == pytest.approx(sst) and m["r2"] == pytest.approx(1 - sse / sst)
    assert m["median_ae"] == pytest.approx(0.75) and m["mean_ae"] == pytest.approx(2.5 / 4)
    assert m["rmse"] == pytest.approx(math.sqrt(sse / 4))


def test_silhouette_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler

    rows = [(float(i % 7), float((i * 3) % 5), i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, prediction int")
    ours = E.silhouette(df, ["a", "b"], "prediction").collect()[0][0]
    v = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    ref = ClusteringEvaluator(predictionCol="prediction", featuresCol="features").evaluate(v)
    assert ours == pytest.approx(ref, abs=1e-9)


def test_logloss_clamped(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 0.0)], "y int, s double")
    v = E.binary_logloss(df, "y", "s").collect()[0][0]
    assert v == pytest.approx(-math.log(1e-15) / 3, rel=1e-6)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("abcd")), min_size=1, max_size=40))
def test_confusion_counts_sum_to_n(spark, rows):
    df = spark.createDataFrame(rows, "y string, p string")
    assert sum(r["n"] for r in E.confusion_counts(df, "y", "p").collect()) == len(rows)
    m = E.multiclass_metrics(df, "y", "p").collect()[0]
    assert m["accuracy"] == pytest.approx(sum(1 for y, p in rows if y == p) / len(rows))
