"""Casts, normalisation, splits, binning on the FIXTURES edge frames."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prepframe.functions.columns import scale_expr, to_double, to_int
from prepframe.operators import normalize as N
from prepframe.operators import split as S


def test_cast_int_junk(spark):
    vals = ["1", " 7 ", "12.7", "1e3", "x", "", "NaN", "inf", "1_000", None]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    got = [r[0] for r in df.select(to_int("c", -1)).collect()]
    assert got == [1, 7, -1, -1, -1, -1, -1, -1, -1, -1]


def test_cast_int_from_double_truncates(spark):
    df = spark.createDataFrame([(12.7,), (-12.7,), (float("nan"),), (float("inf"),), (None,)], "c double")
    assert [r[0] for r in df.select(to_int("c", 0)).collect()] == [12, -12, 0, 0, 0]


def test_cast_double(spark):
    df = spark.createDataFrame([("1e3",), ("NaN",), ("x",), (None,), (" 2.5 ",)], "c string")
    got = [r[0] for r in df.select(to_double("c", 0.0)).collect()]
    assert got[0] == 1000.0 and math.isnan(got[1]) and got[2:] == [0.0, 0.0, 2.5]
    got2 = [r[0] for r in df.select(to_double("c", -1.0, nan_to_default=True)).collect()]
    assert got2[1] == -1.0


def test_minmax_constant_and_nulls(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, None), (3.0, float("nan")), (3.0, 3.0)], "k double, x double")
    out, params = N.normalize(df, ["k", "x"], "minMax")
    rows = out.collect()
    assert [r["k"] for r in rows] == [0.0, 0.0, 0.0, 0.0]
    assert rows[0]["x"] == 0.0 and rows[1]["x"] is None and math.isnan(rows[2]["x"]) and rows[3]["x"] == 1.0
    p = {r["col"]: (r["min"], r["max"]) for r in params.collect()}
    assert p == {"k": (3.0, 3.0), "x": (1.0, 3.0)}


def test_zscore_sample_and_population(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    z1 = [r[0] for r in N.apply_zscore(df, N.fit_zscore(df, ["x"])).collect()]
    assert z1 == pytest.approx([-1.0, 0.0, 1.0])
    z0 = [r[0] for r in N.apply_zscore(df, N.fit_zscore(df, ["x"], ddof=0)).collect()]
    assert z0[2] == pytest.approx(1 / math.sqrt(2 / 3))


def test_zscore_one_row_and_empty(spark):
    one = spark.createDataFrame([(5.0,)], "x double")
    assert N.apply_zscore(one, N.fit_zscore(one, ["x"])).collect()[0][0] == 0.0
    empty = spark.createDataFrame([], "x double")
    assert N.apply_zscore(empty, N.fit_zscore(empty, ["x"])).count() == 0


def test_fit_is_one_aggregate(spark):
    df = spark.range(100).select((F.col("id") * 1.0).alias("a"), (F.col("id") * 2.0).alias("b"))
    plan = N.fit_minmax(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") <= 2 and "PythonUDF" not in plan and "BatchEvalPython" not in plan


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=2, max_size=30))
def test_minmax_in_unit_interval(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    out = [r[0] for r in N.normalize(df, ["x"], "minMax")[0].collect()]
    assert all(-1e-12 <= v <= 1 + 1e-12 for v in out)


def test_apply_fit_equals_fit_transform(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    a, params = N.normalize(df, ["l_quantity"], "standard")
    b = N.apply_zscore(df, params)
    assert a.select(F.sum("l_quantity")).collect() == b.select(F.sum("l_quantity")).collect()


def test_split_threshold_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "t double")
    hi, lo = S.split_threshold(df, "t", 2.0)
    assert (hi.count(), lo.count()) == (1, 1)
    hi, lo = S.split_threshold(df, "t", 2.0, nulls="left")
    assert (hi.count(), lo.count()) == (2, 1)


def test_hash_split_disjoint_complete(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    a, b = S.split_hash(ev, "event_id", 0.3, seed=1)
    assert a.count() + b.count() == ev.count()
    assert a.join(b, "event_id").count() == 0
    a2, _ = S.split_hash(ev, "event_id", 0.3, seed=1)
    assert sorted(r[0] for r in a.select("event_id").collect()) == sorted(r[0] for r in a2.select("event_id").collect())


def test_sample_n_exact(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert S.sample_n(ev, 37, "event_id").count() == 37


def test_width_bins_and_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    out = N.apply_width_bins(df, N.fit_width_bins(df, ["x"]), 5).select("x_bin").collect()
    assert [r[0] for r in out] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]
    edges = N.quantile_edges(df, "x", 2)
    assert edges == [4.5]
    b = N.bucketize(df, "x", edges).select("x_bin").collect()
    assert [r[0] for r in b] == [0] * 5 + [1] * 5


def test_clip_given_bounds(spark):
    df = spark.createDataFrame([(-5.0,), (0.5,), (9.0,)], "x double")
    assert [r[0] for r in N.clip(df, {"x": (0.0, 1.0)}).collect()] == [0.0, 0.5, 1.0]


def test_scale_invalid_to_null(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (4.0,)], "x double")
    got = [tuple(r) for r in df.select(scale_expr("x", "log"), scale_expr("x", "sqrt")).collect()]
    assert got[0] == (None, None) and got[1] == (None, 0.0) and got[2][1] == 2.0
    with pytest.raises(ValueError):
        scale_expr("x", "nope")


@pytest.mark.parametrize("n", [0, 50, 600, 10**6])
def test_sample_n_takes_the_smallest_hashes(spark, n):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id")
    got = sorted(r[0] for r in S.sample_n(ev, n, "event_id", seed=2).collect())
    all_ids = [(r["h"], r["event_id"]) for r in ev.select(S.hash_bucket("event_id", 2).alias("h"), "event_id").collect()]
    assert got == sorted(i for _, i in sorted(all_ids)[:n])
