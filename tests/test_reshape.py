"""Reshaping, categories, RFM and series operators on small frames."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from prepframe.operators import categories as C
from prepframe.operators import reshape as R
from prepframe.operators import series as SE


def test_category_codes_ties_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "s string")
    codes = {r["label"]: r["idx"] for r in C.fit_categories(df, ["s"]).collect()}
    assert codes == {"c": 0, "a": 1, "b": 2}  # frequency, ties alphabetical, null not coded
    alpha = {r["label"]: r["idx"] for r in C.fit_categories(df, ["s"], "alphabetAsc").collect()}
    assert alpha == {"a": 0, "b": 1, "c": 2}
    new = spark.createDataFrame([("a",), ("z",), (None,)], "s string")
    fitted = C.fit_categories(spark.createDataFrame([("a",), ("b",)], "s string"), ["s"])
    assert sorted(r[0] for r in C.apply_categories(new, fitted).collect()) == [-1, -1, 0]
    assert sorted(r[0] for r in C.apply_categories(new, fitted, unseen="keep").collect()) == [0, 2, 2]


def test_category_labels_with_delimiters(spark):
    df = spark.createDataFrame([("a#b",), ("tab\there",), ("a#b",)], "s string")
    codes = {r["label"]: r["idx"] for r in C.fit_categories(df, ["s"]).collect()}
    assert codes == {"a#b": 0, "tab\there": 1}


def test_one_hot_and_target_encoding(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 0.0), ("x", 0.0)], "s string, t double")
    oh = C.one_hot(df, "s", ["x", "y"]).collect()
    assert [(r["s_x"], r["s_y"]) for r in oh] == [(1, 0), (0, 1), (1, 0)]
    enc = {r["label"]: r["enc"] for r in C.fit_target_encoding(df, "s", "t", smoothing=0.0).collect()}
    assert enc == {"x": 0.5, "y": 0.0}


def test_join_suffixes_and_keys(spark):
    a = spark.createDataFrame([(1, "a1", 10), (2, "a2", 20)], "k int, name string, v int")
    b = spark.createDataFrame([(2, "b2"), (3, "b3")], "k int, name string")
    full = R.join(a, b, "k", "full")
    assert full.columns == ["k", "name", "v", "name_right"]
    assert sorted(r["k"] for r in full.collect()) == [1, 2, 3]
    assert R.join(a, b, "k", "anti").count() == 1 and R.join(a, b, "k", "semi").count() == 1
    with pytest.raises(ValueError):
        R.join(a, b, "k", "cross")


def test_merge_rows_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2,)], "k int")
    rows = R.merge_rows(a, b).orderBy("k").collect()
    assert rows[1]["s"] is None


def test_kv_roundtrip(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, None)], "id int, a double, b double")
    kv = R.table_to_kv(df, ["id"], ["a", "b"])
    back = R.kv_to_table(kv.where(F.col("v").isNotNull()), ["id"], "k", "v", ["a", "b"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_missing_values(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", None), ("h", 5.0), ("h", float("nan")), ("h", 7.0)], "g string, x double")
    mean = {(r["g"], i): r["x"] for i, r in enumerate(R.handle_missing(df, ["x"], "mean", group_by=["g"]).orderBy("g").collect())}
    assert sorted(v for v in mean.values()) == [1.0, 1.0, 5.0, 6.0, 7.0]
    med = sorted(r["x"] for r in R.handle_missing(df, ["x"], "median").collect())
    assert med == [1.0, 5.0, 5.0, 5.0, 7.0]
    assert R.handle_missing(df, ["x"], "drop").count() == 3
    assert sorted(r["x"] for r in R.handle_missing(df, ["x"], "constant", value=0.0).collect()) == [0.0, 0.0, 1.0, 5.0, 7.0]


def test_dedupe_keep_first_last(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 5, "x"), (1, 1, "b")], "k int, o int, v string")
    first = {r["k"]: r["v"] for r in R.drop_duplicates(df, ["k"], ["o"]).collect()}
    last = {r["k"]: r["v"] for r in R.drop_duplicates(df, ["k"], ["o"], keep="last").collect()}
    assert first == {1: "a", 2: "x"} and last == {1: "c", 2: "x"}
    assert R.drop_duplicates(df.select("k")).count() == 2


def test_sort_nulls_and_topk(spark):
    df = spark.createDataFrame([(None,), (2,), (1,)], "x int")
    assert [r[0] for r in R.sort_values(df, ["x"], nulls_last=True).collect()] == [1, 2, None]
    assert [r[0] for r in R.sort_values(df, ["x"], ascending=False, top_k=1).collect()] == [None]


def test_add_id_dense(spark):
    df = spark.createDataFrame([(5,), (3,), (9,)], "x int")
    got = {r["x"]: r["id"] for r in R.add_id(df, "id", ["x"]).collect()}
    assert got == {3: 1, 5: 2, 9: 3}


def test_group_by_median_and_first(spark):
    df = spark.createDataFrame([("a", 1, 3.0), ("a", 2, 1.0), ("a", 3, 2.0), ("b", 1, 4.0)], "g string, t int, v double")
    out = {r["g"]: r for r in R.group_by(df, ["g"], {"m": ("median", "v"), "f": ("first", "v", "t"), "l": ("last", "v", "t"),
                                                     "n": ("count", "*")}).collect()}
    assert (out["a"]["m"], out["a"]["f"], out["a"]["l"], out["a"]["n"]) == (2.0, 3.0, 2.0, 3)
    assert out["b"]["m"] == 4.0


def test_fir_and_median_short_series(spark):
    df = spark.createDataFrame([("s", 1, 1.0), ("s", 2, 2.0), ("t", 1, 10.0)], "g string, t int, x double")
    fir = {(r["g"], r["t"]): r["fir"] for r in SE.fir_filter(df, "g", "t", "x", [0.5, 0.5]).collect()}
    assert fir == {("s", 1): 0.5, ("s", 2): 1.5, ("t", 1): 5.0}
    med = {(r["g"], r["t"]): r["median"] for r in SE.median_filter(df, "g", "t", "x", 1).collect()}
    assert med == {("s", 1): 1.5, ("s", 2): 1.5, ("t", 1): 10.0}


def test_iir_matches_recursion(spark):
    import numpy as np

    xs = [float(v) for v in np.random.default_rng(1).normal(size=40)]
    df = spark.createDataFrame([("a" if i < 25 else "b", i, x) for i, x in enumerate(xs)], "g string, t int, x double")
    got = {r["t"]: r["iir"] for r in SE.iir_filter(df, "g", "t", "x", b=[0.3, 0.2], a=[1.0, -0.4, 0.1]).collect()}
    for g_rows in (range(0, 25), range(25, 40)):
        y = {}
        for n in g_rows:
            x = lambda m: xs[m] if m >= g_rows.start else 0.0
            yy = lambda m: y.get(m, 0.0)
            y[n] = 0.3 * x(n) + 0.2 * x(n - 1) + 0.4 * yy(n - 1) - 0.1 * yy(n - 2)
            assert got[n] == pytest.approx(y[n], abs=1e-12)


def test_transpose_small(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "k string, x double, y double")
    t = R.transpose(df, "k")
    assert t.columns == ["key", "a", "b"] and t.count() == 2


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.floats(-100, 100, allow_nan=False), st.floats(-100, 100, allow_nan=False)),
                min_size=1, max_size=12, unique_by=lambda t: t[0]))
def test_kv_roundtrip_property(spark, rows):
    df = spark.createDataFrame(rows, "id int, a double, b double")
    back = R.kv_to_table(R.table_to_kv(df, ["id"], ["a", "b"]), ["id"], "k", "v", ["a", "b"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_encodings_apply(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 0.0), ("x", 0.0), (None, 1.0)], "s string, t double")
    key = lambda v: (v[0] is not None, v[0] or "", v[1])
    freq = sorted(((r["s"], r["s_freq"]) for r in C.frequency_encode(df, "s").collect()), key=key)
    assert freq == sorted([("x", 2), ("y", 1), ("x", 2), (None, 1)], key=key)
    enc = C.fit_target_encoding(df.where("s IS NOT NULL"), "s", "t", smoothing=0.0)
    new = spark.createDataFrame([("x",), ("z",)], "s string")
    got = {r["s"]: r["s_te"] for r in C.apply_target_encoding(new, "s", enc).collect()}
    assert got == {"x": 0.5, "z": pytest.approx(1 / 3)}
    codes = C.fit_categories(df, ["s"])
    coded = sorted(r[0] for r in C.apply_categories(new, codes).collect())
    assert coded == [-1, 0]


def test_rfm_scores_balanced_and_segmented(spark):
    from prepframe.operators import rfm as RF

    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    r = RF.rfm_process(o, "o_custkey", "o_orderdate", "o_totalprice", as_of="2001-09-01")
    s = RF.rfm_scores(r, "o_custkey").collect()
    n = len(s)
    for col in ("r_score", "f_score", "m_score"):
        counts = {}
        for row in s:
            counts[row[col]] = counts.get(row[col], 0) + 1
        assert set(counts) == {1, 2, 3, 4, 5} and max(counts.values()) - min(counts.values()) <= 1 and sum(counts.values()) == n
    for row in s:
        rr, ff = row["r_score"], row["f_score"]
        want = ("champion" if rr >= 4 and ff >= 4 else "new" if rr >= 4 and ff <= 2 else
                "at_risk" if rr <= 2 and ff >= 4 else "lost" if rr <= 2 and ff <= 2 else "regular")
        assert row["segment"] == want and row["rfm_code"] == f"{rr}{ff}{row['m_score']}"


def test_null_group_is_one_group(spark):
    df = spark.createDataFrame([(None, 1.0, 5.0), (None, None, None), ("g", 3.0, None)], "g string, x double, y double")
    for strategy in ("median", "mode", "mean"):
        out = R.handle_missing(df, ["x", "y"], strategy, group_by=["g"]).collect()
        assert len(out) == 3 and sum(r["g"] is None and r["x"] == 1.0 and r["y"] == 5.0 for r in out) == 2


def test_keep_first_with_a_map_column(spark):
    df = spark.sql("SELECT k, o, map('a', o) AS m FROM VALUES (1, 2), (1, 1), (2, 7) AS t(k, o)")
    got = {r["k"]: r["m"]["a"] for r in R.drop_duplicates(df, ["k"], order_by=["o"]).collect()}
    assert got == {1: 1, 2: 7}
