"""Distributed ordering helper vs Spark windows (one path for every size)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from prepframe.operators.ordering import exact_percentiles, ntile_expr, ordered_totals

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id", "event_type", "value")


@pytest.mark.parametrize("buckets", [1, 7, 40])
def test_grouped_running_totals_match_window(spark, events, buckets):
    r = ordered_totals(events, ["value", "event_id"], partition_by=["user_id"], sums=["value"],
                       group_totals=True, nbuckets=buckets)
    w = Window.partitionBy("user_id").orderBy("value", "event_id")
    ref = events.select(
        "event_id",
        F.row_number().over(w).alias("rn"),
        F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cs"),
        F.count(F.lit(1)).over(Window.partitionBy("user_id")).alias("tot"),
    )
    j = r.join(ref, "event_id")
    assert j.count() == events.count()
    bad = j.filter((F.col("_rn") != F.col("rn")) | (F.abs(F.col("_cum_value") - F.col("cs")) > 1e-6)
                   | (F.col("_tot_n") != F.col("tot")))
    assert bad.count() == 0


def test_global_row_numbers_with_hot_key(spark):
    # one key holds a third of the rows: the range layout still splits it
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"))
    r = ordered_totals(df, ["id"], partition_by=["g"], nbuckets=8)
    hot = r.where("g = 0").orderBy("id").select("_rn").collect()
    assert [x[0] for x in hot] == list(range(1, 1001))


def test_null_group_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4), (None, 5)], "g string, v int")
    r = ordered_totals(df, ["v"], partition_by=["g"], nbuckets=3)
    got = {(row["g"], row["v"]): row["_rn"] for row in r.collect()}
    assert got == {(None, 1): 1, (None, 2): 2, (None, 5): 3, ("a", 3): 1, ("a", 4): 2}


@pytest.mark.parametrize("n", [1, 4, 5, 7, 13, 100])
def test_ntile_matches_sql(spark, n):
    df = spark.range(n)
    ours = df.select("id", ntile_expr(F.col("id") + 1, F.lit(n), 5).alias("t"))
    ref = df.select("id", F.ntile(5).over(Window.orderBy("id")).alias("t"))
    assert sorted(ours.collect()) == sorted(ref.collect())


def test_exact_percentiles_match_builtin(spark, events):
    ours = exact_percentiles(events, "value", [0.0, 0.25, 0.5, 0.9, 1.0], group_by=["event_type"]).orderBy("event_type").collect()
    ref = events.groupBy("event_type").agg(
        *[F.percentile("value", q).alias(f"r{i}") for i, q in enumerate([0.0, 0.25, 0.5, 0.9, 1.0])]
    ).orderBy("event_type").collect()
    for a, b in zip(ours, ref):
        for i in range(5):
            assert a[f"q_{i}"] == pytest.approx(b[f"r{i}"], rel=1e-12)


def test_exact_percentiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert exact_percentiles(df, "x", [0.5]).collect()[0][0] == 2.0


def test_bracketed_percentiles_large_n(spark):
    # n >> accuracy: the candidate brackets are a small slice of each group
    df = spark.range(60000).select(
        (F.col("id") % 3).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(100003)) / 7.0).alias("v")
    )
    qs = [0.01, 0.25, 0.5, 0.99]
    ours = exact_percentiles(df, "v", qs, group_by=["g"], accuracy=200).orderBy("g").collect()
    ref = df.groupBy("g").agg(*[F.percentile("v", q).alias(f"r{i}") for i, q in enumerate(qs)]).orderBy("g").collect()
    for a, b in zip(ours, ref):
        for i in range(len(qs)):
            assert a[f"q_{i}"] == pytest.approx(b[f"r{i}"], rel=1e-12)


def test_full_ranking_fallback(spark, events):
    from prepframe.operators.ordering import _exact_percentiles_full

    ours = _exact_percentiles_full(events, "value", [0.5], ["event_type"], ["m"]).orderBy("event_type").collect()
    ref = events.groupBy("event_type").agg(F.percentile("value", 0.5).alias("m")).orderBy("event_type").collect()
    assert [r["m"] for r in ours] == pytest.approx([r["m"] for r in ref])


def test_values_survive_unchanged(spark):
    # numbers above 2**53 beside nulls, years 1500 and 9999, a map column, tied leading keys
    df = spark.sql(
        "SELECT * FROM VALUES (9007199254740993L, TIMESTAMP '1500-03-01 00:00:00', 1), (NULL, TIMESTAMP '9999-12-31 23:59:59', 1),"
        "(9007199254740992L, NULL, 1) AS t(x, ts, tie)"
    ).withColumn("m", F.create_map(F.lit("a"), F.col("x")))
    from prepframe.operators.reshape import add_id

    out = add_id(df, order_by=["tie", "x"], start=1)
    got = {r["id"]: (r["x"], r["ts"] is None) for r in out.select("id", "x", F.col("ts").cast("string").alias("ts")).collect()}
    assert got == {1: (None, False), 2: (9007199254740992, True), 3: (9007199254740993, False)}
    years = add_id(df, order_by=[("ts", False), "x"]).select("id", F.year("ts").alias("y"), F.col("m")["a"].alias("a")).orderBy("id").collect()
    assert [r["y"] for r in years] == [9999, 1500, None] and years[1]["a"] == 9007199254740993


def test_no_python_and_no_single_task_over_rows(spark):
    df = spark.range(0, 5000, 1, 8).select(F.lit(1).alias("tie"), F.col("id"))
    r = ordered_totals(df, ["tie", "id"], nbuckets=16)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "Python" not in plan
    assert [x[0] for x in r.orderBy("id").select("_rn").collect()] == list(range(1, 5001))


def test_first_rows_by_refinement(spark):
    from prepframe.operators import ordering as O

    df = spark.range(5000).select("id", (F.col("id") * 7919 % 50).alias("g"), F.when(F.col("id") % 9 == 0, None).otherwise(F.col("id") % 11).alias("v"))
    rows = [tuple(r) for r in df.collect()]
    for order, key in (
        (["g", "id"], lambda r: (r[1], r[0])),
        ([("v", False), "id"], lambda r: (r[2] is None, -(r[2] or 0), r[0])),
        (["v", ("id", False)], lambda r: (r[2] is not None, r[2] or 0, -r[0])),
    ):
        for k in (0, 1, 37, 556, 2500, 4999, 5000, 10**9):
            for settled in (10, 100_000):
                old, O.SETTLED_ROWS = O.SETTLED_ROWS, settled
                try:
                    got = sorted(tuple(r) for r in O.first_rows(df, order, k, nbuckets=6).collect())
                finally:
                    O.SETTLED_ROWS = old
                assert got == sorted(sorted(rows, key=key)[:k]), (order, k)
    same = spark.range(300).select(F.lit(1).alias("a"))
    assert O.first_rows(same, ["a"], 7).count() == 7  # equal tuples only


def test_top_k_is_not_merged_in_one_task(spark):
    from prepframe.operators.reshape import sort_values

    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 6) for i in range(400)], "id int, v int")
    for asc in (True, False):
        for last in (True, False):
            top = sort_values(df, ["v", "id"], [asc, True], [last, False], top_k=150)
            plan = top._jdf.queryExecution().executedPlan().toString()
            assert "TakeOrdered" not in plan and "GlobalLimit" not in plan
            want = sorted(((r["v"], r["id"]) for r in df.collect()), key=lambda t: ((t[0] is None) == last, (t[0] or 0) * (1 if asc else -1), t[1]))
            assert [(r["v"], r["id"]) for r in top.collect()] == want[:150]


@pytest.mark.parametrize("hot", range(6))
def test_buckets_survive_a_hot_tuple(spark, hot):
    # a third of the rows share one sort tuple: the rest is still cut into many ranges
    from prepframe.operators.ordering import _bucket

    df = spark.range(44_000).select(F.when(F.col("id") % 3 == 0, F.lit(hot * 7919)).otherwise(F.col("id")).alias("k"))
    sizes = [r["count"] for r in df.groupBy(_bucket(df, [("k", True)], 16).alias("b")).count().collect()]
    assert len(sizes) >= 10 and sum(n > 4 * 44_000 / 16 for n in sizes) <= 1


def test_rows_stay_where_they_are_when_groups_are_joined(spark, monkeypatch):
    from prepframe.operators import ordering as O

    df = spark.createDataFrame([(None if i % 5 == 0 else f"g{i % 3}", float(i)) for i in range(300)], "g string, v double")
    table = df.groupBy("g").agg(F.sum("v").alias("s"))
    want = sorted((str(r["g"]), r["v"], r["s"]) for r in df.join(table.withColumnRenamed("g", "k"), F.col("g").eqNullSafe(F.col("k"))).collect())
    small = O.join_groups(df, table, ["g"])
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(O, "GROUPS_SENT", 1)  # a larger table: by group and salt
    large = O.join_groups(df, table, ["g"])
    assert "_salt" in large._jdf.queryExecution().executedPlan().toString()
    for out in (small, large):
        assert sorted((str(r["g"]), r["v"], r["s"]) for r in out.collect()) == want


def test_fences_send_no_rows_by_group(spark):
    from prepframe.operators import features as FE

    df = spark.createDataFrame([("a" if i % 4 else "b", float(i if i < 90 else 10_000)) for i in range(100)], "g string, v double")
    bounds = FE.fit_anomaly_bounds(df, ["v"], "iqr", group_by=["g"])
    out = FE.flag_anomalies(df, bounds, ["v"], group_by=["g"])
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["g"]: r["n"] for r in out.where("v_outlier").groupBy("g").agg(F.count("*").alias("n")).collect()} == {"a": 8, "b": 2}
