"""Preparation queries: normalisation, casts, splits, sampling, binning, clipping, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepframe.functions.columns import scale_expr, to_double, to_int
from prepframe.operators import normalize as N
from prepframe.operators import split as S
from prepframe.plans.registry import load, query, rounded

LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _group_avgs(df, key, cols):
    return rounded(df.groupBy(key).agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("n")))


@query(
    "normalize_minmax",
    """
WITH p AS (SELECT min(l_quantity) q0, max(l_quantity) q1, min(l_extendedprice) e0, max(l_extendedprice) e1,
                  min(l_discount) d0, max(l_discount) d1, min(l_tax) t0, max(l_tax) t1 FROM lineitem)
SELECT l_returnflag,
       round(avg((l_quantity - q0) / (q1 - q0)), 6) AS l_quantity,
       round(avg((l_extendedprice - e0) / (e1 - e0)), 6) AS l_extendedprice,
       round(avg((l_discount - d0) / (d1 - d0)), 6) AS l_discount,
       round(avg((l_tax - t0) / (t1 - t0)), 6) AS l_tax,
       count(*) AS n
FROM lineitem, p GROUP BY l_returnflag
""",
)
def normalize_minmax(spark, sf):
    li = load(spark, sf, "lineitem")
    out, _ = N.normalize(li, LINE_COLS, "minMax")
    return _group_avgs(out, "l_returnflag", LINE_COLS)


@query(
    "normalize_zscore",
    """
WITH p AS (SELECT avg(l_quantity) q0, stddev_samp(l_quantity) q1, avg(l_extendedprice) e0, stddev_samp(l_extendedprice) e1,
                  avg(l_discount) d0, stddev_samp(l_discount) d1, avg(l_tax) t0, stddev_samp(l_tax) t1 FROM lineitem)
SELECT l_returnflag,
       round(avg((l_quantity - q0) / q1), 6) AS l_quantity,
       round(avg((l_extendedprice - e0) / e1), 6) AS l_extendedprice,
       round(avg((l_discount - d0) / d1), 6) AS l_discount,
       round(avg((l_tax - t0) / t1), 6) AS l_tax,
       count(*) AS n
FROM lineitem, p GROUP BY l_returnflag
""",
)
def normalize_zscore(spark, sf):
    li = load(spark, sf, "lineitem")
    out, _ = N.normalize(li, LINE_COLS, "standard")
    return _group_avgs(out, "l_returnflag", LINE_COLS)


@query(
    "normalize_params",
    """
SELECT 'l_quantity' AS col, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem
UNION ALL SELECT 'l_extendedprice', min(l_extendedprice), max(l_extendedprice) FROM lineitem
UNION ALL SELECT 'l_discount', min(l_discount) + 0.0, max(l_discount) + 0.0 FROM lineitem
UNION ALL SELECT 'l_tax', min(l_tax) + 0.0, max(l_tax) + 0.0 FROM lineitem
""",
)
def normalize_params(spark, sf):
    p = N.fit_minmax(load(spark, sf, "lineitem"), LINE_COLS)
    return p.select("col", (F.col("min") + 0.0).alias("min"), (F.col("max") + 0.0).alias("max"))


@query(
    "normalize_apply",
    """
WITH fit AS (SELECT min(o_totalprice) lo, max(o_totalprice) hi, avg(o_totalprice) mu, stddev_samp(o_totalprice) sd
             FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
SELECT o_orderstatus,
       round(avg((o_totalprice - lo) / (hi - lo)), 6) AS mm,
       round(max((o_totalprice - lo) / (hi - lo)), 6) AS mm_max,
       round(avg((o_totalprice - mu) / sd), 6) AS z,
       count(*) AS n
FROM orders, fit GROUP BY o_orderstatus
""",
)
def normalize_apply(spark, sf):
    orders = load(spark, sf, "orders")
    train = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    # fit on the older orders, apply both parameter tables to every order in one projection
    p_mm = N.fit_minmax(train, ["o_totalprice"]).withColumn("col", F.lit("mm"))
    p_z = N.fit_zscore(train, ["o_totalprice"]).withColumn("col", F.lit("z"))
    x = F.col("o_totalprice")
    both = orders.select("o_orderstatus", x.alias("mm"), x.alias("z"))
    scored = N.apply_zscore(N.apply_minmax(both, p_mm), p_z)
    return rounded(
        scored.groupBy("o_orderstatus").agg(
            F.avg("mm").alias("mm"), F.max("mm").alias("mm_max"), F.avg("z").alias("z"), F.count(F.lit(1)).alias("n")
        )
    )


_RAW_K = "regexp_extract(props, '\"k\": ([0-9]+)', 1)"

_INT_TEXT = (
    f"CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 7 = 0 THEN {_RAW_K} || '.5' "
    f"WHEN event_id % 11 = 0 THEN 'n/a' WHEN event_id % 5 = 0 THEN ' ' || {_RAW_K} || ' ' ELSE {_RAW_K} END"
)
_DBL_TEXT = (
    f"CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 7 = 0 THEN {_RAW_K} || 'e1' "
    f"WHEN event_id % 11 = 0 THEN 'bad' WHEN event_id % 5 = 0 THEN {_RAW_K} || '.25' ELSE {_RAW_K} END"
)


@query(
    "cast_int",
    f"""
WITH s AS (SELECT event_type, {_INT_TEXT} AS t FROM events),
c AS (SELECT event_type, CASE WHEN regexp_full_match(trim(t), '[+-]?[0-9]+') THEN CAST(trim(t) AS BIGINT) ELSE -1 END AS v FROM s)
SELECT event_type, CAST(sum(v) AS BIGINT) AS total, CAST(sum(CASE WHEN v = -1 THEN 1 ELSE 0 END) AS BIGINT) AS n_default,
       count(*) AS n
FROM c GROUP BY event_type
""",
)
def cast_int(spark, sf):
    ev = load(spark, sf, "events").select("event_type", F.expr(_INT_TEXT).alias("t"))
    c = ev.select("event_type", to_int("t", -1).alias("v"))
    return c.groupBy("event_type").agg(
        F.sum("v").cast("bigint").alias("total"),
        F.sum(F.when(F.col("v") == -1, 1).otherwise(0)).cast("bigint").alias("n_default"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "cast_double",
    f"""
WITH s AS (SELECT event_type, {_DBL_TEXT} AS t FROM events),
c AS (SELECT event_type, coalesce(TRY_CAST(t AS DOUBLE), 0.0) AS v FROM s)
SELECT event_type, round(sum(v), 6) AS total, CAST(sum(CASE WHEN v = 0.0 THEN 1 ELSE 0 END) AS BIGINT) AS n_zero,
       count(*) AS n
FROM c GROUP BY event_type
""",
)
def cast_double(spark, sf):
    ev = load(spark, sf, "events").select("event_type", F.expr(_DBL_TEXT).alias("t"))
    c = ev.select("event_type", to_double("t", 0.0).alias("v"))
    return rounded(
        c.groupBy("event_type").agg(
            F.sum("v").alias("total"),
            F.sum(F.when(F.col("v") == 0.0, 1).otherwise(0)).cast("bigint").alias("n_zero"),
            F.count(F.lit(1)).alias("n"),
        )
    )


_ACCT = "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal END"


@query(
    "split_threshold",
    f"""
WITH c AS (SELECT {_ACCT} AS bal FROM customer)
SELECT 'hi' AS part, count(*) AS n, round(sum(bal), 6) AS total FROM c WHERE bal >= 5000
UNION ALL
SELECT 'lo', count(*), round(sum(bal), 6) FROM c WHERE bal < 5000
""",
)
def split_threshold(spark, sf):
    c = load(spark, sf, "customer").select(F.expr(_ACCT).alias("bal"))
    hi, lo = S.split_threshold(c, "bal", 5000.0)

    def summary(df, tag):
        return df.agg(F.lit(tag).alias("part"), F.count(F.lit(1)).alias("n"), F.sum("bal").alias("total"))

    return rounded(summary(hi, "hi").unionByName(summary(lo, "lo")))


_BUCKET_SQL = "('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT"


@query(
    "split_hash",
    f"""
SELECT CASE WHEN {_BUCKET_SQL} < {int(0.7 * 2**32)} THEN 'train' ELSE 'test' END AS part,
       count(*) AS n, round(sum(value), 6) AS total
FROM events GROUP BY 1
""",
)
def split_hash(spark, sf):
    ev = load(spark, sf, "events")
    a, b = S.split_hash(ev, "event_id", 0.7)
    return rounded(
        a.agg(F.lit("train").alias("part"), F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).unionByName(
            b.agg(F.lit("test").alias("part"), F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        )
    )


@query(
    "sample_hash",
    f"""
SELECT event_type, count(*) AS n FROM events
WHERE ('0x' || substr(md5('7:' || CAST(event_id AS VARCHAR)), 1, 8))::BIGINT < {int(0.2 * 2**32)}
GROUP BY event_type
""",
)
def sample_hash(spark, sf):
    s = S.sample_hash(load(spark, sf, "events"), "event_id", 0.2, seed=7)
    return s.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sample_stratified",
    f"""
SELECT o_orderpriority, count(*) AS n FROM orders
WHERE ('0x' || substr(md5('3:' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT <
      CASE o_orderpriority WHEN '1-URGENT' THEN {int(0.5 * 2**32)} WHEN '2-HIGH' THEN {int(0.25 * 2**32)}
                           ELSE {int(0.1 * 2**32)} END
GROUP BY o_orderpriority
""",
)
def sample_stratified(spark, sf):
    o = load(spark, sf, "orders")
    fr = {"1-URGENT": 0.5, "2-HIGH": 0.25, "3-MEDIUM": 0.1, "4-NOT SPECIFIED": 0.1, "5-LOW": 0.1}
    s = S.sample_stratified(o, "o_orderpriority", fr, key="o_orderkey", seed=3)
    return s.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sample_n",
    """
SELECT o_orderkey, o_totalprice FROM orders
ORDER BY ('0x' || substr(md5('5:' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT, o_orderkey LIMIT 100
""",
)
def sample_n(spark, sf):
    return S.sample_n(load(spark, sf, "orders"), 100, "o_orderkey", seed=5).select("o_orderkey", "o_totalprice")


@query(
    "bins_width",
    """
WITH p AS (SELECT min(c_acctbal) lo, max(c_acctbal) hi FROM customer)
SELECT CAST(least(greatest(floor((c_acctbal - lo) / ((hi - lo) / 10)), 0), 9) AS INTEGER) AS c_acctbal_bin,
       count(*) AS n
FROM customer, p GROUP BY 1
""",
)
def bins_width(spark, sf):
    c = load(spark, sf, "customer")
    out = N.apply_width_bins(c, N.fit_width_bins(c, ["c_acctbal"]), 10)
    return out.groupBy("c_acctbal_bin").agg(F.count(F.lit(1)).alias("n"))


@query(
    "bins_quantile",
    """
WITH r AS (SELECT CAST(ntile(4) OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS INTEGER) AS o_totalprice_bin, o_totalprice FROM orders)
SELECT o_totalprice_bin, count(*) AS n, round(min(o_totalprice), 6) AS lo, round(max(o_totalprice), 6) AS hi
FROM r GROUP BY 1
""",
)
def bins_quantile(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    b = N.equal_frequency_bins(o, "o_totalprice", 4, "o_orderkey")
    return rounded(
        b.groupBy("o_totalprice_bin").agg(
            F.count(F.lit(1)).alias("n"), F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi")
        )
    )


@query(
    "bins_edges",
    """
WITH e AS (SELECT quantile_cont(p_retailprice, [0.2, 0.4, 0.6, 0.8]) AS q FROM part)
SELECT CAST((p_retailprice >= q[1])::INT + (p_retailprice >= q[2])::INT + (p_retailprice >= q[3])::INT
            + (p_retailprice >= q[4])::INT AS INTEGER) AS p_retailprice_bin, count(*) AS n
FROM part, e GROUP BY 1
""",
)
def bins_edges(spark, sf):
    p = load(spark, sf, "part")
    edges = N.quantile_edges(p, "p_retailprice", 5)
    return N.bucketize(p, "p_retailprice", edges).groupBy("p_retailprice_bin").agg(F.count(F.lit(1)).alias("n"))


@query(
    "clip_percentile",
    """
WITH b AS (SELECT quantile_cont(l_extendedprice, 0.05) lo, quantile_cont(l_extendedprice, 0.95) hi FROM lineitem)
SELECT l_returnflag, round(avg(least(greatest(l_extendedprice, lo), hi)), 6) AS l_extendedprice,
       round(max(least(greatest(l_extendedprice, lo), hi)), 6) AS max_price, count(*) AS n
FROM lineitem, b GROUP BY l_returnflag
""",
)
def clip_percentile(spark, sf):
    li = load(spark, sf, "lineitem")
    b = N.fit_clip_bounds(li, ["l_extendedprice"], "percentile", 0.05, 0.95)
    c = N.clip(li, b)
    return rounded(
        c.groupBy("l_returnflag").agg(
            F.avg("l_extendedprice").alias("l_extendedprice"),
            F.max("l_extendedprice").alias("max_price"),
            F.count(F.lit(1)).alias("n"),
        )
    )


@query(
    "clip_sigma",
    """
WITH b AS (SELECT avg(c_acctbal) - 1.5 * stddev_samp(c_acctbal) lo, avg(c_acctbal) + 1.5 * stddev_samp(c_acctbal) hi FROM customer)
SELECT c_mktsegment, round(avg(least(greatest(c_acctbal, lo), hi)), 4) AS c_acctbal,
       CAST(sum(CASE WHEN c_acctbal < lo OR c_acctbal > hi THEN 1 ELSE 0 END) AS BIGINT) AS n_clipped
FROM customer, b GROUP BY c_mktsegment
""",
)
def clip_sigma(spark, sf):
    c = load(spark, sf, "customer")
    # bounds table: one row per column
    b = {r["col"]: (r["lo"], r["hi"]) for r in N.fit_clip_bounds(c, ["c_acctbal"], "sigma", k=1.5).collect()}
    lo, hi = b["c_acctbal"]
    out = N.clip(c.withColumn("_orig", F.col("c_acctbal")), b)
    return out.groupBy("c_mktsegment").agg(
        F.round(F.avg("c_acctbal"), 4).alias("c_acctbal"),
        F.sum(F.when((F.col("_orig") < lo) | (F.col("_orig") > hi), 1).otherwise(0)).cast("bigint").alias("n_clipped"),
    )


@query(
    "feature_scale",
    """
SELECT p_type,
       round(avg(CASE WHEN p_retailprice > 0 THEN ln(p_retailprice) END), 6) AS log_price,
       round(avg(CASE WHEN p_size > -1 THEN ln(1 + p_size) END), 6) AS log1p_size,
       round(avg(CASE WHEN p_size - 25 >= 0 THEN sqrt(p_size - 25) END), 6) AS sqrt_size,
       round(avg(abs(p_size - 25)), 6) AS abs_size,
       CAST(count(CASE WHEN p_size - 25 >= 0 THEN 1 END) AS BIGINT) AS n_sqrt
FROM part GROUP BY p_type
""",
)
def feature_scale(spark, sf):
    p = load(spark, sf, "part")
    centred = F.col("p_size") - 25
    out = p.select(
        "p_type",
        scale_expr("p_retailprice", "log").alias("log_price"),
        scale_expr("p_size", "log1p").alias("log1p_size"),
        scale_expr(centred, "sqrt").alias("sqrt_size"),
        scale_expr(centred, "abs").alias("abs_size"),
    )
    return rounded(
        out.groupBy("p_type").agg(
            F.avg("log_price").alias("log_price"),
            F.avg("log1p_size").alias("log1p_size"),
            F.avg("sqrt_size").alias("sqrt_size"),
            F.avg("abs_size").alias("abs_size"),
            F.count("sqrt_size").alias("n_sqrt"),
        )
    )
