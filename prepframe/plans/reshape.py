"""Relational reshaping, categories, RFM and series queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepframe.operators import categories as C
from prepframe.operators import reshape as R
from prepframe.operators import rfm as M
from prepframe.operators import series as SE
from prepframe.plans.registry import load, query, rounded

# ------------------------------------------------------------------ categories

_CODES_SQL = """
SELECT col, label, row_number() OVER (PARTITION BY col ORDER BY {order}) - 1 AS idx, cnt
FROM (SELECT col, label, count(*) AS cnt FROM ({stack}) s WHERE label IS NOT NULL GROUP BY col, label) c
"""


@query(
    "categories_freq",
    _CODES_SQL.format(
        order="cnt DESC, label",
        stack="SELECT 'c_mktsegment' AS col, c_mktsegment AS label FROM customer "
        "UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer",
    ),
)
def categories_freq(spark, sf):
    return C.fit_categories(load(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"], "frequencyDesc")


@query(
    "categories_alpha",
    _CODES_SQL.format(order="label", stack="SELECT 'p_brand' AS col, p_brand AS label FROM part"),
)
def categories_alpha(spark, sf):
    return C.fit_categories(load(spark, sf, "part"), ["p_brand"], "alphabetAsc")


_PRIO_NEW = "CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_orderpriority || '-new' ELSE o_orderpriority END"


@query(
    "categories_apply",
    f"""
WITH codes AS ({_CODES_SQL.format(order="cnt DESC, label", stack="SELECT 'o_orderpriority' AS col, o_orderpriority AS label FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'")}),
a AS (SELECT {_PRIO_NEW} AS o_orderpriority FROM orders)
SELECT coalesce(codes.idx, -1) AS o_orderpriority, count(*) AS n
FROM a LEFT JOIN codes ON a.o_orderpriority = codes.label GROUP BY 1
""",
)
def categories_apply(spark, sf):
    o = load(spark, sf, "orders")
    codes = C.fit_categories(o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")), ["o_orderpriority"])
    applied = C.apply_categories(o.select(F.expr(_PRIO_NEW).alias("o_orderpriority")), codes, unseen=-1)
    return applied.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "one_hot_vector",
    """
WITH c AS (SELECT CAST(l_partkey AS VARCHAR) AS label, count(*) AS n FROM lineitem GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS INTEGER) AS place, CAST(n AS DOUBLE) AS n FROM c
""",
)
def one_hot_vector(spark, sf):
    # a sparse vector per line with a place for every part; their sum has the count of each part at its code
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    li = load(spark, sf, "lineitem").select("l_partkey")
    v = C.one_hot_vector(li, "l_partkey", C.fit_categories(li, ["l_partkey"]))
    total = v.agg(Summarizer.sum(F.col("l_partkey_vec")).alias("s"))
    return total.select(F.posexplode(vector_to_array("s")).alias("place", "n"))


@query(
    "one_hot",
    f"""
SELECT c_nationkey, {", ".join(f"CAST(sum(CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END) AS BIGINT) AS c_mktsegment_{s}" for s in _SEGMENTS)}
FROM customer GROUP BY c_nationkey
""",
)
def one_hot(spark, sf):
    c = load(spark, sf, "customer")
    codes = C.fit_categories(c, ["c_mktsegment"], "alphabetAsc")
    oh = C.one_hot(c.select("c_nationkey", "c_mktsegment"), "c_mktsegment", codes)
    return oh.groupBy("c_nationkey").agg(*[F.sum(x).cast("bigint").alias(x) for x in oh.columns if x != "c_nationkey"])


@query(
    "frequency_encode",
    """
WITH f AS (SELECT p_brand, count(*) AS cnt FROM part GROUP BY p_brand)
SELECT p_type, round(avg(cnt), 6) AS p_brand_freq, count(*) AS n FROM part JOIN f USING (p_brand) GROUP BY p_type
""",
)
def frequency_encode(spark, sf):
    enc = C.frequency_encode(load(spark, sf, "part"), "p_brand")
    return rounded(enc.groupBy("p_type").agg(F.avg("p_brand_freq").alias("p_brand_freq"), F.count(F.lit(1)).alias("n")))


@query(
    "target_encode",
    """
WITH t AS (SELECT o_orderpriority AS label, CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS y FROM orders),
p AS (SELECT avg(y) AS prior FROM t)
SELECT label, round((sum(y) + 10 * prior) / (count(*) + 10), 6) AS enc FROM t, p GROUP BY label, prior
""",
)
def target_encode(spark, sf):
    o = load(spark, sf, "orders").withColumn("y", F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0))
    enc = C.fit_target_encoding(o, "o_orderpriority", "y", smoothing=10.0)
    return rounded(enc.select("label", "enc"))


# ------------------------------------------------------------------ joins and stacking

@query(
    "join_inner",
    """
SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
GROUP BY n_name
""",
)
def join_inner(spark, sf):
    li, o = load(spark, sf, "lineitem"), load(spark, sf, "orders")
    c, n = load(spark, sf, "customer"), load(spark, sf, "nation")
    o = o.where(
        (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    )
    j = R.join(li, o, {"l_orderkey": "o_orderkey"})
    j = R.join(j, c, {"o_custkey": "c_custkey"})
    j = R.join(j, n, {"c_nationkey": "n_nationkey"})
    return j.groupBy("n_name").agg(
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "join_left",
    """
WITH o AS (SELECT o_custkey, count(*) AS n_orders FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY o_custkey)
SELECT c_mktsegment, CAST(sum(coalesce(n_orders, 0)) AS BIGINT) AS n_orders, CAST(sum(CASE WHEN n_orders IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_without
FROM customer LEFT JOIN o ON c_custkey = o_custkey GROUP BY c_mktsegment
""",
)
def join_left(spark, sf):
    c, o = load(spark, sf, "customer"), load(spark, sf, "orders")
    recent = o.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders")
    )
    j = R.join(c, recent, {"c_custkey": "o_custkey"}, "left")
    return j.groupBy("c_mktsegment").agg(
        F.sum(F.coalesce("n_orders", F.lit(0))).cast("bigint").alias("n_orders"),
        F.sum(F.when(F.col("n_orders").isNull(), 1).otherwise(0)).cast("bigint").alias("n_without"),
    )


_RECENT = "SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'"


@query(
    "join_semi_anti",
    f"""
SELECT 'semi' AS kind, c_mktsegment, count(*) AS n FROM customer WHERE c_custkey IN ({_RECENT}) GROUP BY c_mktsegment
UNION ALL
SELECT 'anti', c_mktsegment, count(*) FROM customer WHERE c_custkey NOT IN ({_RECENT}) GROUP BY c_mktsegment
""",
)
def join_semi_anti(spark, sf):
    c, o = load(spark, sf, "customer"), load(spark, sf, "orders")
    recent = o.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    semi = R.join(c, recent, {"c_custkey": "o_custkey"}, "semi")
    anti = R.join(c, recent, {"c_custkey": "o_custkey"}, "anti")

    def cnt(df, kind):
        return df.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "c_mktsegment", "n")

    return cnt(semi, "semi").unionByName(cnt(anti, "anti"))


@query(
    "join_full",
    """
WITH c AS (SELECT c_nationkey AS nk, count(*) AS n_cust FROM customer WHERE c_acctbal > 9000 GROUP BY 1),
s AS (SELECT s_nationkey AS nk, count(*) AS n_supp FROM supplier WHERE s_acctbal > 5000 GROUP BY 1)
SELECT coalesce(c.nk, s.nk) AS nk, n_cust, n_supp FROM c FULL JOIN s ON c.nk = s.nk
""",
)
def join_full(spark, sf):
    c = load(spark, sf, "customer").where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nk")).agg(
        F.count(F.lit(1)).alias("n_cust")
    )
    s = load(spark, sf, "supplier").where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nk")).agg(
        F.count(F.lit(1)).alias("n_supp")
    )
    return R.merge_columns(c, s, "nk")


@query(
    "merge_rows",
    """
WITH u AS (SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
           UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier)
SELECT nationkey, count(*) AS n, count(segment) AS n_segment, round(sum(acctbal), 2) AS acctbal FROM u GROUP BY nationkey
""",
)
def merge_rows(spark, sf):
    c = load(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    s = load(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal")
    )
    u = R.merge_rows(c, s)
    return u.groupBy("nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.count("segment").alias("n_segment"), F.round(F.sum("acctbal"), 2).alias("acctbal")
    )


# ------------------------------------------------------------------ columns

@query(
    "select_rename",
    """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer WHERE c_acctbal > 9500
""",
)
def select_rename(spark, sf):
    c = load(spark, sf, "customer")
    c = R.select_columns(c, drop=["c_nationkey", "c_mktsegment"])
    c = R.rename(c, {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance"})
    return c.where(F.col("balance") > 9500)


@query(
    "add_column",
    """
SELECT o_orderpriority, round(avg(o_totalprice * 1.1 + CASE WHEN o_orderstatus = 'F' THEN 10 ELSE 0 END), 6) AS adj,
       count(*) AS n
FROM orders GROUP BY o_orderpriority
""",
)
def add_column(spark, sf):
    o = R.add_column(load(spark, sf, "orders"), "adj", "o_totalprice * 1.1 + CASE WHEN o_orderstatus = 'F' THEN 10 ELSE 0 END")
    return rounded(o.groupBy("o_orderpriority").agg(F.avg("adj").alias("adj"), F.count(F.lit(1)).alias("n")))


@query(
    "replace_values",
    """
SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus,
       CASE o_orderpriority WHEN '5-LOW' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS o_orderpriority,
       count(*) AS n
FROM orders GROUP BY 1, 2
""",
)
def replace_values(spark, sf):
    o = load(spark, sf, "orders").select("o_orderstatus", "o_orderpriority")
    o = R.replace_values(
        o, {"o_orderstatus": {"F": "finished", "O": "open"}, "o_orderpriority": {"5-LOW": "4-NOT SPECIFIED"}}
    )
    return o.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "replace_regex",
    """
SELECT regexp_replace(p_type, '^(SMALL|MEDIUM|LARGE)$', 'SIZED') AS p_type, count(*) AS n FROM part GROUP BY 1
""",
)
def replace_regex(spark, sf):
    p = R.replace_regex(load(spark, sf, "part").select("p_type"), "p_type", "^(SMALL|MEDIUM|LARGE)$", "SIZED")
    return p.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ group by

@query(
    "group_by",
    """
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 6) AS total,
       round(avg(value), 6) AS mean, min(value) AS lo, max(value) AS hi,
       round(stddev_samp(value), 6) AS sd, round(var_samp(value), 4) AS var,
       round(quantile_cont(value, 0.5), 6) AS med,
       arg_min(value, ts) AS first_value, arg_max(value, ts) AS last_value
FROM events GROUP BY event_type
""",
)
def group_by(spark, sf):
    ev = load(spark, sf, "events")
    g = R.group_by(
        ev,
        ["event_type"],
        {
            "n": ("count", "*"), "users": ("count_distinct", "user_id"), "total": ("sum", "value"),
            "mean": ("avg", "value"), "lo": ("min", "value"), "hi": ("max", "value"), "sd": ("stddev", "value"),
            "var": ("variance", "value"), "med": ("median", "value"),
            "first_value": ("first", "value", "ts"), "last_value": ("last", "value", "ts"),
        },
    )
    return g.select(
        "event_type", "n", "users", F.round("total", 6).alias("total"), F.round("mean", 6).alias("mean"), "lo", "hi",
        F.round("sd", 6).alias("sd"), F.round("var", 4).alias("var"), F.round("med", 6).alias("med"),
        "first_value", "last_value",
    )


# ------------------------------------------------------------------ reshape

@query(
    "transpose",
    """
WITH s AS (SELECT c_mktsegment, CAST(count(*) AS DOUBLE) AS n, round(avg(c_acctbal), 6) AS avg_bal FROM customer GROUP BY 1)
SELECT 'n' AS key, {cols_n} FROM s
UNION ALL SELECT 'avg_bal', {cols_b} FROM s
""".format(
        cols_n=", ".join(f"max(CASE WHEN c_mktsegment = '{s}' THEN n END) AS {s}" for s in _SEGMENTS),
        cols_b=", ".join(f"max(CASE WHEN c_mktsegment = '{s}' THEN avg_bal END) AS {s}" for s in _SEGMENTS),
    ),
)
def transpose(spark, sf):
    s = load(spark, sf, "customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.round(F.avg("c_acctbal"), 6).alias("avg_bal")
    )
    return R.transpose(s, "c_mktsegment")


@query(
    "table_to_kv",
    """
WITH kv AS (SELECT p_partkey, 'p_size' AS k, CAST(p_size AS DOUBLE) AS v FROM part
            UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part)
SELECT k, count(*) AS n, round(sum(v), 4) AS total FROM kv GROUP BY k
""",
)
def table_to_kv(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    kv = R.table_to_kv(p, ["p_partkey"], ["p_size", "p_retailprice"])
    return kv.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("v"), 4).alias("total"))


_KV = """
SELECT p_partkey, 'p_size' AS k, CAST(p_size AS DOUBLE) AS v FROM part WHERE p_retailprice < 970
UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part
"""


@query(
    "kv_to_table",
    f"""
WITH kv AS ({_KV}),
w AS (SELECT p_partkey, max(CASE WHEN k = 'p_size' THEN v END) AS p_size, max(CASE WHEN k = 'p_retailprice' THEN v END) AS p_retailprice
      FROM kv GROUP BY p_partkey)
SELECT count(*) AS n, count(p_size) AS n_size, round(sum(p_size), 4) AS size_total, round(sum(p_retailprice), 4) AS price_total FROM w
""",
)
def kv_to_table(spark, sf):
    # long input with some (id, key) pairs absent: those cells come back null
    p = load(spark, sf, "part")
    # sizes are not recorded for the dearest parts: those (id, key) pairs are absent
    kv = p.where(F.col("p_retailprice") < 970).select("p_partkey", F.lit("p_size").alias("k"), F.col("p_size").cast("double").alias("v"))
    kv = kv.unionByName(p.select("p_partkey", F.lit("p_retailprice").alias("k"), F.col("p_retailprice").alias("v")))
    w = R.kv_to_table(kv, ["p_partkey"], "k", "v", ["p_size", "p_retailprice"])
    return w.agg(
        F.count(F.lit(1)).alias("n"), F.count("p_size").alias("n_size"),
        F.round(F.sum("p_size"), 4).alias("size_total"), F.round(F.sum("p_retailprice"), 4).alias("price_total"),
    )


_NULL_BAL = "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal END"


@query(
    "fill_missing",
    f"""
WITH c AS (SELECT c_mktsegment, {_NULL_BAL} AS bal FROM customer),
g AS (SELECT c_mktsegment, avg(bal) AS gmean FROM c GROUP BY 1),
m AS (SELECT quantile_cont(bal, 0.5) AS med FROM c)
SELECT c.c_mktsegment, round(sum(coalesce(bal, gmean)), 4) AS by_group_mean, round(sum(coalesce(bal, med)), 4) AS by_median,
       count(*) AS n, count(bal) AS n_present
FROM c JOIN g ON c.c_mktsegment = g.c_mktsegment, m GROUP BY c.c_mktsegment
""",
)
def fill_missing(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.expr(_NULL_BAL).alias("bal"))
    by_group = R.handle_missing(c, ["bal"], "mean", group_by=["c_mktsegment"]).withColumnRenamed("bal", "by_group_mean")
    by_median = R.handle_missing(c, ["bal"], "median").select("c_custkey", F.col("bal").alias("by_median"))
    j = by_group.join(by_median, "c_custkey").join(c.select("c_custkey", "bal"), "c_custkey")
    return j.groupBy("c_mktsegment").agg(
        F.round(F.sum("by_group_mean"), 4).alias("by_group_mean"), F.round(F.sum("by_median"), 4).alias("by_median"),
        F.count(F.lit(1)).alias("n"), F.count("bal").alias("n_present"),
    )


@query(
    "drop_missing",
    f"""
SELECT c_mktsegment, count(*) AS n FROM customer WHERE ({_NULL_BAL}) IS NOT NULL GROUP BY 1
""",
)
def drop_missing(spark, sf):
    c = load(spark, sf, "customer").select("c_mktsegment", F.expr(_NULL_BAL).alias("bal"))
    return R.handle_missing(c, ["bal"], "drop").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fill_mode",
    """
WITH c AS (SELECT c_nationkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer),
f AS (SELECT c_nationkey, seg, count(*) AS k FROM c WHERE seg IS NOT NULL GROUP BY 1, 2),
m AS (SELECT c_nationkey, arg_min(seg, (-k, seg)) AS mode FROM f GROUP BY 1)
SELECT c.c_nationkey, coalesce(seg, mode) AS seg, count(*) AS n FROM c JOIN m ON c.c_nationkey = m.c_nationkey GROUP BY 1, 2
""",
)
def fill_mode(spark, sf):
    c = load(spark, sf, "customer").select(
        "c_nationkey", F.expr("CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END").alias("seg")
    )
    f = R.handle_missing(c, ["seg"], "mode", group_by=["c_nationkey"])
    return f.groupBy("c_nationkey", "seg").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ ids, dedupe, sort

@query(
    "add_id",
    """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS id FROM orders
""",
)
def add_id(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return R.add_id(o, "id", [("o_totalprice", False), "o_orderkey"]).select("o_orderkey", "id")


@query(
    "dedupe_first",
    """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) t
WHERE rn = 1
""",
)
def dedupe_first(spark, sf):
    o = load(spark, sf, "orders")
    d = R.drop_duplicates(o, ["o_custkey"], order_by=["o_orderdate"])
    return d.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query(
    "dedupe_rows",
    """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem) d
GROUP BY 1, 2
""",
)
def dedupe_rows(spark, sf):
    d = R.drop_duplicates(load(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))
    return d.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sort_topk",
    """
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""",
)
def sort_topk(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return R.sort_values(o, ["o_totalprice", "o_orderkey"], [False, True], top_k=20)


# ------------------------------------------------------------------ RFM

_RFM_SQL = """
SELECT o_custkey, CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-09-01') AS INTEGER) AS recency,
       count(*) AS frequency, round(sum(o_totalprice), 4) AS monetary
FROM orders GROUP BY o_custkey
"""


def _rfm(spark, sf):
    return M.rfm_process(load(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_totalprice", as_of="2001-09-01")


@query("rfm_process", _RFM_SQL)
def rfm_process(spark, sf):
    return _rfm(spark, sf).withColumn("monetary", F.round("monetary", 4))


@query(
    "rfm_scores",
    f"""
WITH r AS ({_RFM_SQL}),
s AS (SELECT o_custkey,
             CAST(ntile(5) OVER (ORDER BY recency DESC, o_custkey) AS INTEGER) AS r_score,
             CAST(ntile(5) OVER (ORDER BY frequency, o_custkey) AS INTEGER) AS f_score,
             CAST(ntile(5) OVER (ORDER BY monetary, o_custkey) AS INTEGER) AS m_score FROM r)
SELECT o_custkey, r_score, f_score, m_score, CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_code,
       CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'champion' WHEN r_score >= 4 AND f_score <= 2 THEN 'new'
            WHEN r_score <= 2 AND f_score >= 4 THEN 'at_risk' WHEN r_score <= 2 AND f_score <= 2 THEN 'lost'
            ELSE 'regular' END AS segment
FROM s
""",
)
def rfm_scores(spark, sf):
    r = _rfm(spark, sf).withColumn("monetary", F.round("monetary", 4))
    s = M.rfm_scores(r, "o_custkey")
    return s.select("o_custkey", "r_score", "f_score", "m_score", "rfm_code", "segment")


# ------------------------------------------------------------------ series filters

@query(
    "fir_filter",
    """
SELECT event_id, round(0.5 * value + 0.3 * coalesce(lag(value, 1) OVER w, 0) + 0.2 * coalesce(lag(value, 2) OVER w, 0), 6) AS fir
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""",
)
def fir_filter(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = SE.fir_filter(ev, "user_id", ["ts", "event_id"], "value", [0.5, 0.3, 0.2])
    return rounded(out.select("event_id", "fir"))


@query(
    "median_filter",
    """
SELECT event_id, round(quantile_cont(value, 0.5) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                       ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS median
FROM events
""",
)
def median_filter(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = SE.median_filter(ev, "user_id", ["ts", "event_id"], "value", 2)
    return rounded(out.select("event_id", "median"))


@query(
    "iir_filter",
    """
WITH RECURSIVE s AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r AS (SELECT user_id, rn, event_id, 0.4 * value AS y FROM s WHERE rn = 1
      UNION ALL
      SELECT s.user_id, s.rn, s.event_id, 0.4 * s.value + 0.6 * r.y FROM r JOIN s ON s.user_id = r.user_id AND s.rn = r.rn + 1)
SELECT event_id, round(y, 6) AS iir FROM r
""",
)
def iir_filter(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = SE.iir_filter(ev, "user_id", ["ts", "event_id"], "value", b=[0.4], a=[1.0, -0.6])
    return rounded(out.select("event_id", "iir"))
