"""Source/sink queries: data written by Spark and read back through each reader.

Scratch output goes under the session's checkpoint folder (a shared folder on a
cluster), never a machine-local temp folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from prepframe._session import checkpoint_dir
from prepframe.operators import filters as FL
from prepframe.operators import split as S
from prepframe.plans.registry import load, query, rounded
from prepframe.sources import io as IO


def _scratch(spark, name: str) -> str:
    base = checkpoint_dir(spark)
    return os.path.join(base, "io", f"{name}-{uuid.uuid4().hex[:8]}")


_ORDERS_AGG_SQL = """
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 4) AS total, min(o_orderdate) AS first_date
FROM orders GROUP BY o_orderpriority
"""


def _orders_agg(df):
    return df.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 4).alias("total"), F.min("o_orderdate").alias("first_date")
    )


@query("csv_roundtrip", _ORDERS_AGG_SQL)
def csv_roundtrip(spark, sf):
    o = load(spark, sf, "orders")
    path = _scratch(spark, "orders-csv")
    IO.write_csv(o, path, mode="overwrite")
    back = IO.read_csv(spark, path, schema=o.schema)
    return _orders_agg(back)


@query("parquet_roundtrip", _ORDERS_AGG_SQL)
def parquet_roundtrip(spark, sf):
    o = load(spark, sf, "orders")
    path = _scratch(spark, "orders-parquet")
    IO.write_parquet(o, path, partition_by="o_orderpriority")
    return _orders_agg(IO.read_parquet(spark, path))


@query("json_roundtrip", _ORDERS_AGG_SQL)
def json_roundtrip(spark, sf):
    o = load(spark, sf, "orders")
    path = _scratch(spark, "orders-json")
    o.write.mode("overwrite").json(path)
    return _orders_agg(IO.read_json(spark, path, schema=o.schema))


@query(
    "csv_malformed",
    """
SELECT count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer WHERE c_custkey % 10 <> 0
""",
)
def csv_malformed(spark, sf):
    # every tenth row gets a non-numeric balance: those rows are dropped, consistently for every action
    c = load(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 10 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal")
    )
    path = _scratch(spark, "customer-csv")
    IO.write_csv(c, path, mode="overwrite")
    back = IO.read_csv(spark, path, schema="c_custkey bigint, c_acctbal double")
    return back.agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").cast("bigint").alias("keys"))


@query(
    "threshold_filter",
    """
SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem
WHERE l_discount BETWEEN 0.02 AND 0.05 GROUP BY l_returnflag
""",
)
def threshold_filter(spark, sf):
    li = FL.threshold_filter(load(spark, sf, "lineitem"), "l_discount", 0.02, 0.05)
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query(
    "user_filter",
    """
SELECT o_orderstatus, count(*) AS n FROM orders
WHERE o_totalprice > 100000 AND o_orderpriority LIKE '1%' GROUP BY o_orderstatus
""",
)
def user_filter(spark, sf):
    o = FL.user_filter(load(spark, sf, "orders"), "o_totalprice > 100000 AND o_orderpriority LIKE '1%'")
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("split_ratio")
def split_ratio(spark, sf):
    ev = load(spark, sf, "events")
    a, b = S.split_ratio(ev, 0.7, seed=11)
    return a.agg(F.lit("train").alias("part"), F.count(F.lit(1)).alias("n")).unionByName(
        b.agg(F.lit("test").alias("part"), F.count(F.lit(1)).alias("n"))
    )


_PROPS = "regexp_extract(props, '\"k\": ([0-9]+)', 1)"


@query(
    "type_transform",
    f"""
WITH t AS (SELECT event_type,
                  CASE WHEN event_id % 9 = 0 THEN 'x' ELSE {_PROPS} END AS k_text,
                  CASE WHEN event_id % 6 = 0 THEN 'bad' ELSE CAST(value AS VARCHAR) END AS v_text FROM events),
c AS (SELECT event_type,
             CASE WHEN regexp_full_match(trim(k_text), '[+-]?[0-9]+') THEN CAST(trim(k_text) AS BIGINT) ELSE -1 END AS k,
             coalesce(TRY_CAST(v_text AS DOUBLE), 0.0) AS v FROM t),
codes AS (SELECT event_type AS label, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS idx FROM c GROUP BY event_type)
SELECT codes.idx AS event_type, CAST(sum(k) AS BIGINT) AS k, round(sum(v), 4) AS v, count(*) AS n
FROM c JOIN codes ON c.event_type = codes.label GROUP BY codes.idx
""",
)
def type_transform(spark, sf):
    ev = load(spark, sf, "events").select(
        "event_type",
        F.expr(f"CASE WHEN event_id % 9 = 0 THEN 'x' ELSE {_PROPS} END").alias("k"),
        F.expr("CASE WHEN event_id % 6 = 0 THEN 'bad' ELSE CAST(value AS STRING) END").alias("v"),
    )
    out, _ = FL.type_transform(ev, ["k"], ["v"], ["event_type"], default_int=-1, default_double=0.0)
    return out.groupBy("event_type").agg(
        F.sum("k").cast("bigint").alias("k"), F.round(F.sum("v"), 4).alias("v"), F.count(F.lit(1)).alias("n")
    )


@query(
    "add_id_fast",
    """
SELECT count(*) AS n, count(*) AS n_distinct FROM orders
""",
)
def add_id_fast(spark, sf):
    from prepframe.operators.reshape import add_id

    # unique (not dense) ids without any ordering work: distinct count equals row count
    ids = add_id(load(spark, sf, "orders"), "id")
    return ids.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_distinct"))


@query("sample_fraction")
def sample_fraction(spark, sf):
    s = S.sample_fraction(load(spark, sf, "lineitem"), 0.1, seed=5)
    return s.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
