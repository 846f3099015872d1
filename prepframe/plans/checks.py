"""Closed forms and invariants of learners, splits, samples and stores, each with a SQL twin.

Where an optimiser has a closed form (least squares, group means of a Poisson model, two
columns of PCA, SVD or discriminants) the twin computes it; for the other learners the row
states what must hold for any fit: no row lost, probabilities that sum to 1, better than
always answering the most frequent class.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from prepframe._session import checkpoint_dir, cut_lineage
from prepframe.operators import categories as CA
from prepframe.operators import features as FE
from prepframe.operators import models as MO
from prepframe.operators import split as S
from prepframe.plans.models import TEXT_FEATURES, _price_data, _quality
from prepframe.plans.registry import load, query
from prepframe.sources import io as IO


@query(
    "table_life_cycle",
    """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_totalprice > 1000 GROUP BY o_orderstatus
""",
)
def table_life_cycle(spark, sf):
    # file -> table, read, overwrite of the table that is read, read again
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    name = f"prepframe_orders_{uuid.uuid4().hex[:10]}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}.csv"
    IO.write_csv(o, path)
    t = IO.file_to_table(spark, "csv", path, name, schema="o_orderkey bigint, o_orderstatus string, o_totalprice double")
    IO.write_table(t.where("o_totalprice > 1000"), name)
    out = IO.read_table(spark, name).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    out = cut_lineage(out)  # the table goes away below
    spark.sql(f"DROP TABLE {name}")
    return out


@query(
    "model_reload",
    """
SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_null, round(avg(l_extendedprice), 2) AS mean_prediction FROM lineitem
""",
)
def model_reload(spark, sf):
    # train, write, read in a fresh object, score: least squares keeps the mean
    li = load(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    m = MO.fit(li, ["l_quantity"], "l_extendedprice", MO.make_estimator("regression", "linear_regression", solver="normal"), "regression")
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    m.save(path)
    scored = MO.score(MO.FittedModel.load(spark, path), li)
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction").isNull()).alias("n_null"), F.round(F.avg("prediction"), 2).alias("mean_prediction")
    )


@query(
    "target_encode_apply",
    """
WITH p AS (SELECT avg(o_totalprice) AS prior FROM orders),
e AS (SELECT o_orderpriority AS k, (sum(o_totalprice) + 10.0 * max(prior)) / (count(*) + 10.0) AS enc FROM orders, p GROUP BY 1)
SELECT o_orderstatus, count(*) AS n, round(avg(coalesce(enc, prior)), 4) AS enc
FROM orders LEFT JOIN e ON (CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END) = k, p GROUP BY o_orderstatus
""",
)
def target_encode_apply(spark, sf):
    o = load(spark, sf, "orders")
    enc = CA.fit_target_encoding(o, "o_orderpriority", "o_totalprice", 10.0)
    new = o.withColumn("o_orderpriority", F.expr("CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END"))
    new = CA.apply_target_encoding(new, "o_orderpriority", enc, "enc")
    # a missing label takes the prior
    return new.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("enc"), 4).alias("enc"))


@query(
    "glm_poisson_groups",
    """
WITH c AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS g FROM customer),
n AS (SELECT o_custkey, count(*) AS k FROM orders GROUP BY o_custkey)
SELECT CAST(g AS INTEGER) AS g, count(*) AS customers, round(avg(coalesce(k, 0)), 3) AS prediction
FROM c LEFT JOIN n ON c_custkey = o_custkey GROUP BY g
""",
)
def glm_poisson_groups(spark, sf):
    # a Poisson model of one 0/1 feature predicts the group means
    o, c = load(spark, sf, "orders"), load(spark, sf, "customer")
    per = o.groupBy("o_custkey").agg(F.count(F.lit(1)).cast("double").alias("k"))
    data = c.join(per, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.when(F.col("c_mktsegment") == "BUILDING", 1.0).otherwise(0.0).alias("x"), F.coalesce("k", F.lit(0.0)).alias("k")
    )
    m = MO.fit(data, ["x"], "k", MO.make_estimator("regression", "glm", family="poisson", link="log", maxIter=100), "regression")
    return MO.score(m, data).groupBy(F.col("x").cast("int").alias("g")).agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.avg("prediction"), 3).alias("prediction")
    )


_TWO = ["l_quantity", "l_tax"]


@query(
    "pca_two_columns",
    """
WITH s AS (SELECT var_samp(l_quantity) AS a, var_samp(l_tax) AS c, covar_samp(l_quantity, l_tax) AS b FROM lineitem),
r AS (SELECT (a + c) / 2 AS m, sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS d FROM s)
SELECT CAST(0 AS INTEGER) AS component, round(m + d, 6) AS value FROM r UNION ALL SELECT 1, round(m - d, 6) FROM r
""",
)
def pca_two_columns(spark, sf):
    t = FE.fit_pca(load(spark, sf, "lineitem"), _TWO, 2).table(spark)
    return t.groupBy("component").agg(F.round(F.max("value"), 6).alias("value"))


@query(
    "svd_two_columns",
    """
WITH s AS (SELECT sum(l_quantity * l_quantity) AS a, sum(l_tax * l_tax) AS c, sum(l_quantity * l_tax) AS b FROM lineitem),
r AS (SELECT (a + c) / 2 AS m, sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS d FROM s)
SELECT CAST(0 AS INTEGER) AS component, round(sqrt(m + d), 4) AS value FROM r UNION ALL SELECT 1, round(sqrt(m - d), 4) FROM r
""",
)
def svd_two_columns(spark, sf):
    t = FE.fit_svd(load(spark, sf, "lineitem"), _TWO, 2).table(spark)
    return t.groupBy("component").agg(F.round(F.max("value"), 4).alias("value"))


@query(
    "flda_two_classes",
    """
WITH x AS (SELECT CASE WHEN l_linenumber > 3 THEN 1 ELSE 0 END AS y, l_quantity + 3 * (l_linenumber > 3)::INT AS u, l_tax * 100 AS v FROM lineitem),
g AS (SELECT y, avg(u) AS mu, avg(v) AS mv, count(*) * var_pop(u) AS suu, count(*) * var_pop(v) AS svv, count(*) * covar_pop(u, v) AS suv FROM x GROUP BY y),
w AS (SELECT sum(suu) AS a, sum(svv) AS c, sum(suv) AS b, max(mu) FILTER (y = 1) - max(mu) FILTER (y = 0) AS du,
             max(mv) FILTER (y = 1) - max(mv) FILTER (y = 0) AS dv FROM g),
d AS (SELECT (c * du - b * dv) AS p, (a * dv - b * du) AS q FROM w),
n AS (SELECT p / sqrt(p * p + q * q) AS p, q / sqrt(p * p + q * q) AS q FROM d),
f AS (SELECT p * CASE WHEN (CASE WHEN abs(p) >= abs(q) THEN p ELSE q END) < 0 THEN -1 ELSE 1 END AS p,
             q * CASE WHEN (CASE WHEN abs(p) >= abs(q) THEN p ELSE q END) < 0 THEN -1 ELSE 1 END AS q FROM n)
SELECT 'u' AS feature, round(p, 5) AS loading FROM f UNION ALL SELECT 'v', round(q, 5) FROM f
""",
)
def flda_two_classes(spark, sf):
    late = (F.col("l_linenumber") > 3).cast("int")
    x = load(spark, sf, "lineitem").select(late.alias("y"), (F.col("l_quantity") + 3 * late).alias("u"), (F.col("l_tax") * 100).alias("v"))
    t = FE.fit_flda(x, ["u", "v"], "y", 1).table(spark)
    return t.select("feature", F.round("loading", 5).alias("loading"))


@query(
    "linear_importance_one",
    """
SELECT 'l_quantity' AS feature, round(abs(regr_slope(l_extendedprice, l_quantity)) * stddev_samp(l_quantity), 2) AS importance FROM lineitem
""",
)
def linear_importance_one(spark, sf):
    t = FE.linear_importance(load(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice")
    return t.select("feature", F.round("importance", 2).alias("importance"))


_ALGOS = {
    "random_forest": dict(treeNum=10, maxDepth=5), "decision_tree": dict(maxDepth=4), "gbdt": dict(maxIter=5, maxDepth=3),
    "logistic_regression": dict(maxIter=30), "svm": dict(maxIter=30), "mlp": dict(layers=[len(TEXT_FEATURES), 8, 2], maxIter=60),
    "naive_bayes": dict(modelType="gaussian"),
}


@query(
    "classifier_invariants",
    "WITH n AS (SELECT count(*) AS n FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL) "
    + " UNION ALL ".join(f"SELECT '{a}' AS algo, n, CAST(0 AS BIGINT) AS bad_probability, true AS useful FROM n" for a in _ALGOS),
)
def classifier_invariants(spark, sf):
    data = _quality(spark, sf).where("quality IS NOT NULL")
    rows = None
    for algo, params in _ALGOS.items():
        m = MO.fit(data, TEXT_FEATURES, "quality", MO.make_estimator("binary", algo, **params), "binary")
        s = MO.score(m, data)
        both = [c for c in MO.prob_names(m.labels) if c in s.columns]
        off = F.abs(sum((F.col(c) for c in both), F.lit(0.0)) - 1.0) > 1e-6 if both else F.lit(False)
        hit = (F.col("prediction") == F.col("quality")).cast("double")
        # the mean of both classes' recalls: a constant answer has one half
        recalls = [F.avg(F.when(F.col("quality") == F.lit(v), hit)) for v in m.labels]
        one = s.agg(F.lit(algo).alias("algo"), F.count(F.lit(1)).alias("n"), F.count_if(off).alias("bad_probability"), (sum(recalls, F.lit(0.0)) / len(recalls) > 0.75).alias("useful"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


_SIZES = "CASE WHEN l_quantity <= 16 THEN 'low' WHEN l_quantity <= 33 THEN 'mid' ELSE 'top' END"


@query(
    "multiclass_invariants",
    f"""
WITH c AS (SELECT count(*) AS n, count(DISTINCT {_SIZES}) AS classes FROM lineitem)
SELECT algo, n, classes, CAST(0 AS BIGINT) AS bad_probability, true AS learnt FROM c, (VALUES ('random_forest'), ('decision_tree'), ('gbdt')) a(algo)
""",
)
def multiclass_invariants(spark, sf):
    # three classes cut out of one feature: trees learn them but for the rows at the bin borders
    data = load(spark, sf, "lineitem").select("l_quantity", "l_tax", F.expr(_SIZES).alias("size"))
    rows = None
    for algo, params in (("random_forest", dict(treeNum=5, maxDepth=4)), ("decision_tree", dict(maxDepth=4)), ("gbdt", dict(maxIter=3, maxDepth=3))):
        m = MO.fit(data, ["l_quantity", "l_tax"], "size", MO.make_estimator("multiclass", algo, **params), "multiclass")
        s = MO.score(m, data)
        shares = [F.col(c) for c in MO.prob_names(m.labels) if c in s.columns]
        off = F.abs(sum(shares, F.lit(0.0)) - 1.0) > 1e-6 if shares else F.lit(False)
        one = s.agg(
            F.lit(algo).alias("algo"), F.count(F.lit(1)).alias("n"), F.count_distinct("prediction").alias("classes"),
            F.count_if(off).alias("bad_probability"), (F.avg((F.col("prediction") == F.col("size")).cast("double")) > 0.95).alias("learnt"),
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query(
    "regressor_invariants",
    "WITH n AS (SELECT count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey) "
    "SELECT 'random_forest' AS algo, n, true AS useful FROM n UNION ALL SELECT 'gbdt', n, true FROM n",
)
def regressor_invariants(spark, sf):
    # the price of a line at list price is the product of two of the three features
    feats, y = ["l_quantity", "p_retailprice", "l_discount"], "list_price"
    data = cut_lineage(_price_data(spark, sf).select(*feats, (F.col("l_quantity") * F.col("p_retailprice")).alias(y)))
    rows = None
    for algo, params in (("random_forest", dict(treeNum=5, maxDepth=5)), ("gbdt", dict(maxIter=5, maxDepth=4))):
        s = MO.score(MO.fit(data, feats, y, MO.make_estimator("regression", algo, **params), "regression"), data)
        sse = F.sum((F.col(y) - F.col("prediction")) * (F.col(y) - F.col("prediction")))
        one = s.agg(F.lit(algo).alias("algo"), F.count("prediction").alias("n"), (sse < 0.2 * F.var_pop(y) * F.count(F.lit(1))).alias("useful"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query(
    "forest_importance_split",
    "SELECT 'l_quantity' AS feature, 1.0::DOUBLE AS importance UNION ALL SELECT 'l_tax', 0.0::DOUBLE",
)
def forest_importance_split(spark, sf):
    # a forest of single splits whose label hangs on one feature: all importance lies there
    data = cut_lineage(load(spark, sf, "lineitem").select("l_quantity", "l_tax", (F.col("l_quantity") > 25).cast("int").alias("y")))
    m = MO.fit(data, ["l_quantity", "l_tax"], "y", MO.make_estimator("binary", "random_forest", treeNum=7, maxDepth=1), "binary")
    return FE.forest_importance(m.pipeline, ["l_quantity", "l_tax"], spark).withColumn("importance", F.round("importance", 6))


@query(
    "tune_least_squares",
    """
SELECT 'linear_regression' AS algo, p AS params, r AS rung, b AS chosen, b AS exact
FROM (VALUES ('[(''regParam'', 0.0)]', 2, true), ('[(''regParam'', 0.5)]', 2, false), ('[(''regParam'', 5.0)]', 1, false), ('[(''regParam'', 50.0)]', 1, false)) t(p, r, b)
""",
)
def tune_least_squares(spark, sf):
    # least squares of an exact linear target: no shrinkage wins, more of it loses earlier
    data = load(spark, sf, "lineitem").select(
        "l_quantity", "l_tax", (3 * F.col("l_quantity") - 200 * F.col("l_tax") + 7).alias("y"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("k"),
    )
    grid = [("linear_regression", dict(regParam=r)) for r in (50.0, 0.0, 5.0, 0.5)]
    table, best = MO.tune(data, ["l_quantity", "l_tax"], "y", "regression", grid, "k", "rmse", higher_is_better=False, halving=2)
    chosen = F.col("params") == F.lit(best.extra["params"])
    return table.select("algo", "params", "rung", chosen.alias("chosen"), (F.col("rmse") < 1e-6).alias("exact"))


@query(
    "kmeans_invariants",
    "SELECT count(*) AS n, CAST(0 AS BIGINT) AS not_nearest, CAST(6 AS BIGINT) AS clusters FROM embeddings",
)
def kmeans_invariants(spark, sf):
    emb = load(spark, sf, "embeddings")
    m = MO.fit_kmeans(emb, "embedding", K=6, max_iter=10)
    a = MO.assign_clusters(m, emb).withColumnRenamed("prediction", "said")
    both = MO.assign_to_centres(a, "embedding", MO.centres_table(m, spark))
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("said") != F.col("prediction")).alias("not_nearest"), F.count_distinct("said").alias("clusters")
    )


@query(
    "split_ratio_invariants",
    "SELECT count(*) AS n, CAST(0 AS BIGINT) AS in_both, true AS near_ratio FROM events",
)
def split_ratio_invariants(spark, sf):
    ev = load(spark, sf, "events").select("event_id")
    a, b = S.split_ratio(ev, 0.7, seed=11)
    all_rows = a.withColumn("t", F.lit(1)).unionByName(b.withColumn("t", F.lit(0)))
    per = all_rows.groupBy("event_id").agg(F.count(F.lit(1)).alias("k"), F.max("t").alias("t"))
    return per.agg(
        F.sum("k").cast("bigint").alias("n"), F.count_if(F.col("k") > 1).alias("in_both"), (F.abs(F.avg("t") - 0.7) < 0.05).alias("near_ratio")
    )


@query(
    "sample_fraction_invariants",
    "SELECT CAST(0 AS BIGINT) AS strangers, true AS near_fraction, count(*) AS n_all FROM events",
)
def sample_fraction_invariants(spark, sf):
    ev = load(spark, sf, "events").select("event_id")
    s = S.sample_fraction(ev, 0.1, seed=5).withColumn("s", F.lit(1))
    j = ev.withColumn("a", F.lit(1)).join(s, "event_id", "full")
    return j.agg(
        F.count_if(F.col("a").isNull()).alias("strangers"), (F.abs(F.count("s") / F.count("a") - 0.1) < 0.02).alias("near_fraction"), F.count("a").alias("n_all")
    )


@query(
    "cross_validate_invariants",
    "SELECT CAST(3 AS BIGINT) AS folds, count(*) AS tested, true AS useful FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL",
)
def cross_validate_invariants(spark, sf):
    data = _quality(spark, sf).where("quality IS NOT NULL")
    res = MO.cross_validate(data, TEXT_FEATURES, "quality", lambda: MO.make_estimator("binary", "logistic_regression", maxIter=20), "binary", "doc_id", k=3)
    return res.agg(
        F.count_distinct("fold").alias("folds"), F.sum(F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).cast("bigint").alias("tested"),
        (F.min("auc") > 0.6).alias("useful"),
    )


@query(
    "als_invariants",
    "SELECT 3 * count(DISTINCT o_custkey) AS n, CAST(3 AS INTEGER) AS most, CAST(0 AS BIGINT) AS unknown_items "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey",
)
def als_invariants(spark, sf):
    o, li, p = load(spark, sf, "orders"), load(spark, sf, "lineitem"), load(spark, sf, "part")
    brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    r = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    r = r.groupBy(F.col("o_custkey").cast("int").alias("user"), brand.alias("item")).agg(F.count(F.lit(1)).cast("float").alias("rating"))
    r = cut_lineage(r)
    rec = MO.recommend(MO.fit_als(r, "user", "item", "rating", rank=4, implicit=True, max_iter=3), 3, "user")
    known = r.select("item").distinct().withColumn("known", F.lit(1))
    return rec.join(known, "item", "left").agg(
        F.count(F.lit(1)).alias("n"), F.max("rank").cast("int").alias("most"), F.count_if(F.col("known").isNull()).alias("unknown_items")
    )
