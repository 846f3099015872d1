"""Model, feature-projection and recommendation queries.

Trained models are checked row-count-only by the driver (no SQL twin for an
optimiser); closed-form pieces (1-D regression, nearest-centre assignment, fences,
correlation ranking, frequent pairs) have DuckDB twins.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from prepframe._session import cut_lineage
from prepframe.operators import evaluate as E
from prepframe.operators import features as FE
from prepframe.operators import models as MO
from prepframe.operators.split import split_hash
from prepframe.plans.registry import load, query, rounded

TEXT_FEATURES = ["unique_ratio", "punct_share", "nonletter_share", "log_chars", "mean_word_len"]


def text_features(docs):
    """Whole-text features with built-ins only (no Python per row)."""
    words = F.filter(F.split(F.lower(F.col("text")), r"[^\p{L}]+"), lambda w: F.length(w) > 0)
    n_chars = F.greatest(F.length("text"), F.lit(1))
    return docs.select(
        "*",
        F.coalesce(F.try_divide(F.size(F.array_distinct(words)).cast("double"), F.size(words)), F.lit(0.0)).alias("unique_ratio"),
        ((F.length("text") - F.length(F.regexp_replace("text", r"\p{Punct}", ""))) / n_chars).alias("punct_share"),
        ((F.length("text") - F.length(F.regexp_replace("text", r"[^\p{L}]", ""))) / n_chars).alias("nonletter_share"),
        F.log1p(F.length("text").cast("double")).alias("log_chars"),
        F.coalesce(
            F.try_divide(F.length(F.regexp_replace("text", r"[^\p{L}]", "")).cast("double"), F.size(words)), F.lit(0.0)
        ).alias("mean_word_len"),
    )


def _quality(spark, sf):
    """Labelled documents as a small feature table, written once to the checkpoint
    folder so the learners' repeated passes never re-read whole texts."""
    lab = load(spark, sf, "labels")
    docs = load(spark, sf, "documents")
    feats = text_features(lab.join(docs, "doc_id")).select("doc_id", "quality", "toxic", *TEXT_FEATURES)
    return cut_lineage(feats)


def _binary_run(spark, sf, kind, algo, **params):
    data = _quality(spark, sf)
    train, test = split_hash(data, "doc_id", 0.7)
    m = MO.fit(train, TEXT_FEATURES, "quality", MO.make_estimator(kind, algo, **params), kind)
    scored = MO.score(m, test)
    pos = 1
    if "p_1" in scored.columns:
        return rounded(E.binary_metrics(scored, "quality", "prediction", pos, score="p_1"), 4)
    return rounded(E.binary_metrics(scored, "quality", "prediction", pos), 4)


@query("rf_binary")
def rf_binary(spark, sf):
    return _binary_run(spark, sf, "binary", "random_forest", treeNum=20, maxDepth=5, criterion="gini", minSamplesLeaf=1)


@query("logistic_regression")
def logistic_regression(spark, sf):
    return _binary_run(spark, sf, "binary", "logistic_regression", maxIter=50)


@query("decision_tree")
def decision_tree(spark, sf):
    return _binary_run(spark, sf, "binary", "decision_tree", maxDepth=4)


@query("gbdt_binary")
def gbdt_binary(spark, sf):
    return _binary_run(spark, sf, "binary", "gbdt", maxIter=10, maxDepth=3)


@query("naive_bayes")
def naive_bayes(spark, sf):
    return _binary_run(spark, sf, "binary", "naive_bayes", modelType="gaussian")


@query("svm")
def svm(spark, sf):
    return _binary_run(spark, sf, "binary", "svm", maxIter=50)


@query("mlp")
def mlp(spark, sf):
    return _binary_run(spark, sf, "binary", "mlp", layers=[len(TEXT_FEATURES), 8, 2], maxIter=100)


def _lang_data(spark, sf):
    docs = text_features(load(spark, sf, "documents"))
    accent = (F.length("text") - F.length(F.regexp_replace("text", r"[^\p{L}&&[^a-zA-Z]]", ""))) / F.greatest(F.length("text"), F.lit(1))
    docs = docs.withColumn("accent_share", accent.cast("double"))
    return cut_lineage(docs.select("doc_id", "lang", *TEXT_FEATURES, "accent_share"))


_LANG_FEATURES = TEXT_FEATURES + ["accent_share"]


@query("rf_multiclass")
def rf_multiclass(spark, sf):
    data = _lang_data(spark, sf)
    train, test = split_hash(data, "doc_id", 0.7)
    m = MO.fit(train, _LANG_FEATURES, "lang", MO.make_estimator("multiclass", "random_forest", treeNum=20, maxDepth=5), "multiclass")
    return rounded(E.multiclass_metrics(MO.score(m, test), "lang", "prediction"), 4)


@query("gbdt_multiclass")
def gbdt_multiclass(spark, sf):
    data = _lang_data(spark, sf)
    train, test = split_hash(data, "doc_id", 0.7)
    m = MO.fit(train, _LANG_FEATURES, "lang", MO.make_estimator("multiclass", "gbdt", maxIter=5, maxDepth=3), "multiclass")
    return rounded(E.multiclass_metrics(MO.score(m, test), "lang", "prediction"), 4)


def _price_data(spark, sf):
    li, p = load(spark, sf, "lineitem"), load(spark, sf, "part")
    return li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_quantity", "p_retailprice", "l_discount", "l_extendedprice"
    )


def _price_split(spark, sf):
    """Training and test rows; the join is made once, not once for each pass of a learner or metric."""
    data = cut_lineage(_price_data(spark, sf)).withColumn("_k", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return split_hash(data, "_k", 0.7)


def _price_metrics(model, test):
    scored = cut_lineage(MO.score(model, test).select("l_extendedprice", "prediction"))  # the exact median reads it again
    return rounded(E.regression_metrics(scored, "l_extendedprice", "prediction").select("r2", "rmse", "mean_ae", "median_ae"), 2)


@query("rf_regression")
def rf_regression(spark, sf):
    train, test = _price_split(spark, sf)
    feats = ["l_quantity", "p_retailprice", "l_discount"]
    m = MO.fit(train, feats, "l_extendedprice", MO.make_estimator("regression", "random_forest", treeNum=10, maxDepth=6), "regression")
    return _price_metrics(m, test)


@query("gbdt_regression")
def gbdt_regression(spark, sf):
    train, test = _price_split(spark, sf)
    feats = ["l_quantity", "p_retailprice", "l_discount"]
    m = MO.fit(train, feats, "l_extendedprice", MO.make_estimator("regression", "gbdt", maxIter=10, maxDepth=4), "regression")
    return _price_metrics(m, test)


@query(
    "linear_regression",
    """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept
FROM lineitem
""",
)
def linear_regression(spark, sf):
    li = load(spark, sf, "lineitem")
    m = MO.fit(li, ["l_quantity"], "l_extendedprice", MO.make_estimator("regression", "linear_regression", solver="normal"), "regression")
    lr = m.pipeline.stages[-1]
    return spark.createDataFrame([(float(lr.coefficients[0]), float(lr.intercept))], "slope double, intercept double").select(
        F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept")
    )


@query("glm_poisson")
def glm_poisson(spark, sf):
    # orders per customer as a count response of the customer's balance and segment size
    o, c = load(spark, sf, "orders"), load(spark, sf, "customer")
    per = o.groupBy("o_custkey").agg(F.count(F.lit(1)).cast("double").alias("n_orders"))
    data = c.join(per, F.col("c_custkey") == F.col("o_custkey"), "left").fillna(0.0, ["n_orders"])  # no order: count 0
    data = data.withColumn("bal_k", F.col("c_acctbal") / 1000.0)
    m = MO.fit(data, ["bal_k"], "n_orders", MO.make_estimator("regression", "glm", family="poisson", link="log"), "regression")
    scored = MO.score(m, data)
    return rounded(E.regression_metrics(scored, "n_orders", "prediction").select("rmse", "mean_ae"), 4)


# ------------------------------------------------------------------ clustering

@query("kmeans")
def kmeans(spark, sf):
    emb = load(spark, sf, "embeddings")
    m = MO.fit_kmeans(emb, "embedding", K=10, n_init=2, max_iter=20, tol=1e-4)
    return MO.assign_clusters(m, emb).groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


@query(
    "assign_cluster",
    """
WITH pe AS (SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) r(i)),
c AS (SELECT label AS cluster, i, avg(v) AS m FROM pe GROUP BY label, i),
d AS (SELECT pe.vec_id, c.cluster, sum((pe.v - c.m) * (pe.v - c.m)) AS dist FROM pe JOIN c ON pe.i = c.i GROUP BY pe.vec_id, c.cluster)
SELECT vec_id, CAST(arg_min(cluster, (dist, cluster)) AS INTEGER) AS prediction FROM d GROUP BY vec_id
""",
)
def assign_cluster(spark, sf):
    emb = load(spark, sf, "embeddings")
    arr = F.col("embedding").cast("array<double>")
    # centres = per-label means, computed by Spark (k rows)
    centres = emb.groupBy(F.col("label").alias("cluster")).agg(
        F.array(*[F.avg(arr[j]) for j in range(64)]).alias("centre")
    )
    return MO.assign_to_centres(emb, "embedding", centres).select("vec_id", F.col("prediction").cast("int"))


@query("silhouette_kmeans")
def silhouette_kmeans(spark, sf):
    emb = load(spark, sf, "embeddings")
    m = MO.fit_kmeans(emb, "embedding", K=5, max_iter=20)
    return rounded(E.silhouette(MO.assign_clusters(m, emb), "embedding", "prediction"), 4)


# ------------------------------------------------------------------ projections

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("pca")
def pca(spark, sf):
    li = load(spark, sf, "lineitem")
    out = FE.fit_pca(li, LINE, 2, scale=True).transform(li)
    return rounded(out.groupBy("l_returnflag").agg(F.avg("pca_0").alias("pca_0"), F.avg("pca_1").alias("pca_1")), 4)


@query("svd")
def svd(spark, sf):
    li = load(spark, sf, "lineitem")
    fit = FE.fit_svd(li, LINE, 2)
    return rounded(fit.table(spark), 4)


@query("flda")
def flda(spark, sf):
    data = _quality(spark, sf)
    fit = FE.fit_flda(data, TEXT_FEATURES, "quality")
    return rounded(fit.transform(data).groupBy("quality").agg(F.avg("lda_0").alias("lda_0"), F.count(F.lit(1)).alias("n")), 4)


# ------------------------------------------------------------------ anomalies and selection

@query(
    "anomaly_iqr",
    """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) q1, quantile_cont(l_extendedprice, 0.75) q3
           FROM lineitem GROUP BY l_returnflag)
SELECT l.l_returnflag, CAST(sum(CASE WHEN l_extendedprice < q1 - 1.5 * (q3 - q1) OR l_extendedprice > q3 + 1.5 * (q3 - q1)
                                     THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers, count(*) AS n
FROM lineitem l JOIN q ON l.l_returnflag = q.l_returnflag GROUP BY l.l_returnflag
""",
)
def anomaly_iqr(spark, sf):
    li = load(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    b = FE.fit_anomaly_bounds(li, ["l_extendedprice"], "iqr", group_by=["l_returnflag"])
    f = FE.flag_anomalies(li, b, ["l_extendedprice"], group_by=["l_returnflag"])
    return f.groupBy("l_returnflag").agg(
        F.sum(F.col("l_extendedprice_outlier").cast("int")).cast("bigint").alias("n_outliers"), F.count(F.lit(1)).alias("n")
    )


@query(
    "anomaly_zscore",
    """
WITH s AS (SELECT avg(value) mu, stddev_samp(value) sd FROM events)
SELECT event_type, CAST(sum(CASE WHEN value < mu - 2.5 * sd OR value > mu + 2.5 * sd THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers
FROM events, s GROUP BY event_type
""",
)
def anomaly_zscore(spark, sf):
    ev = load(spark, sf, "events").select("event_type", "value")
    b = FE.fit_anomaly_bounds(ev, ["value"], "zscore", k=2.5)
    f = FE.flag_anomalies(ev, b, ["value"])
    return f.groupBy("event_type").agg(F.sum(F.col("value_outlier").cast("int")).cast("bigint").alias("n_outliers"))


_SEL = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query(
    "select_pearson",
    """
WITH s AS (SELECT 'l_quantity' AS feature, abs(corr(l_quantity, l_extendedprice)) AS score FROM lineitem
           UNION ALL SELECT 'l_discount', abs(corr(l_discount, l_extendedprice)) FROM lineitem
           UNION ALL SELECT 'l_tax', abs(corr(l_tax, l_extendedprice)) FROM lineitem
           UNION ALL SELECT 'l_linenumber', abs(corr(l_linenumber, l_extendedprice)) FROM lineitem)
SELECT feature, round(score, 6) AS score, CAST(row_number() OVER (ORDER BY score DESC, feature) AS INTEGER) AS rank FROM s
""",
)
def select_pearson(spark, sf):
    r = FE.rank_features(load(spark, sf, "lineitem"), _SEL, "l_extendedprice", "pearson")
    return r.select("feature", F.round("score", 6).alias("score"), F.col("rank").cast("int"))


@query(
    "select_variance",
    """
WITH s AS (SELECT 'c_acctbal' AS feature, var_samp(c_acctbal) AS score FROM customer
           UNION ALL SELECT 'c_nationkey', var_samp(c_nationkey) FROM customer)
SELECT feature, round(score, 2) AS score, CAST(row_number() OVER (ORDER BY score DESC, feature) AS INTEGER) AS rank FROM s
""",
)
def select_variance(spark, sf):
    r = FE.rank_features(load(spark, sf, "customer"), ["c_acctbal", "c_nationkey"], method="variance")
    return r.select("feature", F.round("score", 2).alias("score"), F.col("rank").cast("int"))


_CHI2_TABLE = {
    "nation": "CAST(c_nationkey AS VARCHAR)", "balance_band": "CAST(CAST(floor(c_acctbal / 2000) AS BIGINT) AS VARCHAR)",
    "segment_initial": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE substr(c_mktsegment, 1, 1) END",
}


@query(
    "select_chi2",
    "WITH t AS ("
    + " UNION ALL ".join(f"SELECT '{f}' AS feature, {e} AS v, c_mktsegment = 'BUILDING' AS y FROM customer" for f, e in _CHI2_TABLE.items())
    + """),
c AS (SELECT feature, v, y, count(*)::DOUBLE AS o FROM t WHERE v IS NOT NULL GROUP BY ALL),
m AS (SELECT *, sum(o) OVER (PARTITION BY feature, v) AS r, sum(o) OVER (PARTITION BY feature, y) AS k, sum(o) OVER (PARTITION BY feature) AS n FROM c),
e AS (SELECT feature, max(n) * (sum(o * o / (r * k)) - 1) AS statistic, (count(DISTINCT v) - 1) * (count(DISTINCT y) - 1) AS dof FROM m GROUP BY feature)
SELECT feature, round(statistic, 6) AS statistic, dof, feature = 'segment_initial' AS best FROM e
""",
)
def select_chi2(spark, sf):
    c = load(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 2000).alias("balance_band"),
        F.expr("CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE substr(c_mktsegment, 1, 1) END").alias("segment_initial"),
        (F.col("c_mktsegment") == "BUILDING").alias("label"),
    )
    r = FE.rank_chi2(c, list(_CHI2_TABLE), "label")
    return r.select("feature", F.round("statistic", 6).alias("statistic"), "dof", (F.col("rank") == 1).alias("best"))


@query("linear_importance")
def linear_importance(spark, sf):
    return rounded(FE.linear_importance(_price_data(spark, sf), ["l_quantity", "p_retailprice", "l_discount"], "l_extendedprice"), 2)


@query("rf_importance")
def rf_importance(spark, sf):
    data = _quality(spark, sf)
    m = MO.fit(data, TEXT_FEATURES, "quality", MO.make_estimator("binary", "random_forest", treeNum=10, maxDepth=4), "binary")
    return rounded(FE.forest_importance(m.pipeline, TEXT_FEATURES, spark), 4)


# ------------------------------------------------------------------ recommendation, validation, tuning

def _subsets(item: str) -> str:
    """All non-empty item sets of every basket, items in ascending order (baskets are small)."""
    return f"""
WITH RECURSIVE t AS (SELECT DISTINCT l_orderkey AS o, {item} AS b FROM lineitem JOIN part ON l_partkey = p_partkey),
nb AS (SELECT CAST(count(DISTINCT o) AS DOUBLE) AS n FROM t),
sub(o, items, last) AS (SELECT o, [b], b FROM t UNION ALL
  SELECT sub.o, list_append(items, t.b), t.b FROM sub JOIN t ON t.o = sub.o AND t.b > last),
s AS (SELECT items, count(*) AS f FROM sub GROUP BY items)"""


@query(
    "frequent_itemsets",
    _subsets("p_brand") + "SELECT array_to_string(items, ',') AS items, f AS freq FROM s, nb WHERE f >= ceil(0.01 * n)",
)
def frequent_itemsets(spark, sf):
    li, p = load(spark, sf, "lineitem"), load(spark, sf, "part")
    t = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("o"), F.col("p_brand").alias("b"))
    items, _ = MO.frequent_itemsets(t, "o", "b", min_support=0.01, min_confidence=0.5)
    return items.select(F.array_join(F.array_sort("items"), ",").alias("items"), F.col("freq").cast("bigint").alias("freq"))


@query(
    "association_rules",
    _subsets("p_type")
    + """,
z AS (SELECT items, f, unnest(items) AS c FROM s, nb WHERE len(items) > 1 AND f >= ceil(0.02 * n)),
r AS (SELECT [x FOR x IN items IF x <> c] AS a, c, f FROM z)
SELECT array_to_string(a, ',') AS antecedent, c AS consequent, round(r.f / sa.f, 4) AS confidence,
       round((r.f / sa.f) / (sc.f / n), 4) AS lift, round(r.f / n, 4) AS support
FROM r JOIN s sa ON sa.items = a JOIN s sc ON sc.items = [c], nb
WHERE r.f / sa.f >= 0.05
""",
)
def association_rules(spark, sf):
    li, p = load(spark, sf, "lineitem"), load(spark, sf, "part")
    t = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("o"), F.col("p_type").alias("b"))
    _, rules = MO.frequent_itemsets(t, "o", "b", min_support=0.02, min_confidence=0.05)
    return rounded(rules.select(
        F.array_join(F.array_sort("antecedent"), ",").alias("antecedent"),
        F.array_join(F.array_sort("consequent"), ",").alias("consequent"),
        "confidence", "lift", "support",
    ), 4)


@query("als")
def als(spark, sf):
    o, li, p = load(spark, sf, "orders"), load(spark, sf, "lineitem"), load(spark, sf, "part")
    brand_id = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    r = (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(p, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("o_custkey").cast("int").alias("user"), brand_id.alias("item"))
        .agg(F.count(F.lit(1)).cast("float").alias("rating"))
    )
    model = MO.fit_als(r, "user", "item", "rating", rank=5, implicit=True, max_iter=5)
    return MO.recommend(model, 3, "user").select("user", "rank", "item")


@query("cross_validate")
def cross_validate(spark, sf):
    data = _quality(spark, sf)
    res = MO.cross_validate(
        data, TEXT_FEATURES, "quality", lambda: MO.make_estimator("binary", "logistic_regression", maxIter=30), "binary", "doc_id", k=3
    )
    return rounded(res.select("fold", "accuracy", "auc"), 4)


@query("tune")
def tune(spark, sf):
    data = _quality(spark, sf)
    grid = [
        ("random_forest", {"treeNum": 10, "maxDepth": 3}),
        ("random_forest", {"treeNum": 10, "maxDepth": 5}),
        ("logistic_regression", {"regParam": 0.01}),
    ]
    table, _ = MO.tune(data, TEXT_FEATURES, "quality", "binary", grid, "doc_id", "auc")
    return rounded(table, 4)


_KNN_CUT = int(0.8 * 2**32)


@query(
    "knn_vote",
    f"""
WITH e AS (SELECT vec_id, label, embedding,
                  ('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8))::BIGINT < {_KNN_CUT} AS is_train FROM embeddings),
pe AS (SELECT vec_id, is_train, label, i, CAST(embedding[i] AS DOUBLE) AS v FROM e, range(1, 65) r(i)),
d AS (SELECT q.vec_id AS q, t.vec_id AS r, t.label, sum((q.v - t.v) * (q.v - t.v)) AS dist
      FROM pe q JOIN pe t ON q.i = t.i AND NOT q.is_train AND t.is_train GROUP BY q.vec_id, t.vec_id, t.label),
nn AS (SELECT q, label, row_number() OVER (PARTITION BY q ORDER BY dist, r) AS rk FROM d),
v AS (SELECT q, label, count(*) AS c FROM nn WHERE rk <= 5 GROUP BY q, label)
SELECT q AS vec_id, arg_min(label, (-c, label)) AS prediction FROM v GROUP BY q
""",
)
def knn_vote(spark, sf):
    from prepframe.operators.neighbors import knn_classify

    emb = load(spark, sf, "embeddings")
    train, test = split_hash(emb, "vec_id", 0.8)
    return knn_classify(train, test, "embedding", "label", k=5, train_id="vec_id")


_EPS2 = 1.16 * 1.16


@query(
    "dbscan",
    f"""
WITH RECURSIVE pe AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) r(i)),
d AS (SELECT a.vec_id AS a, b.vec_id AS b, sum((a.v - b.v) * (a.v - b.v)) AS dist FROM pe a JOIN pe b ON a.i = b.i
      GROUP BY a.vec_id, b.vec_id),
nb AS (SELECT a, count(*) AS c FROM d WHERE dist <= {_EPS2} GROUP BY a),
core AS (SELECT a FROM nb WHERE c >= 4),
e AS (SELECT d.a, d.b FROM d JOIN core ca ON d.a = ca.a JOIN core cb ON d.b = cb.a WHERE dist <= {_EPS2}),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
lab AS (SELECT a, min(b) AS cl FROM reach GROUP BY a),
border AS (SELECT d.a, min(lab.cl) AS cl FROM d JOIN lab ON d.b = lab.a
           WHERE d.dist <= {_EPS2} AND d.a NOT IN (SELECT a FROM core) GROUP BY d.a)
SELECT e.vec_id, CAST(coalesce(lab.cl, border.cl, -1) AS BIGINT) AS cluster, lab.a IS NOT NULL AS is_core
FROM embeddings e LEFT JOIN lab ON e.vec_id = lab.a LEFT JOIN border ON e.vec_id = border.a
""",
)
def dbscan(spark, sf):
    from prepframe.operators.density import dbscan as run

    emb = load(spark, sf, "embeddings")
    return run(emb, "vec_id", "embedding", eps=1.16, min_points=4)
