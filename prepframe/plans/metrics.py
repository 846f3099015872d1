"""Evaluation queries over deterministic scored frames derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepframe.operators import evaluate as E
from prepframe.plans.registry import load, query, rounded

# events as a scored binary table: label = error event, score from value
_SCORED = """
SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y,
       least(value / 200.0, 1.0) AS p,
       CASE WHEN least(value / 200.0, 1.0) > 0.25 THEN 1 ELSE 0 END AS yhat
FROM events
"""


def _scored_events(spark, sf):
    ev = load(spark, sf, "events")
    p = F.least(F.col("value") / 200.0, F.lit(1.0))
    return ev.select(
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("y"),
        p.alias("p"),
        F.when(p > 0.25, 1).otherwise(0).alias("yhat"),
    )


@query(
    "binary_metrics",
    f"""
WITH s AS ({_SCORED}),
c AS (SELECT CAST(sum(CASE WHEN y = 0 AND yhat = 0 THEN 1 ELSE 0 END) AS BIGINT) tn,
             CAST(sum(CASE WHEN y = 0 AND yhat = 1 THEN 1 ELSE 0 END) AS BIGINT) fp,
             CAST(sum(CASE WHEN y = 1 AND yhat = 0 THEN 1 ELSE 0 END) AS BIGINT) fn,
             CAST(sum(CASE WHEN y = 1 AND yhat = 1 THEN 1 ELSE 0 END) AS BIGINT) tp FROM s),
r AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS mr FROM s),
a AS (SELECT (sum(CASE WHEN y = 1 THEN mr ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0)
             / (CAST(sum(y) AS DOUBLE) * CAST(count(*) - sum(y) AS DOUBLE)) AS auc FROM r),
l AS (SELECT avg(-(y * ln(least(greatest(p, 1e-15), 1 - 1e-15)) + (1 - y) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)))) AS logloss FROM s)
SELECT round(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 6) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 6) AS recall,
       round(CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn), 6) AS f1,
       round(auc, 6) AS auc, round(logloss, 6) AS logloss, tn, fp, fn, tp
FROM c, a, l
""",
)
def binary_metrics(spark, sf):
    s = _scored_events(spark, sf)
    return rounded(E.binary_metrics(s, "y", "yhat", pos_label=1, score="p"))


@query(
    "roc_pr_curve",
    f"""
WITH s AS ({_SCORED}),
g AS (SELECT CAST(i AS DOUBLE) / 100.0 AS t FROM range(0, 101) r(i)),
c AS (SELECT t, CAST(sum(CASE WHEN p > t AND y = 1 THEN 1 ELSE 0 END) AS DOUBLE) tp,
             CAST(sum(CASE WHEN p > t AND y = 0 THEN 1 ELSE 0 END) AS DOUBLE) fp,
             CAST(sum(y) AS DOUBLE) pos, CAST(sum(1 - y) AS DOUBLE) neg
      FROM g, s GROUP BY t)
SELECT round(t, 6) AS threshold,
       round(CASE WHEN neg = 0 THEN NULL ELSE fp / neg END, 6) AS fpr,
       round(CASE WHEN pos = 0 THEN NULL ELSE tp / pos END, 6) AS tpr,
       round(CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN pos = 0 THEN NULL ELSE tp / pos END, 6) AS recall
FROM c
""",
)
def roc_pr_curve(spark, sf):
    return rounded(E.roc_pr_curve(_scored_events(spark, sf), "y", "p", pos_label=1))


_TEXT_SCORED = """
SELECT CASE WHEN l.toxic = 1 THEN 'yes' ELSE 'no' END AS label,
       least(d.n_chars / 20000.0, 1.0) AS p,
       CASE WHEN least(d.n_chars / 20000.0, 1.0) > 0.1 THEN 'yes' ELSE 'no' END AS prediction
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
"""


@query(
    "binary_metrics_strings",
    f"""
WITH s AS ({_TEXT_SCORED}),
c AS (SELECT CAST(sum(CASE WHEN label = 'no' AND prediction = 'no' THEN 1 ELSE 0 END) AS BIGINT) tn,
             CAST(sum(CASE WHEN label = 'no' AND prediction = 'yes' THEN 1 ELSE 0 END) AS BIGINT) fp,
             CAST(sum(CASE WHEN label = 'yes' AND prediction = 'no' THEN 1 ELSE 0 END) AS BIGINT) fn,
             CAST(sum(CASE WHEN label = 'yes' AND prediction = 'yes' THEN 1 ELSE 0 END) AS BIGINT) tp FROM s),
r AS (SELECT CASE WHEN label = 'yes' THEN 1 ELSE 0 END AS y,
             rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS mr FROM s),
a AS (SELECT (sum(CASE WHEN y = 1 THEN mr ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0)
             / (CAST(sum(y) AS DOUBLE) * CAST(count(*) - sum(y) AS DOUBLE)) AS auc FROM r)
SELECT round(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 6) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 6) AS recall,
       round(CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn), 6) AS f1,
       round(auc, 6) AS auc, tn, fp, fn, tp
FROM c, a
""",
)
def binary_metrics_strings(spark, sf):
    lab, doc = load(spark, sf, "labels"), load(spark, sf, "documents")
    p = F.least(F.col("n_chars") / 20000.0, F.lit(1.0))
    s = lab.join(doc, "doc_id").select(
        F.when(F.col("toxic") == 1, "yes").otherwise("no").alias("label"),
        p.alias("p"),
        F.when(p > 0.1, "yes").otherwise("no").alias("prediction"),
    )
    m = E.binary_metrics(s, "label", "prediction", pos_label="yes")
    return rounded(E.join_single_rows(m, E.binary_auc(s, "label", "p", pos_label="yes")))


_MULTI = """
SELECT event_type AS label,
       CASE WHEN value < 20 THEN 'view' WHEN value < 40 THEN 'click' WHEN value < 60 THEN 'signup'
            WHEN value < 100 THEN 'purchase' ELSE 'error' END AS prediction
FROM events
"""


def _multi_events(spark, sf):
    v = F.col("value")
    pred = (
        F.when(v < 20, "view").when(v < 40, "click").when(v < 60, "signup").when(v < 100, "purchase").otherwise("error")
    )
    return load(spark, sf, "events").select(F.col("event_type").alias("label"), pred.alias("prediction"))


@query(
    "multiclass_metrics",
    f"""
WITH t AS ({_MULTI}),
st AS (SELECT cls, sum(support) support, sum(predicted) predicted, sum(tp) tp FROM (
         SELECT label cls, 1 support, 0 predicted, CASE WHEN label = prediction THEN 1 ELSE 0 END tp FROM t
         UNION ALL SELECT prediction, 0, 1, 0 FROM t) u GROUP BY cls),
m AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / predicted END AS prec,
                CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / support END AS rec FROM st),
f AS (SELECT *, CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END AS f1 FROM m)
SELECT round(CAST(sum(tp) AS DOUBLE) / sum(support), 6) AS accuracy,
       round(sum(prec * support) / sum(support), 6) AS weighted_precision,
       round(sum(rec * support) / sum(support), 6) AS weighted_recall,
       round(sum(f1 * support) / sum(support), 6) AS weighted_f1,
       round(CAST(sum(tp) AS DOUBLE) / sum(support), 6) AS micro_precision,
       round(CAST(sum(tp) AS DOUBLE) / sum(support), 6) AS micro_recall,
       round(CAST(sum(tp) AS DOUBLE) / sum(support), 6) AS micro_f1,
       round(avg(prec), 6) AS macro_precision, round(avg(rec), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1
FROM f
""",
)
def multiclass_metrics(spark, sf):
    return rounded(E.multiclass_metrics(_multi_events(spark, sf), "label", "prediction"))


_CLASSES = ["click", "error", "purchase", "signup", "view"]


@query(
    "confusion_matrix",
    f"""
WITH t AS ({_MULTI})
SELECT label, {", ".join(f"CAST(sum(CASE WHEN prediction = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in _CLASSES)}
FROM t GROUP BY label
""",
)
def confusion_matrix(spark, sf):
    return E.confusion_table(_multi_events(spark, sf), "label", "prediction", _CLASSES)


@query(
    "regression_metrics",
    """
WITH t AS (SELECT l_quantity AS y, l_extendedprice / 2000.0 AS p FROM lineitem),
m AS (SELECT sum((y - p) * (y - p)) AS sse, var_pop(y) * count(*) AS sst, count(*) AS n,
             avg(abs(y - p)) AS mean_ae, quantile_cont(abs(y - p), 0.5) AS median_ae FROM t)
SELECT round(1 - sse / sst, 6) AS r2, round(sqrt(sse / n), 6) AS rmse, round(mean_ae, 6) AS mean_ae,
       round(median_ae, 6) AS median_ae, round(sse, 2) AS sse, round(sst, 2) AS sst, round(sst - sse, 2) AS ssr
FROM m
""",
)
def regression_metrics(spark, sf):
    li = load(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("y"), (F.col("l_extendedprice") / 2000.0).alias("p")
    )
    m = E.regression_metrics(li, "y", "p")
    return m.select(
        *[F.round(c, 6).alias(c) for c in ("r2", "rmse", "mean_ae", "median_ae")],
        *[F.round(c, 2).alias(c) for c in ("sse", "sst", "ssr")],
    )


@query(
    "silhouette",
    """
WITH pts AS (SELECT vec_id, label AS c, embedding AS x FROM embeddings),
pe AS (SELECT vec_id, c, i, CAST(x[i] AS DOUBLE) AS v FROM pts, range(1, 65) r(i)),
sq AS (SELECT vec_id, c, sum(v * v) AS sq FROM pe GROUP BY vec_id, c),
cs AS (SELECT c, i, sum(v) AS s FROM pe GROUP BY c, i),
cn AS (SELECT c, count(*) AS n, sum(sq) AS y FROM sq GROUP BY c),
dt AS (SELECT pe.vec_id, cs.c AS k, sum(pe.v * cs.s) AS d FROM pe JOIN cs ON pe.i = cs.i GROUP BY pe.vec_id, cs.c),
dist AS (SELECT dt.vec_id, dt.k, sq.c, sq.sq + cn.y / cn.n - 2.0 * dt.d / cn.n AS dd, cn.n AS kn
         FROM dt JOIN sq ON sq.vec_id = dt.vec_id JOIN cn ON cn.c = dt.k),
ab AS (SELECT vec_id, max(CASE WHEN k = c THEN (CASE WHEN kn > 1 THEN dd * kn / (kn - 1) ELSE 0 END) END) AS a,
              min(CASE WHEN k <> c THEN dd END) AS b, max(CASE WHEN k = c THEN kn END) AS own_n
       FROM dist GROUP BY vec_id)
SELECT round(avg(CASE WHEN own_n <= 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6) AS silhouette
FROM ab
""",
)
def silhouette(spark, sf):
    emb = load(spark, sf, "embeddings")
    return rounded(E.silhouette(emb, "embedding", "label"))
