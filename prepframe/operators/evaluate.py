"""Model evaluation in one pass per table.

Each metric table is an aggregate over the scored frame (partial aggregation, no
collect): confusion counts by conditional sums, AUC by counts per distinct score
plus a distributed prefix sum, ROC/PR by bucketing every score once against the
threshold grid.  Undefined ratios (no predicted positives, a single class) are
null instead of an error or NaN.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from prepframe._session import cut_lineage
from prepframe.operators.ordering import exact_percentiles, ordered_totals


def _is_pos(df: DataFrame, col: str, pos_label) -> Column:
    if isinstance(df.schema[col].dataType, NumericType) and not isinstance(pos_label, str):
        return F.col(col).cast("double") == F.lit(float(pos_label))
    return F.col(col).cast("string") == F.lit(str(pos_label))


def _indicator(c: Column) -> Column:
    return F.when(c, F.lit(1)).when(~c, F.lit(0))


def join_single_rows(*frames: DataFrame) -> DataFrame:
    """Put one-row metric frames side by side without a join: stack them (missing
    columns null) and take each column's single non-null value in one tiny aggregate."""
    cols: list[str] = []
    for f in frames:
        cols += [c for c in f.columns if c not in cols]
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def binary_counts(
    df: DataFrame, label: str, prediction: str = "prediction", pos_label=1, extra: Sequence[Column] = ()
) -> DataFrame:
    """One row ``tn, fp, fn, tp`` (bigint) from a single aggregate; rows with a null
    label or prediction are counted nowhere.  ``extra`` aggregates ride the same pass."""
    y, p = _is_pos(df, label, pos_label), _is_pos(df, prediction, pos_label)

    def cnt(c: Column) -> Column:
        return F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("bigint")

    return df.agg(
        cnt(~y & ~p).alias("tn"),
        cnt(~y & p).alias("fp"),
        cnt(y & ~p).alias("fn"),
        cnt(y & p).alias("tp"),
        *extra,
    )


def _ratio_metrics(counts: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    precision = F.try_divide(tp, tp + fp)
    recall = F.try_divide(tp, tp + fn)
    return counts.select(
        F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
        *extra,
        "tn", "fp", "fn", "tp",
    )


def binary_auc(df: DataFrame, label: str, score: str, pos_label=1) -> DataFrame:
    """One row ``auc``: Mann-Whitney with tie halves.

    Rows are reduced to (distinct score, positives, negatives) first; the running
    count of negatives below each score comes from ``ordered_totals``.
    """
    y = _indicator(_is_pos(df, label, pos_label))
    s = F.col(score).cast("double")
    per_score = (
        df.select(y.alias("_y"), s.alias("_s"))
        .where(F.col("_y").isNotNull() & F.col("_s").isNotNull() & ~F.isnan("_s"))
        .groupBy("_s")
        .agg(F.sum("_y").cast("bigint").alias("_pos"), F.sum(1 - F.col("_y")).cast("bigint").alias("_neg"))
    )
    # distinct scores only: the scored rows are computed once
    ranked = ordered_totals(cut_lineage(per_score), ["_s"], sums=["_neg"])
    below = F.col("_cum__neg") - F.col("_neg")
    return ranked.agg(
        F.try_divide(
            F.sum(F.col("_pos") * (below + 0.5 * F.col("_neg"))),
            F.sum("_pos").cast("double") * F.sum("_neg").cast("double"),
        ).alias("auc")
    )


def _logloss_agg(df: DataFrame, label: str, score: str, pos_label, eps: float) -> Column:
    y = _indicator(_is_pos(df, label, pos_label)).cast("double")
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1 - eps))
    return F.avg(-(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("logloss")


def binary_logloss(df: DataFrame, label: str, score: str, pos_label=1, eps: float = 1e-15) -> DataFrame:
    return df.agg(_logloss_agg(df, label, score, pos_label, eps))


def binary_metrics(
    df: DataFrame, label: str, prediction: str = "prediction", pos_label=1, score: str | None = None
) -> DataFrame:
    """accuracy, precision, recall, f1 [, auc, logloss], tn, fp, fn, tp."""
    if score is None:
        return _ratio_metrics(binary_counts(df, label, prediction, pos_label))
    # counts and log-loss in one pass; AUC needs its own ordering pass
    base = _ratio_metrics(
        binary_counts(df, label, prediction, pos_label, [_logloss_agg(df, label, score, pos_label, 1e-15)]), ["logloss"]
    )
    out = join_single_rows(base, binary_auc(df, label, score, pos_label))
    return out.select("accuracy", "precision", "recall", "f1", "auc", "logloss", "tn", "fp", "fn", "tp")


def _grid_bucket(s: Column, steps: int) -> Column:
    """Number of grid thresholds ``i / steps`` (i = 0..steps) strictly below ``s``."""
    c = F.least(F.greatest(F.ceil(s * steps), F.lit(0)), F.lit(steps + 1))
    c = F.when((c > 0) & ((c - 1) / F.lit(float(steps)) >= s), c - 1).otherwise(c)
    c = F.when((c <= steps) & (c / F.lit(float(steps)) < s), c + 1).otherwise(c)
    return c.cast("int")


def roc_pr_curve(df: DataFrame, label: str, score: str, pos_label=1, steps: int = 100) -> DataFrame:
    """``steps + 1`` rows ``threshold, fpr, tpr, precision, recall`` for thresholds
    1 .. 0; a row is positive when ``score > threshold`` (E3).  O(n) - each score is
    bucketed once, then a suffix sum runs over at most ``steps + 2`` buckets."""
    spark = df.sparkSession
    y = _indicator(_is_pos(df, label, pos_label))
    s = F.col(score).cast("double")
    counts = (
        df.select(y.alias("_y"), s.alias("_s"))
        .where(F.col("_y").isNotNull() & F.col("_s").isNotNull() & ~F.isnan("_s"))
        .groupBy(_grid_bucket(F.col("_s"), steps).alias("k"))
        .agg(F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg"))
    )
    grid = spark.range(steps + 2).select(F.col("id").cast("int").alias("k"))
    full = grid.join(counts, "k", "left").fillna(0, ["pos", "neg"])
    # bounded: steps + 2 rows in a single window partition
    suffix = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cum = full.select(
        (F.col("k") - 1).alias("i"),
        F.sum("pos").over(suffix).cast("double").alias("tp"),
        F.sum("neg").over(suffix).cast("double").alias("fp"),
        F.sum("pos").over(everything).cast("double").alias("P"),
        F.sum("neg").over(everything).cast("double").alias("N"),
    ).where(F.col("i") >= 0)
    return cum.select(
        (F.col("i") / F.lit(float(steps))).alias("threshold"),
        F.try_divide(F.col("fp"), F.col("N")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("P")).alias("tpr"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("P")).alias("recall"),
    ).orderBy(F.col("threshold").desc())


# ------------------------------------------------------------------ multi-class

def _class_cols(df: DataFrame, label: str, prediction: str) -> tuple[Column, Column]:
    lt, pt = df.schema[label].dataType, df.schema[prediction].dataType
    if isinstance(lt, NumericType) and isinstance(pt, NumericType):
        return F.col(label).cast("double"), F.col(prediction).cast("double")
    return F.col(label).cast("string"), F.col(prediction).cast("string")


def confusion_counts(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)`` for the non-empty cells; at most classes^2 rows."""
    l, p = _class_cols(df, label, prediction)
    return (
        df.select(l.alias("label"), p.alias("prediction"))
        .where(F.col("label").isNotNull() & F.col("prediction").isNotNull())
        .groupBy("label", "prediction")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_table(cells: DataFrame) -> DataFrame:
    """Per class (union of labels and predictions): support, predicted, tp, and the
    one-vs-rest precision / recall / f1 (0 where undefined)."""
    as_label = cells.select(
        F.col("label").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp"),
    )
    as_pred = cells.select(
        F.col("prediction").alias("cls"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
        F.lit(0).cast("bigint").alias("tp"),
    )
    t = as_label.unionByName(as_pred).groupBy("cls").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    return t.withColumn("precision", prec).withColumn("recall", rec).withColumn(
        "f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    )


def multiclass_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: accuracy; weighted (by support), micro and macro precision / recall / f1
    (E4, E5).  Macro averages run over the union of labels and predictions."""
    t = class_table(confusion_counts(df, label, prediction))
    n = F.sum("support").cast("double")
    acc = F.try_divide(F.sum("tp").cast("double"), n)
    return t.agg(
        acc.alias("accuracy"),
        F.try_divide(F.sum(F.col("precision") * F.col("support")), n).alias("weighted_precision"),
        F.try_divide(F.sum(F.col("recall") * F.col("support")), n).alias("weighted_recall"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), n).alias("weighted_f1"),
        acc.alias("micro_precision"),
        acc.alias("micro_recall"),
        acc.alias("micro_f1"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
    )


def confusion_table(df: DataFrame, label: str, prediction: str, labels: Sequence) -> DataFrame:
    """Wide confusion matrix: one row per true label, one count column per predicted
    label in ``labels`` (explicit, so the pivot needs no distinct pass) (E5)."""
    cells = confusion_counts(df, label, prediction)
    numeric = not isinstance(cells.schema["label"].dataType, StringType)
    vals = [float(v) for v in labels] if numeric else [str(v) for v in labels]
    wide = cells.groupBy("label").pivot("prediction", vals).agg(F.sum("n"))
    names = {str(v): str(lbl) for v, lbl in zip(vals, labels)}
    wide = wide.select("label", *[F.coalesce(F.col(f"`{str(v)}`"), F.lit(0)).cast("bigint").alias(names[str(v)]) for v in vals])
    return wide


# ------------------------------------------------------------------ regression

def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction", exact_median: bool = True) -> DataFrame:
    """One row: r2, rmse, mean_ae, median_ae, sse, sst (about the mean label), ssr."""
    y, yh = F.col(label).cast("double"), F.col(prediction).cast("double")
    base = df.select(y.alias("_y"), yh.alias("_p")).where(
        F.col("_y").isNotNull() & F.col("_p").isNotNull() & ~F.isnan("_y") & ~F.isnan("_p")
    )
    err = F.col("_y") - F.col("_p")
    sse = F.sum(err * err)
    sst = F.var_pop("_y") * F.count(F.lit(1))
    main = base.agg(
        (F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"),
        F.sqrt(F.try_divide(sse, F.count(F.lit(1)).cast("double"))).alias("rmse"),
        F.avg(F.abs(err)).alias("mean_ae"),
        sse.alias("sse"),
        sst.alias("sst"),
        (sst - sse).alias("ssr"),
    )
    absdf = base.select(F.abs(err).alias("_ae"))
    if exact_median:
        med = exact_percentiles(absdf, "_ae", [0.5], names=["median_ae"])
    else:
        med = absdf.agg(F.percentile_approx("_ae", 0.5, 10000).cast("double").alias("median_ae"))
    out = join_single_rows(main, med)
    return out.select("r2", "rmse", "mean_ae", "median_ae", "sse", "sst", "ssr")


# ------------------------------------------------------------------ clustering


def _silhouettes(x, own, sums, n, y):
    """Silhouette of every row of ``x`` from the clusters' sizes, sums and sums of squares."""
    import numpy as np

    part, out = max(1, 2_000_000 // len(n)), []
    for at in range(0, len(x), part):
        q, o = x[at : at + part], own[at : at + part]
        rows = np.arange(len(q))
        d = (q * q).sum(1)[:, None] + (y / n)[None] - (2.0 / n)[None] * (q @ sums.T)
        a = d[rows, o] * n[o] / np.maximum(n[o] - 1, 1)
        d[rows, o] = np.inf
        b = d.min(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            s = np.where(a < b, 1 - a / b, np.where(a > b, b / a - 1, 0.0))
        out.append(np.where(n[o] > 1, s, 0.0))
    return np.concatenate(out)


def silhouette(df: DataFrame, features: Sequence[str] | str, prediction: str = "prediction") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, computed as Spark ML's
    ``ClusteringEvaluator`` does: O(n * k) from per-cluster sums (E8).

    ``features`` is a list of numeric columns or the name of an array column.  The
    per-cluster sums (k x d values, k = number of clusters, as large as the model) are
    broadcast as a matrix; every Arrow batch of features computes its rows' k mean squared
    distances.  Features are taken less their means, so large offsets do not
    cancel; rows with a missing, NaN or infinite feature do not count.
    """
    import numpy as np
    import pyarrow as pa

    from prepframe._session import ship_package

    if isinstance(features, str):
        vec = F.col(features).cast("array<double>")
    else:
        vec = F.array(*[F.col(c).cast("double") for c in features])
    pts = df.select(vec.alias("_x"), F.col(prediction).cast("long").alias("_c")).where(F.col("_c").isNotNull())
    pts = pts.where(F.forall("_x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
    means = pts.select(F.posexplode("_x").alias("_j", "_v")).groupBy("_j").agg(F.avg("_v").alias("m")).orderBy("_j").collect()  # d rows
    shift = F.array(*[F.lit(float(r["m"])) for r in means]).cast("array<double>")
    pts = pts.withColumn("_x", F.zip_with("_x", shift, lambda v, m: v - m))
    pts = pts.withColumn("_sq", F.aggregate("_x", F.lit(0.0), lambda a, v: a + v * v))
    sizes = pts.groupBy("_c").agg(F.count(F.lit(1)).alias("n"), F.sum("_sq").alias("y")).orderBy("_c").collect()  # k rows
    if len(sizes) < 2:  # silhouette needs two clusters
        return df.sparkSession.createDataFrame([(None,)], "silhouette double")
    found = pts.select("_c", F.posexplode("_x").alias("_j", "_xj")).groupBy("_c", "_j").agg(F.sum("_xj").alias("s")).collect()  # k x d rows
    ids = np.array([r["_c"] for r in sizes], np.int64)
    sums = np.zeros((len(ids), len(means)))
    for r in found:
        sums[np.searchsorted(ids, r["_c"]), r["_j"]] = r["s"]
    n, y = (np.array([r[c] for r in sizes], np.float64) for c in ("n", "y"))
    ship_package(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast((ids, sums, n, y))

    def run(batches):
        ids, *rest = model.value
        for b in batches:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                yield pa.RecordBatch.from_arrays([pa.array(_silhouettes(x, np.searchsorted(ids, b.column(1).to_numpy()), *rest))], names=["s"])

    return pts.select("_x", "_c").mapInArrow(run, "s double").agg(F.avg("s").alias("silhouette"))
