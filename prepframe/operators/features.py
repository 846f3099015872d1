"""Feature transforms, selection and importance.

Linear projections (PCA, SVD, FLDA) are fitted from the first and second moments of the
d feature columns (one d x d matrix per task, merged row by row; the same for any d), solved
on the driver as a d x d eigenproblem, and applied as plain column expressions - no vectors,
no Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepframe._session import cut_lineage
from prepframe.operators.ordering import exact_percentiles, join_groups


# classes whose sums are collected for FLDA (one row of d sums each)
MAX_GROUPS = 10_000

# The tasks' partial matrices are merged row by row, in this many groups first and then in one.
MERGE_GROUPS = 64


def _gram(base: DataFrame, shift: np.ndarray) -> np.ndarray:
    """Cross products over all rows of (the array less ``shift``, 1): (d + 1) x (d + 1).

    A task adds its Arrow batches to one matrix of its own, whatever the width; the rows of
    these matrices are summed in two steps, so no merging task reads more than one row of
    some of the tasks, and only the finished matrix reaches the driver."""
    d = len(shift) + 1
    groups = MERGE_GROUPS
    schema = "part int, i int, v array<double>"

    def table(part, i, v) -> pa.RecordBatch:
        columns = [pa.array(part, pa.int32()), pa.array(i, pa.int32()), pa.array(list(v), pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(columns, names=["part", "i", "v"])

    def run(batches):
        total = np.zeros((d, d))
        for b in batches:
            x = np.ones((b.num_rows, d))
            x[:, :-1] = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, d - 1) - shift
            total += x.T @ x
        if total[-1, -1]:
            yield table([TaskContext.get().partitionId() % groups] * d, range(d), total)

    def merge(rows: pa.Table) -> pa.Table:
        v = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, d)
        return pa.Table.from_batches([table([rows["part"][0].as_py()], [rows["i"][0].as_py()], [v.sum(0)])])

    parts = base.mapInArrow(run, schema)
    rows = parts.groupBy("part", "i").applyInArrow(merge, schema).groupBy("i").applyInArrow(merge, schema)
    out = np.zeros((d, d))
    for r in rows.collect():  # d rows
        out[r["i"]] = r["v"]
    return out


def _moments(df: DataFrame, columns: Sequence[str], group: str | None = None):
    """``{class: (count, sums)}``, cross products over all classes, both of ``columns`` less
    their overall means, and those means (rows with any null or NaN skipped)."""
    d = len(columns)
    keys = [] if group is None else [F.col(group).alias("_g")]
    base = df.select(*keys, *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    xs = [F.col(f"_{i}") for i in range(d)]
    # one test over an array: a conjunction of hundreds of terms nests too deeply
    base = base.where(F.forall(F.array(*xs), lambda v: v.isNotNull() & ~F.isnan(v)))
    # sums of squares are taken around the overall mean, so large offsets do not cancel
    centre = base.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)]).collect()[0]  # one row
    shift = np.array([centre[f"m{i}"] or 0.0 for i in range(d)])
    gram = _gram(base.select(F.array(*xs).alias("_x")), shift)
    if group is None:
        return {None: (int(gram[-1, -1]), gram[-1, :-1])}, gram[:-1, :-1], shift
    sums = [F.sum(x - F.lit(float(m))).alias(f"s{i}") for i, (x, m) in enumerate(zip(xs, shift))]
    rows = base.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), *sums).limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"{group}: more than {MAX_GROUPS} classes")
    return {r[0]: (r[1], np.array(r[2:], float)) for r in rows}, gram[:-1, :-1], shift


def _fix_signs(vecs: np.ndarray) -> np.ndarray:
    """Make the largest-|loading| entry of each column positive (deterministic sign)."""
    idx = np.argmax(np.abs(vecs), axis=0)
    signs = np.sign(vecs[idx, np.arange(vecs.shape[1])])
    signs[signs == 0] = 1
    return vecs * signs


def _project(df: DataFrame, columns, centre, vecs, prefix: str) -> DataFrame:
    exprs = {}
    for j in range(vecs.shape[1]):
        terms = [(F.col(c).cast("double") - F.lit(float(centre[i]))) * F.lit(float(vecs[i, j])) for i, c in enumerate(columns)]
        while len(terms) > 1:  # a balanced sum: hundreds of terms in a row nest too deeply
            terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
        exprs[f"{prefix}{j}"] = terms[0]
    return df.withColumns(exprs)


class LinearProjection:
    """Fitted projection: ``centre`` (d), ``components`` (d x k), ``values`` (k)."""

    def __init__(self, columns, centre, components, values, prefix):
        self.columns, self.centre, self.components, self.values, self.prefix = list(columns), centre, components, values, prefix

    def transform(self, df: DataFrame) -> DataFrame:
        return _project(df, self.columns, self.centre, self.components, self.prefix)

    def table(self, spark) -> DataFrame:
        rows = [
            (j, float(self.values[j]), self.columns[i], float(self.components[i, j]))
            for j in range(self.components.shape[1])
            for i in range(len(self.columns))
        ]
        return spark.createDataFrame(rows, "component int, value double, feature string, loading double")


def fit_pca(df: DataFrame, columns: Sequence[str], k: int, scale: bool = False) -> LinearProjection:
    """Centred PCA (F1); ``k`` must not exceed the number of columns.  ``scale=True``
    standardises first (PCA on the correlation matrix)."""
    d = len(columns)
    if not 1 <= k <= d:
        raise ValueError(f"k must be in 1..{d}")
    stats, p, shift = _moments(df, columns)
    n, s = stats[None]
    mean = shift + s / n
    cov = (p - np.outer(s, s) / n) / (n - 1)
    if scale:
        sd = np.sqrt(np.diag(cov))
        sd[sd == 0] = 1.0
        cov = cov / np.outer(sd, sd)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1][:k]
    comps = _fix_signs(vecs[:, order])
    if scale:
        comps = comps / sd[:, None]
    return LinearProjection(columns, mean, comps, vals[order], "pca_")


def pca(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """Input plus ``pca_0 .. pca_{k-1}`` (all source columns kept)."""
    return fit_pca(df, columns, k).transform(df)



def fit_svd(df: DataFrame, columns: Sequence[str], k: int) -> LinearProjection:
    """Top-k right singular vectors of the (uncentred) matrix from its Gram matrix
    (D34).  ``transform`` gives ``U * S`` = ``X V`` in ``svd_0 ..``."""
    d = len(columns)
    if not 1 <= k <= d:
        raise ValueError(f"k must be in 1..{d}")
    stats, p, shift = _moments(df, columns)
    n, s = stats[None]
    gram = p + np.outer(s, shift) + np.outer(shift, s) + n * np.outer(shift, shift)
    vals, vecs = np.linalg.eigh(gram)
    order = np.argsort(vals)[::-1][:k]
    return LinearProjection(columns, np.zeros(d), _fix_signs(vecs[:, order]), np.sqrt(np.clip(vals[order], 0, None)), "svd_")


def fit_flda(df: DataFrame, columns: Sequence[str], label: str, k: int | None = None, ridge: float = 1e-9) -> LinearProjection:
    """Fisher discriminant directions (D35): per-class sums in one grouped aggregate, cross
    products over all classes together, then ``Sw^-1 Sb`` on the driver.  At most classes - 1
    directions."""
    stats, sw, shift = _moments(df, columns, group=label)
    d = len(columns)
    n_all = sum(n for n, _ in stats.values())
    mean_all = sum(s for _, s in stats.values()) / n_all
    sb = np.zeros((d, d))
    for n, s in stats.values():
        m = s / n
        sw = sw - n * np.outer(m, m)
        diff = m - mean_all
        sb += n * np.outer(diff, diff)
    k = k or min(d, len(stats) - 1)
    vals, vecs = np.linalg.eig(np.linalg.solve(sw + ridge * np.eye(d), sb))
    vals, vecs = vals.real, vecs.real
    order = np.argsort(vals)[::-1][:k]
    comps = vecs[:, order]
    comps = comps / np.linalg.norm(comps, axis=0)
    return LinearProjection(columns, shift + mean_all, _fix_signs(comps), vals[order], "lda_")


# ------------------------------------------------------------------ anomalies

def fit_anomaly_bounds(
    df: DataFrame, columns: Sequence[str], method: str = "iqr", k: float | None = None, group_by: Sequence[str] = ()
) -> DataFrame:
    """Fences per (group, column): ``iqr`` -> [q1 - k*IQR, q3 + k*IQR] (k = 1.5, exact
    quartiles); ``zscore`` -> mean +- k*std (k = 3).  Long table ``(group..., col, lo, hi)``."""
    g = list(group_by)
    stacked = df.select(
        *g, F.inline(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v")) for c in columns]))
    )
    if method == "iqr":
        k = 1.5 if k is None else k
        q = exact_percentiles(stacked, "v", [0.25, 0.75], group_by=g + ["col"], names=["q1", "q3"])
        iqr = F.col("q3") - F.col("q1")
        return q.select(*g, "col", (F.col("q1") - k * iqr).alias("lo"), (F.col("q3") + k * iqr).alias("hi"))
    if method == "zscore":
        k = 3.0 if k is None else k
        v = F.nanvl(F.col("v"), F.lit(None).cast("double"))
        st = stacked.groupBy(*g, "col").agg(F.avg(v).alias("mu"), F.stddev_samp(v).alias("sd"))
        st = st.select(*g, "col", (F.col("mu") - k * F.col("sd")).alias("lo"), (F.col("mu") + k * F.col("sd")).alias("hi"))
        return cut_lineage(st) if g else st
    raise ValueError("method must be 'iqr' or 'zscore'")


def flag_anomalies(df: DataFrame, bounds: DataFrame, columns: Sequence[str], group_by: Sequence[str] = ()) -> DataFrame:
    """Adds ``<col>_outlier`` (boolean; null where the value is null)."""
    g = list(group_by)
    wide = bounds.groupBy(*g).pivot("col", list(columns)).agg(F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    if g:
        out = join_groups(df, wide, g, "left")
    else:
        r = wide.collect()[0].asDict()
        out = df.withColumns({f"{c}_lo": F.lit(r[f"{c}_lo"]) for c in columns}).withColumns({f"{c}_hi": F.lit(r[f"{c}_hi"]) for c in columns})
    out = out.withColumns(
        {f"{c}_outlier": (F.col(c) < F.col(f"{c}_lo")) | (F.col(c) > F.col(f"{c}_hi")) for c in columns}
    )
    return out.drop(*[f"{c}_lo" for c in columns], *[f"{c}_hi" for c in columns])


# ------------------------------------------------------------------ selection

def _value(c: str) -> Column:
    """The column as a double; NaN counts as missing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def rank_features(df: DataFrame, features: Sequence[str], target: str | None = None, method: str = "pearson") -> DataFrame:
    """Score every feature in ONE aggregate and rank: ``pearson`` (|corr| with target) or
    ``variance`` (sample variance).  Returns ``(feature, score, rank)``, rank 1 = best."""
    if method == "pearson":
        aggs = [F.nanvl(F.abs(F.corr(_value(f), _value(target))), F.lit(None).cast("double")).alias(f) for f in features]
    elif method == "variance":
        aggs = [F.nanvl(F.var_samp(_value(f)), F.lit(None).cast("double")).alias(f) for f in features]
    else:
        raise ValueError("method must be 'pearson' or 'variance' (chi2: select_chi2)")
    wide = df.agg(*aggs)
    long = wide.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("score")) for f in features])))
    # at most len(features) rows: a window over the whole (tiny) table is bounded
    from pyspark.sql import Window

    return long.withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc_nulls_last(), F.col("feature"))))



def _chi2_tail(x: float, dof: int) -> float:
    """P(chi-squared with ``dof`` degrees > x): the regularised upper incomplete gamma function."""
    import math

    if dof <= 0 or x <= 0:
        return 1.0
    s, y = dof / 2.0, x / 2.0
    scale = math.exp(s * math.log(y) - y - math.lgamma(s))
    if y < s + 1:  # power series of the lower function
        term = total = 1.0 / s
        k = s
        while term > total * 1e-17:
            k += 1
            term *= y / k
            total += term
        return min(1.0, max(0.0, 1.0 - scale * total))
    # continued fraction, evaluated from behind
    f = 0.0
    for k in range(int(200 + 4 * math.sqrt(y) + s), 0, -1):
        f = k * (s - k) / (y + 2 * k + 1 - s + f)
    return min(1.0, scale / (y + 1 - s + f))


def rank_chi2(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Chi-squared test of independence of every feature and the label.

    ``(feature, statistic, dof, p_value, rank)`` from one contingency aggregate of all
    features (values of any type, compared as text; rows with a missing value or label are
    left out of that feature's table).  Rank 1 has the smallest p-value, then the largest
    statistic, then the first name."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("v")) for f in features])
    cells = df.select(F.col(label).cast("string").alias("y"), F.inline(pairs)).where("v IS NOT NULL AND y IS NOT NULL")
    cells = cut_lineage(cells.groupBy("feature", "v", "y").agg(F.count(F.lit(1)).cast("double").alias("o")))
    rows = cells.groupBy("feature", "v").agg(F.sum("o").alias("r"))
    cols = cells.groupBy("feature", "y").agg(F.sum("o").alias("c"))
    # sum over cells of o^2 / (r c); empty cells add nothing
    share = cells.join(rows, ["feature", "v"]).join(cols, ["feature", "y"]).groupBy("feature").agg(
        F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))).alias("q"), F.sum("o").alias("n"),
    )
    sizes = rows.groupBy("feature").agg(F.count(F.lit(1)).alias("nr")).join(cols.groupBy("feature").agg(F.count(F.lit(1)).alias("nc")), "feature")
    got = {r["feature"]: r for r in share.join(sizes, "feature").collect()}  # one row per feature
    out = []
    for f in features:
        if f in got:
            r = got[f]
            stat, dof = max(0.0, r["n"] * (r["q"] - 1.0)), (r["nr"] - 1) * (r["nc"] - 1)
            out.append((f, stat, dof, _chi2_tail(stat, dof)))
        else:
            out.append((f, None, None, None))
    out.sort(key=lambda r: (r[3] is None, r[3] or 0.0, -(r[1] or 0.0), r[0]))
    return df.sparkSession.createDataFrame(
        [(*r, i + 1) for i, r in enumerate(out)], "feature string, statistic double, dof long, p_value double, rank int"
    )


def select_chi2(df: DataFrame, features: Sequence[str], label: str, n: int) -> list[str]:
    """The ``n`` features that depend most on the label by `rank_chi2`, best first."""
    return [r["feature"] for r in rank_chi2(df, features, label).orderBy("rank").limit(n).collect()]


# ------------------------------------------------------------------ importance

def linear_importance(df: DataFrame, features: Sequence[str], label: str, kind: str = "regression") -> DataFrame:
    """|coefficient x feature std| of a linear / logistic model (D32): ``(feature, importance)``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    v = VectorAssembler(inputCols=list(features), outputCol="_f", handleInvalid="skip").transform(df)
    est = LinearRegression(featuresCol="_f", labelCol=label) if kind == "regression" else LogisticRegression(featuresCol="_f", labelCol=label)
    v = v.where(F.col(label).isNotNull())  # the rows that the fit sees
    model = est.fit(v)
    # several classes: root mean square of a feature's coefficients over the classes
    coef = model.coefficients.toArray() if kind == "regression" else np.sqrt((model.coefficientMatrix.toArray() ** 2).mean(0))
    sds = v.agg(*[F.stddev_samp(F.col(f).cast("double")).alias(f) for f in features]).collect()[0]  # one row
    rows = [(f, float(abs(c * (sds[f] or 0.0)))) for f, c in zip(features, coef)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def forest_importance(model, features: Sequence[str], spark) -> DataFrame:
    """Impurity importance of a fitted tree ensemble (D33): ``(feature, importance)``."""
    stage = model.stages[-1] if hasattr(model, "stages") else model
    imp = stage.featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
