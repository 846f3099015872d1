"""Normalisation, clipping and binning.

``fit_*`` computes every column's statistics in ONE aggregate (partial aggregation,
one pass) and returns a long parameter frame with one row per column; ``apply_*``
collects that frame (as many rows as columns) and injects literals in a single
projection, so the transform is a narrow map that also runs on streaming frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepframe.operators.ordering import exact_percentiles, ntile_expr, ordered_totals


def _num(c: str) -> Column:
    # NaN behaves as missing in every fit
    x = F.col(c).cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def _long_params(wide: DataFrame, columns: Sequence[str], stats: Sequence[str]) -> DataFrame:
    rows = [
        F.struct(F.lit(c).alias("col"), *[F.col(f"{s}_{i}").cast("double").alias(s) for s in stats])
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Parameters ``(col string, min double, max double)`` from one aggregate."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.min(_num(c)).alias(f"min_{i}"), F.max(_num(c)).alias(f"max_{i}")]
    return _long_params(df.agg(*aggs), columns, ["min", "max"])


def fit_zscore(df: DataFrame, columns: Sequence[str], ddof: int = 1) -> DataFrame:
    """Parameters ``(col, avg, std)``; sample std by default, ``ddof=0`` population."""
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.avg(_num(c)).alias(f"avg_{i}"), std(_num(c)).alias(f"std_{i}")]
    return _long_params(df.agg(*aggs), columns, ["avg", "std"])


def _params(params: DataFrame) -> dict[str, dict]:
    return {r["col"]: r.asDict() for r in params.collect()}


def _minmax_expr(c: str, lo, hi) -> Column:
    x = F.col(c).cast("double")
    if lo is None or hi is None:
        return F.lit(None).cast("double")
    if hi == lo:  # constant column: 0, null stays null, NaN stays NaN
        return F.when(F.isnan(x), x).when(x.isNotNull(), F.lit(0.0))
    return (x - F.lit(float(lo))) / F.lit(float(hi - lo))


def _zscore_expr(c: str, avg, std) -> Column:
    x = F.col(c).cast("double")
    if avg is None:
        return F.lit(None).cast("double")
    if std is None or std == 0:
        return F.when(F.isnan(x), x).when(x.isNotNull(), F.lit(0.0))
    return (x - F.lit(float(avg))) / F.lit(float(std))


def apply_minmax(df: DataFrame, params: DataFrame) -> DataFrame:
    """``(x - min) / (max - min)`` from a parameter frame (N2); columns keep their place."""
    p = _params(params)
    return df.withColumns({c: _minmax_expr(c, v["min"], v["max"]) for c, v in p.items()})


def apply_zscore(df: DataFrame, params: DataFrame) -> DataFrame:
    """``(x - avg) / std`` from a parameter frame."""
    p = _params(params)
    return df.withColumns({c: _zscore_expr(c, v["avg"], v["std"]) for c, v in p.items()})


def normalize(df: DataFrame, columns: Sequence[str], mode: str = "minMax", ddof: int = 1):
    """Fit + transform; returns ``(transformed, params)`` (NormalizeData)."""
    if mode == "minMax":
        params = fit_minmax(df, columns)
        return apply_minmax(df, params), params
    if mode == "standard":
        params = fit_zscore(df, columns, ddof=ddof)
        return apply_zscore(df, params), params
    raise ValueError(f"mode must be 'minMax' or 'standard', got {mode!r}")


# ---------------------------------------------------------------- clipping

def fit_clip_bounds(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "percentile",
    lower: float = 0.01,
    upper: float = 0.99,
    k: float = 3.0,
) -> DataFrame:
    """Bounds ``(col, lo, hi)``: ``percentile`` (exact) or ``sigma`` (mean +- k * std)."""
    spark = df.sparkSession
    if method == "sigma":
        p = fit_zscore(df, columns)
        return p.select(
            "col",
            (F.col("avg") - F.lit(k) * F.col("std")).alias("lo"),
            (F.col("avg") + F.lit(k) * F.col("std")).alias("hi"),
        )
    if method == "percentile":
        # one exact ranking over the stacked (col, value) pairs instead of one per column
        stacked = df.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v")) for c in columns]))
        )
        return exact_percentiles(stacked, "v", [lower, upper], group_by=["col"], names=["lo", "hi"])
    raise ValueError("method must be 'percentile' or 'sigma'")


def clip(df: DataFrame, bounds: DataFrame | dict) -> DataFrame:
    """Clip columns into ``[lo, hi]``; ``bounds`` is a frame from ``fit_clip_bounds``
    or a dict ``{col: (lo, hi)}`` of given bounds."""
    if isinstance(bounds, DataFrame):
        # bounds table: one row per column
        bounds = {r["col"]: (r["lo"], r["hi"]) for r in bounds.collect()}
    exprs = {}
    for c, (lo, hi) in bounds.items():
        x = F.col(c).cast("double")
        if lo is not None:
            x = F.when(x < lo, F.lit(float(lo))).otherwise(x)
        if hi is not None:
            x = F.when(x > hi, F.lit(float(hi))).otherwise(x)
        exprs[c] = x
    return df.withColumns(exprs)


# ---------------------------------------------------------------- binning

def fit_width_bins(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Equal-width bins are fitted by min/max."""
    return fit_minmax(df, columns)


def apply_width_bins(df: DataFrame, params: DataFrame, n: int, suffix: str = "_bin") -> DataFrame:
    """Bin index in ``0..n-1``: ``least(floor((x - min) / width), n - 1)``."""
    exprs = {}
    for c, v in _params(params).items():
        x = F.col(c).cast("double")
        lo, hi = v["min"], v["max"]
        if lo is None or hi is None or hi == lo:
            exprs[c + suffix] = F.when(x.isNotNull() & ~F.isnan(x), F.lit(0))
        else:
            w = (hi - lo) / n
            b = F.floor((x - F.lit(float(lo))) / F.lit(float(w)))
            exprs[c + suffix] = F.when(~F.isnan(x), F.least(F.greatest(b, F.lit(0)), F.lit(n - 1)).cast("int"))
    return df.withColumns(exprs)


def quantile_edges(df: DataFrame, column: str, n: int) -> list[float]:
    """Exact inner edges (k/n percentiles, k = 1..n-1) for ``n`` equal-frequency bins."""
    qs = [k / n for k in range(1, n)]
    row = exact_percentiles(df, column, qs).collect()[0]
    return [row[f"q_{i}"] for i in range(len(qs))]


def bucketize(df: DataFrame, column: str, edges: Sequence[float], out: str | None = None) -> DataFrame:
    """Bin index = number of edges ``<= x`` (left-closed bins) - a Bucketizer as an expression."""
    x = F.col(column).cast("double")
    idx = sum((F.when(x >= F.lit(float(e)), 1).otherwise(0) for e in edges), F.lit(0))
    return df.withColumn(out or column + "_bin", F.when(x.isNotNull() & ~F.isnan(x), idx.cast("int")))


def equal_frequency_bins(df: DataFrame, column: str, n: int, tie_key: str, out: str | None = None) -> DataFrame:
    """SQL ``ntile(n) over (order by column, tie_key)`` - 1, without a global window."""
    ranked = ordered_totals(df, [column, tie_key], group_totals=True)
    return ranked.withColumn(out or column + "_bin", ntile_expr(F.col("_rn"), F.col("_tot_n"), n) - 1).drop("_rn", "_tot_n")
