"""Relational reshaping (D1-D15): joins, stacking, grouping, pivots, dedupe, sort, ids.

Everything is declarative DataFrame code so Catalyst prunes columns, pushes filters
to the scan and AQE picks join strategies / splits skewed partitions at runtime.
Group operations that would need a whole group in one task (keep-first dedupe,
exact medians, dense ids) use partial aggregates or the distributed ordering
helper instead of a window over the group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, NumericType

from prepframe.operators.ordering import first_rows, exact_percentiles, ordered_totals

_HOWS = {
    "inner": "inner", "left": "left", "right": "right", "full": "full", "outer": "full",
    "semi": "left_semi", "left_semi": "left_semi", "anti": "left_anti", "left_anti": "left_anti",
}


# ------------------------------------------------------------------ D1 join

def join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    how: str = "inner",
    suffixes: tuple[str, str] = ("", "_right"),
) -> DataFrame:
    """Equi-join on key columns.

    ``on`` is a column name, a list (same names both sides) or ``{left: right}``.
    Non-key columns present on both sides get ``suffixes``.  The join strategy is left
    to Catalyst/AQE, which goes by bytes.  Pair-producing joins without keys are not offered.
    """
    if how not in _HOWS:
        raise ValueError(f"how must be one of {sorted(_HOWS)}")
    jt = _HOWS[how]
    pairs = list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in ([on] if isinstance(on, str) else on)]
    if not pairs:
        raise ValueError("join needs at least one key")
    lkeys, rkeys = [p[0] for p in pairs], [p[1] for p in pairs]
    if jt in ("left_semi", "left_anti"):
        cond = [left[l] == right[r] for l, r in pairs]
        return left.join(right, cond, jt)
    lrest = [c for c in left.columns if c not in lkeys]
    rrest = [c for c in right.columns if c not in rkeys]
    clash = set(lrest) & set(rrest)
    la = left.select(
        *[F.col(k).alias(f"_lk{i}") for i, k in enumerate(lkeys)],
        *[F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c) for c in lrest],
    )
    ra = right.select(
        *[F.col(k).alias(f"_rk{i}") for i, k in enumerate(rkeys)],
        *[F.col(c).alias(c + suffixes[1]) if c in clash else F.col(c) for c in rrest],
    )
    joined = la.join(ra, [la[f"_lk{i}"] == ra[f"_rk{i}"] for i in range(len(pairs))], jt)
    keys_out = []
    for i, (lk, rk) in enumerate(pairs):
        if lk == rk:  # one key column; a full/right join takes the right value where the left is absent
            keys_out.append(F.coalesce(F.col(f"_lk{i}"), F.col(f"_rk{i}")).alias(lk))
        else:
            keys_out += [F.col(f"_lk{i}").alias(lk), F.col(f"_rk{i}").alias(rk)]
    rest = [c for c in la.columns if not c.startswith("_lk")] + [c for c in ra.columns if not c.startswith("_rk")]
    return joined.select(*keys_out, *rest)


# ------------------------------------------------------------------ D2, D3

def merge_rows(*frames: DataFrame) -> DataFrame:
    """Stack tables by column name; missing columns become null (D2, union all)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def merge_columns(left: DataFrame, right: DataFrame, key: str | Sequence[str], suffix: str = "_right") -> DataFrame:
    """Side by side on a key, keeping rows from both sides (full outer join, D3)."""
    keys = [key] if isinstance(key, str) else list(key)
    return join(left, right, keys, "full", ("", suffix))


# ------------------------------------------------------------------ D4, D7, D12, D6

def select_columns(df: DataFrame, keep: Sequence[str] | None = None, drop: Sequence[str] | None = None) -> DataFrame:
    """Keep a list or drop a list."""
    if keep is not None:
        return df.select(*keep)
    return df.drop(*(drop or []))


def add_column(df: DataFrame, name: str, sql_expr: str) -> DataFrame:
    """New column from a SQL expression, e.g. ``'a * 2 + b'``."""
    return df.withColumn(name, F.expr(sql_expr))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns in place."""
    return df.withColumnsRenamed(dict(mapping))


def replace_values(df: DataFrame, mapping: Mapping[str, Mapping]) -> DataFrame:
    """Per-column value maps ``{col: {old: new}}`` (D6).  Unmapped values are kept."""
    exprs = {}
    for c, m in mapping.items():
        e: Column = F.col(c)
        for old, new in m.items():
            cond = F.col(c).isNull() if old is None else (F.col(c) == F.lit(old))
            e = F.when(cond, F.lit(new)).otherwise(e)
        exprs[c] = e
    return df.withColumns(exprs)


def replace_regex(df: DataFrame, column: str, pattern: str, replacement: str) -> DataFrame:
    """Regex replacement inside a string column."""
    return df.withColumn(column, F.regexp_replace(F.col(column), pattern, replacement))


# ------------------------------------------------------------------ D5 group by

_SIMPLE = {
    "count": lambda c: F.count(F.lit(1)) if c in (None, "*") else F.count(c),
    "count_distinct": lambda c: F.count_distinct(c),
    "sum": F.sum, "avg": F.avg, "mean": F.avg, "min": F.min, "max": F.max,
    "stddev": F.stddev_samp, "stddev_pop": F.stddev_pop, "variance": F.var_samp, "var_pop": F.var_pop,
    "approx_median": lambda c: F.percentile_approx(c, 0.5, 10000),
}


def group_by(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, tuple]) -> DataFrame:
    """Grouped aggregates (D5).  ``aggs`` maps output name to ``(fn, col)`` or
    ``(fn, col, order_col)`` for ``first``/``last`` by order.

    Algebraic functions are partial aggregates (map-side combine).  ``median`` is
    exact and goes through the distributed ordering helper; ``first``/``last`` are
    ``min_by``/``max_by`` - also partial, so a hot key never lands in one task.
    """
    keys = list(keys)
    simple, medians = [], []
    for out, spec in aggs.items():
        fn, col = spec[0], spec[1]
        if fn == "median":
            medians.append((out, col))
        elif fn in ("first", "last"):
            order = spec[2]
            pick = F.min_by if fn == "first" else F.max_by
            simple.append(pick(F.col(col), F.struct(F.col(order), F.col(col))).alias(out))
        elif fn in _SIMPLE:
            simple.append(_SIMPLE[fn](col).alias(out))
        else:
            raise ValueError(f"unknown aggregate {fn!r}")
    res = df.groupBy(*keys).agg(*simple) if simple else df.select(*keys).distinct()
    for out, col in medians:
        med = exact_percentiles(df, col, [0.5], group_by=keys, names=[out])
        res = res.join(med, [res[k].eqNullSafe(med[k]) for k in keys], "left").drop(*[med[k] for k in keys]) if keys else _attach_scalar(res, med)
    return res


def _attach_scalar(res: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row statistics frame to every row of ``res`` as literals
    (the statistics are collected: one row), so no join is planned."""
    row = one_row.collect()
    vals = row[0].asDict() if row else {c: None for c in one_row.columns}
    return res.withColumns({c: F.lit(v).cast(one_row.schema[c].dataType) for c, v in vals.items()})


# ------------------------------------------------------------------ D8-D10 reshape

def transpose(df: DataFrame, index_col: str) -> DataFrame:
    """Rows <-> columns of a SMALL table by an index column (D8); Spark bounds the
    number of rows by ``spark.sql.transposeMaxValues``."""
    return df.transpose(F.col(index_col))


def table_to_kv(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None, key: str = "k", value: str = "v") -> DataFrame:
    """Wide -> long ``(ids..., k, v)`` (D9).  Value columns must share a type."""
    values = list(values) if values is not None else [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), values, key, value)


def kv_to_table(df: DataFrame, ids: Sequence[str], key: str, value: str, keys: Sequence) -> DataFrame:
    """Long -> wide, one column per key in ``keys`` (explicit: no distinct pass);
    absent (id, key) pairs are null; a repeated pair keeps its largest value, so the
    result does not depend on row order (D10)."""
    return df.groupBy(*ids).pivot(key, list(keys)).agg(F.max(value))


# ------------------------------------------------------------------ D11 missing values

def _join_groups(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join of two per-group tables; null keys are one group."""
    right = b.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    both = a.join(right, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys], "full")
    # a key missing on the left side comes from the right one (null on both: the null group)
    return both.withColumns({k: F.coalesce(F.col(k), F.col(f"_r_{k}")) for k in keys}).drop(*[f"_r_{k}" for k in keys])


def handle_missing(
    df: DataFrame,
    columns: Sequence[str],
    strategy: str = "drop",
    value=None,
    group_by: Sequence[str] = (),
    how: str = "any",
) -> DataFrame:
    """Missing values (D11): ``drop`` rows (any/all of ``columns`` null), or fill with
    ``constant``, ``mean``, ``median`` (exact), or ``mode`` (most frequent, ties to the
    smallest), optionally per group.  NaN counts as missing for numeric columns."""
    cols = list(columns)

    def missing(c):
        if isinstance(df.schema[c].dataType, NumericType):
            return F.col(c).isNull() | F.isnan(F.col(c))
        return F.col(c).isNull()

    if strategy == "drop":
        conds = [missing(c) for c in cols]
        bad = conds[0]
        for c in conds[1:]:
            bad = (bad | c) if how == "any" else (bad & c)
        return df.where(~bad)
    if strategy == "constant":
        return df.withColumns({c: F.when(missing(c), F.lit(value)).otherwise(F.col(c)) for c in cols})
    g = list(group_by)
    clean = {c: F.when(~missing(c), F.col(c)) for c in cols}
    if strategy == "mean":
        stats = df.groupBy(*g).agg(*[F.avg(clean[c]).alias(f"_fill_{c}") for c in cols])
    elif strategy == "median":
        stats = None
        for c in cols:
            m = exact_percentiles(df.select(*g, clean[c].alias(c)), c, [0.5], group_by=g, names=[f"_fill_{c}"])
            stats = m if stats is None else (_join_groups(stats, m, g) if g else _attach_scalar(stats, m))
    elif strategy == "mode":
        stats = None
        for c in cols:
            cnt = df.where(~missing(c)).groupBy(*g, c).agg(F.count(F.lit(1)).alias("_n"))
            # most frequent, ties to the smallest value: max_by over (count, -rank of value)
            m = cnt.groupBy(*g).agg(F.min_by(F.col(c), F.struct(-F.col("_n"), F.col(c))).alias(f"_fill_{c}"))
            stats = m if stats is None else (_join_groups(stats, m, g) if g else _attach_scalar(stats, m))
    else:
        raise ValueError("strategy must be drop, constant, mean, median or mode")
    if g:
        joined = df.join(stats, [df[k].eqNullSafe(stats[k]) for k in g], "left").drop(*[stats[k] for k in g])
    else:
        joined = _attach_scalar(df, stats)
    filled = joined.withColumns(
        {c: F.when(missing(c), F.col(f"_fill_{c}").cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in cols}
    )
    return filled.drop(*[f"_fill_{c}" for c in cols])


# ------------------------------------------------------------------ D13 ids

def add_id(df: DataFrame, name: str = "id", order_by: Sequence | None = None, start: int = 1) -> DataFrame:
    """Dense ids ``start..`` in ``order_by`` order (make it total with a unique key), via
    the distributed ordering helper; without ``order_by`` fast unique (non-dense) ids
    from ``monotonically_increasing_id`` (D13)."""
    if not order_by:
        return df.withColumn(name, F.monotonically_increasing_id())
    ranked = ordered_totals(df, list(order_by))
    return ranked.withColumn(name, F.col("_rn") + (start - 1)).drop("_rn")


# ------------------------------------------------------------------ D14 dedupe

def drop_duplicates(df: DataFrame, keys: Sequence[str] | None = None, order_by: Sequence[str] | None = None, keep: str = "first") -> DataFrame:
    """Whole-row distinct, or one row per ``keys``.

    With ``order_by`` the kept row is the first (or last) in that order, ties broken
    by the remaining columns: a ``min``/``max`` over a struct - a partial aggregate,
    so a key holding a third of the rows is pre-reduced on every map task."""
    if not keys:
        return df.distinct()
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not order_by:
        return df.dropDuplicates(keys)
    order_by = list(order_by)
    # maps cannot be compared: they ride along behind the comparable columns
    others = [c for c in rest if c not in order_by and not isinstance(df.schema[c].dataType, MapType)]
    maps = [c for c in rest if isinstance(df.schema[c].dataType, MapType)]
    if maps:
        pick = F.min_by if keep == "first" else F.max_by
        order = F.struct(*[F.col(c) for c in order_by], *[F.col(c) for c in others])
        red = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in rest]), order).alias("_row"))
        return red.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
    packed = F.struct(*[F.col(c) for c in order_by], *[F.col(c) for c in others]).alias("_row")
    pick = F.min if keep == "first" else F.max
    red = df.groupBy(*keys).agg(pick(packed).alias("_row"))
    return red.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


# ------------------------------------------------------------------ D15 sort

def sort_values(
    df: DataFrame,
    by: Sequence[str],
    ascending: bool | Sequence[bool] = True,
    nulls_last: bool | Sequence[bool] = False,
    top_k: int | None = None,
) -> DataFrame:
    """Multi-key sort with per-key direction and null placement (D15).  With ``top_k`` the
    first rows are selected by histogram refinement (`ordering.first_rows`) and only they are
    sorted: no task merges ``top_k`` rows, whatever its size."""
    by = list(by)
    asc = [ascending] * len(by) if isinstance(ascending, bool) else list(ascending)
    nl = [nulls_last] * len(by) if isinstance(nulls_last, bool) else list(nulls_last)
    exprs, items, flags = [], [], {}
    for i, (c, a, n) in enumerate(zip(by, asc, nl)):
        col = F.col(c)
        exprs.append(
            (col.asc_nulls_last() if n else col.asc_nulls_first()) if a else (col.desc_nulls_last() if n else col.desc_nulls_first())
        )
        if a == n:  # not Spark's own null placement: a key of its own before the value
            flags[f"_null_{i}"] = col.isNull()
            items.append((f"_null_{i}", n))
        items.append((c, a))
    if top_k is None:
        return df.orderBy(*exprs)
    return first_rows(df.withColumns(flags) if flags else df, items, top_k).drop(*flags).orderBy(*exprs)
