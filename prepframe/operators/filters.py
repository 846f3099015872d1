"""Row filters (D18, D19) and the composed type transform (T1-T4 in one step)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepframe.functions.columns import to_double, to_int
from prepframe.operators.categories import apply_categories, fit_categories


def threshold_filter(df: DataFrame, column: str, lo=None, hi=None, inclusive: bool = True) -> DataFrame:
    """Keep rows with ``lo <= column <= hi`` (either bound optional; nulls dropped)."""
    x = F.col(column)
    cond = x.isNotNull()
    if lo is not None:
        cond = cond & ((x >= lo) if inclusive else (x > lo))
    if hi is not None:
        cond = cond & ((x <= hi) if inclusive else (x < hi))
    return df.where(cond)


def user_filter(df: DataFrame, predicate: str) -> DataFrame:
    """Keep rows matching a SQL predicate string, e.g. ``"a > 3 AND b LIKE 'x%'"``.
    The predicate is parsed by Spark, so it is pushed down like any other filter."""
    return df.where(F.expr(predicate))


def type_transform(
    df: DataFrame,
    to_int_cols: Sequence[str] = (),
    to_double_cols: Sequence[str] = (),
    categorical: Sequence[str] = (),
    default_int: int = 0,
    default_double: float = 0.0,
    codes: DataFrame | None = None,
    order: str = "frequencyDesc",
    unseen: int | str = -1,
):
    """The TypeTransform component as one composable step: integer and double casts with
    defaults, then category coding (fitted here in train mode, or applied from ``codes``
    in predict mode).  Returns ``(frame, codes)``; the steps compose (coding sees the
    cast columns)."""
    out = df.withColumns({c: to_int(c, default_int) for c in to_int_cols})
    out = out.withColumns({c: to_double(c, default_double) for c in to_double_cols})
    if categorical:
        if codes is None:
            codes = fit_categories(out, list(categorical), order)
        out = apply_categories(out, codes, list(categorical), unseen=unseen)
    return out, codes
