"""Column-level helpers.  All built-in expressions: they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c, default: int = 0) -> Column:
    """String/number -> bigint with a fallback.

    ``try_cast`` truncates doubles (12.7 -> 12), trims blanks (' 7 ' -> 7) and gives
    null for text such as '12.7', 'x', '' - those, null, NaN and +-inf take ``default``.
    """
    return F.coalesce(_c(c).try_cast("bigint"), F.lit(int(default)).cast("bigint"))


def to_double(c, default: float = 0.0, nan_to_default: bool = False) -> Column:
    """String/number -> double with a fallback (T2).  'NaN', 'inf', '1e3' parse."""
    v = _c(c).try_cast("double")
    if nan_to_default:
        v = F.nanvl(v, F.lit(None).cast("double"))
    return F.coalesce(v, F.lit(float(default)))


def safe_div(a, b) -> Column:
    """Division that is null instead of an ANSI error when the divisor is 0."""
    return F.try_divide(_c(a), _c(b))


_SCALERS = {
    # invalid domain -> null, never an error or NaN
    "log": lambda x: F.when(x > 0, F.ln(x)),
    "log10": lambda x: F.when(x > 0, F.log10(x)),
    "log2": lambda x: F.when(x > 0, F.log2(x)),
    "log1p": lambda x: F.when(x > -1, F.log1p(x)),
    "sqrt": lambda x: F.when(x >= 0, F.sqrt(x)),
    "abs": lambda x: F.abs(x),
    "square": lambda x: x * x,
    "exp": lambda x: F.exp(x),
}


def scale_expr(c, fn: str) -> Column:
    """Named unary feature scaling."""
    if fn not in _SCALERS:
        raise ValueError(f"unknown scaling {fn!r}; expected one of {sorted(_SCALERS)}")
    return _SCALERS[fn](_c(c).cast("double"))
