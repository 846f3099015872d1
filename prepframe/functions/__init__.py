from prepframe.functions.columns import (  # noqa: F401
    safe_div,
    scale_expr,
    to_double,
    to_int,
)
