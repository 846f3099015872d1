"""Recency / frequency / monetary (D16) and quintile scores with segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepframe.operators.ordering import ntile_expr, ordered_totals

# fixed segment rules (our definition; the original names the component only):
#   r >= 4 and f >= 4 -> champion;  r >= 4 and f <= 2 -> new;
#   r <= 2 and f >= 4 -> at_risk;   r <= 2 and f <= 2 -> lost;  otherwise regular


def rfm_process(df: DataFrame, customer: str, date: str, amount: str, as_of=None) -> DataFrame:
    """Per customer: ``recency`` (days from the last purchase to ``as_of``),
    ``frequency`` (purchases) and ``monetary`` (sum of ``amount``) - one partial aggregate.
    ``as_of`` defaults to the day after the latest purchase."""
    if as_of is None:
        last = df.agg(F.max(date)).collect()[0][0]
        as_of_col = F.date_add(F.lit(last).cast("date"), 1)
    else:
        as_of_col = F.lit(as_of).cast("date")
    return df.groupBy(customer).agg(
        F.datediff(as_of_col, F.max(F.col(date)).cast("date")).alias("recency"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum(F.col(amount).cast("double")).alias("monetary"),
    )


def _score(df: DataFrame, column: str, key: str, ascending: bool, bins: int, out: str, n: int) -> DataFrame:
    ranked = ordered_totals(df, [(column, ascending), key])
    return ranked.withColumn(out, ntile_expr(F.col("_rn"), F.lit(n), bins)).drop("_rn")


def rfm_scores(rfm: DataFrame, customer: str, bins: int = 5) -> DataFrame:
    """``r_score, f_score, m_score`` in ``1..bins`` (``ntile`` over the whole table with the
    customer key as tie-break; recent = high), ``rfm_code`` and ``segment``."""
    n = rfm.count()
    s = _score(rfm, "recency", customer, False, bins, "r_score", n)
    s = _score(s, "frequency", customer, True, bins, "f_score", n)
    s = _score(s, "monetary", customer, True, bins, "m_score", n)
    r, f = F.col("r_score"), F.col("f_score")
    hi, lo = bins - 1, 2
    seg = (
        F.when((r >= hi) & (f >= hi), "champion")
        .when((r >= hi) & (f <= lo), "new")
        .when((r <= lo) & (f >= hi), "at_risk")
        .when((r <= lo) & (f <= lo), "lost")
        .otherwise("regular")
    )
    return s.withColumn("rfm_code", F.concat_ws("", "r_score", "f_score", "m_score")).withColumn("segment", seg)
