"""Splitting and sampling (P1, P2, D24).  All predicates are narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_SPACE = 2**32


def hash_bucket(key, seed: int | None = None) -> Column:
    """Deterministic 32-bit bucket: first 8 hex digits of ``md5(key)`` (or of
    ``'<seed>:<key>'``).  The same expression is plain SQL in other engines."""
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    if seed is not None:
        k = F.concat(F.lit(f"{seed}:"), k)
    return F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint")


def split_ratio(df: DataFrame, ratio: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Random split into ``ratio`` / ``1 - ratio`` (P1).  Reproducible for a fixed input layout."""
    if not 0 < ratio < 1:
        raise ValueError("ratio must be in (0, 1)")
    a, b = df.randomSplit([ratio, 1 - ratio], seed=seed)
    return a, b


def split_hash(df: DataFrame, key: str, ratio: float, seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of ``key``: independent of partitioning, disjoint and complete."""
    if not 0 < ratio < 1:
        raise ValueError("ratio must be in (0, 1)")
    cut = int(ratio * HASH_SPACE)
    b = hash_bucket(key, seed)
    return df.where(b < cut), df.where(b >= cut)


def split_threshold(df: DataFrame, column: str, threshold: float, nulls: str = "drop") -> tuple[DataFrame, DataFrame]:
    """Rows with ``column >= threshold`` and ``column < threshold``.

    ``nulls``: ``drop`` (in neither part), ``left`` or ``right``.
    """
    x = F.col(column)
    hi, lo = x >= threshold, x < threshold
    if nulls == "left":
        hi = hi | x.isNull()
    elif nulls == "right":
        lo = lo | x.isNull()
    elif nulls != "drop":
        raise ValueError("nulls must be 'drop', 'left' or 'right'")
    return df.where(hi), df.where(lo)


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42, with_replacement: bool = False) -> DataFrame:
    """Bernoulli (or Poisson with replacement) sample of about ``fraction`` of the rows."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def sample_hash(df: DataFrame, key: str, fraction: float, seed: int | None = None) -> DataFrame:
    """Reproducible sample: rows whose key hashes below ``fraction``."""
    return df.where(hash_bucket(key, seed) < int(fraction * HASH_SPACE))


def sample_n(df: DataFrame, n: int, key: str, seed: int | None = None) -> DataFrame:
    """Exactly ``min(n, count)`` rows: the ``n`` smallest key hashes (ties by key), found by
    histogram refinement and kept by a filter: the table is neither sorted nor shuffled."""
    from prepframe.operators.ordering import first_rows

    return first_rows(df.withColumn("_h", hash_bucket(key, seed)), ["_h", key], n).drop("_h")


def sample_stratified(
    df: DataFrame, column: str, fractions: dict, key: str | None = None, seed: int = 42
) -> DataFrame:
    """Per-stratum fractions.  With ``key`` the draw is a hash predicate (reproducible and
    SQL-checkable); without it Spark's ``sampleBy``."""
    if key is None:
        return df.sampleBy(column, fractions, seed)
    cut = F.lit(None).cast("bigint")
    for v, f in fractions.items():
        cut = F.when(F.col(column) == F.lit(v), F.lit(int(f * HASH_SPACE))).otherwise(cut)
    return df.where(hash_bucket(key, seed) < cut)
