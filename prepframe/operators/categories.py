"""Category coding.

The fitted category table is long: ``(col string, label string, idx bigint)`` - one
row per (column, category), no delimiter packing.  Codes are assigned by the
distributed ordering helper, so a column with millions of categories never sorts
in one task.  Apply is a left join per column; the category side is broadcast only
after its size has been counted.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepframe._session import cut_lineage
from prepframe.operators.ordering import ordered_totals

_ORDERS = ("frequencyDesc", "frequencyAsc", "alphabetAsc", "alphabetDesc")


def _stack_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("label")) for c in columns]))
    ).where(F.col("label").isNotNull())


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(col, label, cnt)`` for every non-null category, one aggregate for all columns."""
    return _stack_labels(df, columns).groupBy("col", "label").agg(F.count(F.lit(1)).alias("cnt"))


def fit_categories(df: DataFrame, columns: Sequence[str], order: str = "frequencyDesc") -> DataFrame:
    """Code table ``(col, label, idx)`` with ``idx`` from 0.

    ``frequencyDesc`` (Spark's StringIndexer order; ties alphabetical) or
    ``alphabetAsc`` (sorted codes) and their reverses.
    """
    if order not in _ORDERS:
        raise ValueError(f"order must be one of {_ORDERS}")
    counts = category_counts(df, columns)
    keys = {
        "frequencyDesc": [("cnt", False), "label"],
        "frequencyAsc": ["cnt", "label"],
        "alphabetAsc": ["label"],
        "alphabetDesc": [("label", False)],
    }[order]
    ranked = ordered_totals(counts, keys, partition_by=["col"])
    # the code table is read once per coded column and by size checks: materialise it
    return cut_lineage(ranked.select("col", "label", (F.col("_rn") - 1).alias("idx"), "cnt"))


def apply_categories(
    df: DataFrame, codes: DataFrame, columns: Sequence[str] | None = None, unseen: int | str = -1
) -> DataFrame:
    """Replace each coded column by its ``idx`` (T4).

    Unseen labels and nulls get ``unseen`` (default -1); ``unseen="keep"`` gives
    both the code ``numLabels`` of that column, as StringIndexer(handleInvalid="keep").
    """
    # names of the coded columns: one row per column
    cols = list(columns) if columns is not None else [r["col"] for r in codes.select("col").distinct().collect()]
    out = df
    for c in cols:
        mine = codes.where(F.col("col") == c)
        if unseen == "keep":
            fallback = F.lit(mine.count()).cast("bigint")
        else:
            fallback = F.lit(int(unseen)).cast("bigint")
        side = mine.select(F.col("label").alias(f"_lbl_{c}"), F.col("idx").alias(f"_idx_{c}"))
        out = out.join(side, F.col(c).cast("string") == F.col(f"_lbl_{c}"), "left")
        out = out.withColumn(c, F.coalesce(F.col(f"_idx_{c}"), fallback)).drop(f"_lbl_{c}", f"_idx_{c}")
    return out


def _safe_name(s: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", s)


def one_hot(df: DataFrame, column: str, labels: Sequence[str] | DataFrame, drop: bool = True, max_labels: int = 1000) -> DataFrame:
    """One 0/1 int column ``<column>_<label>`` per category (D28).  ``labels`` is a
    list or a code table; the list is bounded by ``max_labels`` because each label
    becomes a column."""
    if isinstance(labels, DataFrame):
        labels = [r["label"] for r in labels.where(F.col("col") == column).orderBy("idx").limit(max_labels + 1).collect()]
    if len(labels) > max_labels:
        raise ValueError(f"{column}: more than {max_labels} categories for one-hot columns")
    x = F.col(column).cast("string")
    # labels that clean to one name get _2, _3, ... in label order
    names: dict[str, str] = {}
    for v in labels:
        name, i = f"{column}_{_safe_name(str(v))}", 1
        while (name if i == 1 else f"{name}_{i}") in names:
            i += 1
        names[name if i == 1 else f"{name}_{i}"] = str(v)
    out = df.withColumns({name: F.when(x == v, 1).otherwise(0) for name, v in names.items()})
    return out.drop(column) if drop else out


def one_hot_vector(df: DataFrame, column: str, codes: DataFrame, out: str | None = None, drop: bool = True) -> DataFrame:
    """One sparse vector column (default ``<column>_vec``) with a 1 at the category's code.

    The code table is joined, so the number of categories bounds neither the columns nor the
    plan; nulls and categories that the table does not have give the zero vector."""
    from pyspark.ml.feature import OneHotEncoder

    name = out or f"{column}_vec"
    mine = codes.where(F.col("col") == column).select(F.col("label").alias("_hot_label"), F.col("idx").alias("_hot_idx"))
    size = int(mine.agg(F.coalesce(F.max("_hot_idx"), F.lit(-1)) + 1).collect()[0][0])  # one row
    place = F.coalesce(F.col("_hot_idx"), F.lit(size)).cast("double")
    joined = df.join(mine, F.col(column).cast("string") == F.col("_hot_label"), "left")
    placed = joined.withColumn("_hot_place", place).drop("_hot_label", "_hot_idx")
    # The place behind the last category is the one that the encoder drops: a zero vector.
    known = df.sparkSession.createDataFrame([(float(size),)], "_hot_place double")
    made = OneHotEncoder(inputCol="_hot_place", outputCol=name, dropLast=True).fit(known).transform(placed).drop("_hot_place")
    return made.drop(column) if drop else made


def frequency_encode(df: DataFrame, column: str, out: str | None = None, normalize: bool = False) -> DataFrame:
    """Category -> its row count (or share) in ``df``."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_freq"))
    if normalize:
        total = df.count()
        counts = counts.withColumn("_freq", F.col("_freq") / F.lit(float(total)))
    name = out or f"{column}_freq"
    res = df.join(counts, df[column].eqNullSafe(counts[column]), "left").drop(counts[column])
    return res.withColumnRenamed("_freq", name)


def fit_target_encoding(df: DataFrame, column: str, target: str, smoothing: float = 10.0) -> DataFrame:
    """``(label, enc)``: smoothed mean ``(sum_y + m * prior) / (n + m)``."""
    prior = df.agg(F.avg(F.col(target).cast("double"))).collect()[0][0]
    stats = df.groupBy(F.col(column).alias("label")).agg(
        F.sum(F.col(target).cast("double")).alias("_s"), F.count(F.col(target)).alias("_n")
    )
    return stats.select(
        "label",
        ((F.col("_s") + F.lit(smoothing * prior)) / (F.col("_n") + F.lit(smoothing))).alias("enc"),
        F.lit(prior).alias("prior"),
    )


def apply_target_encoding(df: DataFrame, column: str, enc: DataFrame, out: str | None = None) -> DataFrame:
    prior = enc.select("prior").first()
    prior = prior[0] if prior else None
    side = enc.select(F.col("label").alias("_te_l"), F.col("enc").alias("_te"))
    res = df.join(side, F.col(column).eqNullSafe(F.col("_te_l")), "left")
    return res.withColumn(out or f"{column}_te", F.coalesce(F.col("_te"), F.lit(prior))).drop("_te_l", "_te")
