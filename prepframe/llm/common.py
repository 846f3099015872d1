"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepframe._session import checkpoint_dir, cut_lineage, ship_package

# Rows per Arrow batch handed to a task: texts can be long, so batches are kept short.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Ship the package to the workers and bound the Arrow batches of this session."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: str = "text"):
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema) -> DataFrame:
    """``mapInArrow`` with one output batch (or None) per non-empty input batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = fn(b)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.

    Spark does so when the driver's JVM collects plans that nothing refers to any more;
    a driver with a roomy heap may not collect for half an hour.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bitmap_flag(df: DataFrame, key: str, wanted: DataFrame, flag: str = "_maybe", bits: int = 25) -> DataFrame:
    """Add a boolean: false only for rows whose key is certainly not in the one-column ``wanted``.

    A bitmap of 2**bits hash places, as at most 2**bits / 64 rows of two longs, is broadcast
    (8 MB at the default), so rows that cannot match need no shuffle.
    """
    name = wanted.columns[0]
    place = F.pmod(F.xxhash64(F.lit("bit"), F.col(name)), F.lit(1 << bits))
    bit = F.expr("shiftleft(1L, cast(_p % 64 AS INT))")
    words = wanted.select(place.alias("_p")).select(F.floor(F.col("_p") / 64).alias("_w"), bit.alias("_bit"))
    words = words.groupBy("_w").agg(F.bit_or("_bit").alias("_bits"))
    probe = df.withColumn("_p", F.pmod(F.xxhash64(F.lit("bit"), F.col(key)), F.lit(1 << bits))).withColumn("_v", F.floor(F.col("_p") / 64))
    hit = probe.join(F.broadcast(words), F.col("_v") == F.col("_w"), "left")
    return hit.select(*df.columns, F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False)).alias(flag))


def probably_in(df: DataFrame, key: str, wanted: DataFrame, bits: int = 25) -> DataFrame:
    """Rows of ``df`` whose key may be in ``wanted``: none of its keys is lost."""
    return bitmap_flag(df, key, wanted, "_maybe", bits).where("_maybe").drop("_maybe")


def scratch_path(spark: SparkSession, prefix: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


__all__ = ["BATCH_ROWS", "bitmap_flag", "checkpoint_dir", "cut_lineage", "load", "map_batches", "prepare", "probably_in", "release", "scratch_path", "text_of"]
