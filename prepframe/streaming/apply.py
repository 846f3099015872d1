"""Fitted operators on streaming frames.

Every ``apply_*`` in ``prepframe.operators`` is a narrow projection (parameters are
collected at fit time and injected as literals) or a stream-static join against a
small fitted table, and Spark ML ``PipelineModel.transform`` is a map - so they
run unchanged on a ``readStream`` frame.  Evaluation over a stream is a
watermarked event-time window aggregate of confusion counts.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from prepframe._session import checkpoint_dir


def read_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """File-source stream with an explicit schema (streams never infer)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def score_stream(stream: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Chain fitted apply steps (e.g. ``lambda d: apply_minmax(d, params)`` or a model's
    ``score``) over a streaming frame; nothing here is stateful."""
    out = stream
    for step in steps:
        out = step(out)
    return out


def windowed_confusion(
    scored: DataFrame, ts: str, label: str, prediction: str = "prediction", window: str = "1 hour",
    watermark: str | None = "10 minutes",
) -> DataFrame:
    """Confusion counts per event-time window: ``(window_start, window_end, label,
    prediction, n)``.  The watermark bounds the state; windows are emitted once
    closed (append mode).  ``timestamp_ntz`` input is cast to ``timestamp``
    because watermarks require it; ``watermark=None`` is for complete mode."""
    if watermark is None:  # complete-mode aggregate: no state bound needed, any timestamp type
        s = scored.withColumn("_ts", F.col(ts))
    else:
        s = scored.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
    agg = s.groupBy(F.window("_ts", window), F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return agg.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "label", "prediction", "n")


def run_to_memory(stream: DataFrame, name: str, output_mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Run a stream to completion over the files present now (availableNow trigger)
    into an in-memory table and return it as a batch frame (tests, notebooks)."""
    spark = stream.sparkSession
    loc = checkpoint or os.path.join(checkpoint_dir(spark).replace("file:", ""), f"stream-{name}")
    q = (
        stream.writeStream.format("memory").queryName(name).outputMode(output_mode)
        .option("checkpointLocation", loc).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.table(name)


def run_to_files(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", output_mode: str = "append",
    partition_by: Sequence[str] | None = None, available_now: bool = True,
):
    """Production sink: files (or a table format) with a checkpoint location on shared
    storage, so a restarted query resumes exactly where it stopped.  Returns the
    started ``StreamingQuery`` (already finished when ``available_now``)."""
    w = stream.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", checkpoint).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.trigger(availableNow=True).start() if available_now else w.start()
    if available_now:
        q.awaitTermination()
    return q
