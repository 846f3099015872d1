"""Streaming queries: a file stream over the driver table, scored and aggregated."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from prepframe.plans.registry import load, query
from prepframe._session import checkpoint_dir
from prepframe.streaming import read_stream, run_to_files, run_to_memory, score_stream, windowed_confusion


@query(
    "stream_window_confusion",
    """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       event_type AS label, CASE WHEN value > 50 THEN 'click' ELSE 'view' END AS prediction, count(*) AS n
FROM events GROUP BY 1, 2, 3, 4
""",
)
def stream_window_confusion(spark, sf):
    schema = load(spark, sf, "events").schema
    stream = read_stream(spark, f"{sf.rstrip('/')}/events*.parquet", schema)
    scored = score_stream(stream, [lambda d: d.withColumn("prediction", F.when(F.col("value") > 50, "click").otherwise("view"))])
    agg = windowed_confusion(scored, "ts", "event_type", "prediction", "1 day", watermark=None)
    return run_to_memory(agg, "confusion_" + uuid.uuid4().hex[:8], output_mode="complete")


@query(
    "stream_window_confusion_append",
    """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       event_type AS label, CASE WHEN value > 50 THEN 'click' ELSE 'view' END AS prediction, count(*) AS n
FROM events GROUP BY 1, 2, 3, 4
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
""",
)
def stream_window_confusion_append(spark, sf):
    # event-time windows closed by a one-hour watermark are emitted once (append mode);
    # state for older windows is dropped, so the state stays bounded on an endless stream
    schema = load(spark, sf, "events").schema
    stream = read_stream(spark, f"{sf.rstrip('/')}/events*.parquet", schema)
    scored = score_stream(stream, [lambda d: d.withColumn("prediction", F.when(F.col("value") > 50, "click").otherwise("view"))])
    agg = windowed_confusion(scored, "ts", "event_type", "prediction", "1 day", watermark="1 hour")
    # closed windows go to files on the shared checkpoint storage, not through the driver
    base = f"{checkpoint_dir(spark).rstrip('/')}/confusion-{uuid.uuid4().hex}"
    run_to_files(agg, f"{base}/out", f"{base}/state")
    done = spark.read.schema(agg.schema).parquet(f"{base}/out")
    return done.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
