"""Usage of the service per time window, from a stream of request logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def usage_windows(logs: DataFrame, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Requests, mean latency and success rate per tumbling window.

    Works on a stream (rows later than ``delay`` are dropped, a window is
    emitted once it is closed) and on a batch (all windows).
    """
    timed = logs.withColumn("created_at", F.col("created_at").cast("timestamp")).withWatermark("created_at", delay)
    return timed.groupBy(F.window("created_at", window).alias("w")).agg(
        F.count("*").alias("total_queries"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.avg(F.col("success").cast("int")).alias("success_rate"),
    ).select(F.col("w.start").alias("window_start"), "total_queries", "avg_latency_ms", "success_rate")


def start_usage(logs: DataFrame, target: str, checkpoint: str, window: str = "1 day", delay: str = "1 hour",
                **trigger) -> StreamingQuery:
    return (
        usage_windows(logs, window, delay)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
