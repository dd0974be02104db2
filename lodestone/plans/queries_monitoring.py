"""Monitoring queries: usage, predictions, the model registry, and usage as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions.numbers import settled
from lodestone.operators import monitoring
from lodestone.plans.catalog import query
from lodestone.plans.tables import request_log, stream_table, table
from lodestone.session import fresh_dir
from lodestone.sources import writers
from lodestone.sources.keyed_table import KeyedTable
from lodestone.streaming.usage import start_usage


@query("usage_daily", """
SELECT ts::DATE::VARCHAR AS day, count(*) AS total_queries, round(avg(value) + 1e-9, 6) AS avg_latency_ms,
       round(avg(CASE WHEN event_type <> 'error' THEN 1.0::DOUBLE ELSE 0 END) + 1e-9, 6) AS success_rate
FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1 ORDER BY 1 DESC""")
def usage_daily(spark, sf):
    logs = request_log(spark, sf)
    until = logs.agg(F.max("created_at").alias("m")).scalar()
    daily = monitoring.usage_daily(logs, until, 7)
    return daily.withColumn("day", F.col("day").cast("string")).orderBy(F.desc("day"))


@query("prediction_frequency", """
SELECT event_type AS prediction, count(*) AS frequency, round(avg((props->>'$.k')::DOUBLE), 6) AS avg_confidence
FROM events WHERE event_type <> 'error' GROUP BY event_type ORDER BY frequency DESC, prediction""")
def prediction_frequency(spark, sf):
    return monitoring.prediction_frequency(request_log(spark, sf)).orderBy(F.desc("frequency"), "prediction")


def _versions(spark, sf):
    events = table(spark, sf, "events")

    def versions(mark: str, unit: str):
        start = F.date_format(F.date_trunc(unit, F.col("ts").cast("timestamp")), "yyyyMMdd")
        return events.groupBy(F.col("event_type").alias("model_type"), F.concat(F.lit(mark), start).alias("version")).agg(
            settled(F.avg("value"), 6).alias("accuracy"), F.max("ts").alias("created_at")
        )

    return versions


@query("model_active", """
WITH new AS (
  SELECT event_type AS model_type, 'w' || strftime(date_trunc('week', ts), '%Y%m%d') AS version, round(avg(value) + 1e-9, 6) AS accuracy, max(ts) AS created_at
  FROM events GROUP BY event_type, version)
SELECT model_type, version, accuracy, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at FROM new n
QUALIFY row_number() OVER (PARTITION BY model_type ORDER BY n.created_at DESC, version DESC) = 1""")
def model_active(spark, sf):
    """Daily versions are registered already (the last one active); weekly ones come in and replace them."""
    versions = _versions(spark, sf)
    daily = versions("d", "day")
    registry = monitoring.register_models(daily.withColumn("is_active", F.lit(False)).limit(0), daily)
    active = monitoring.active_models(monitoring.register_models(registry, versions("w", "week")))
    return active.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("registry_commits", """
WITH v AS (
  SELECT event_type AS model_type, 'd' || strftime(ts, '%Y%m%d') AS version, round(avg(value) + 1e-9, 6) AS accuracy, max(ts) AS created_at, false AS weekly FROM events GROUP BY event_type, version
  UNION ALL
  SELECT event_type, 'w' || strftime(date_trunc('week', ts), '%Y%m%d') AS version, round(avg(value) + 1e-9, 6), max(ts), true FROM events GROUP BY event_type, version)
SELECT model_type, version, accuracy, row_number() OVER (PARTITION BY model_type ORDER BY weekly DESC, created_at DESC, version DESC) = 1 AS is_active FROM v""")
def registry_commits(spark, sf):
    """Two registrations in a shared registry, each a commit: of a type the last version of the later one is active."""
    versions, target = _versions(spark, sf), fresh_dir(spark, "registry")
    for new in (versions("d", "day"), versions("w", "week")):
        writers.commit_registry(spark, new, target)
    return KeyedTable(spark, target).read().select("model_type", "version", "accuracy", "is_active")


@query("usage_windows_stream", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS total_queries, round(avg(value) + 1e-9, 6) AS avg_latency_ms,
       round(avg(CASE WHEN event_type <> 'error' THEN 1.0::DOUBLE ELSE 0 END) + 1e-9, 6) AS success_rate
FROM events GROUP BY date_trunc('day', ts)
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def usage_windows_stream(spark, sf):
    logs = stream_table(spark, sf, "events").select(
        F.col("ts").alias("created_at"), F.col("value").alias("latency_ms"), (F.col("event_type") != "error").alias("success")
    )
    target = fresh_dir(spark, "usage")
    start_usage(logs, target, fresh_dir(spark, "usage-checkpoint")).awaitTermination()
    closed = spark.read.parquet(target)
    return closed.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"),
        "total_queries",
        settled("avg_latency_ms", 6).alias("avg_latency_ms"),
        settled("success_rate", 6).alias("success_rate"),
    )
