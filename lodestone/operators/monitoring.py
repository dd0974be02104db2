"""Tables that watch the system: logs, registry and corpus checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.constants import LOG_RESPONSE_CHARS
from lodestone.functions.numbers import settled
from lodestone.functions.text import occurrences
from lodestone.functions.unions import union_all


def largest_groups(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The n keys with most rows, ties by key."""
    return df.groupBy(key).agg(F.count("*").alias("total")).orderBy(F.desc("total"), key).limit(n)


def term_mentions(texts: DataFrame, terms: Sequence[str], *columns: str) -> DataFrame:
    """(term, mentions, missing): occurrences in the lower-cased columns, in one pass over the texts."""
    sums = []
    for i, term in enumerate(terms):
        per_row = F.lit(0)
        for c in columns:
            per_row = per_row + F.coalesce(occurrences(c, term), F.lit(0))
        sums.append(F.coalesce(F.sum(per_row), F.lit(0)).alias(f"_{i}"))
    counted = texts.agg(*sums)
    pairs = F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"_{i}").alias("mentions")) for i, t in enumerate(terms)])
    return counted.select(F.inline(pairs)).withColumn("missing", F.col("mentions") == 0)


def usage_daily(logs: DataFrame, until: Column, days: int = 7) -> DataFrame:
    """Requests, mean latency and success rate per day of the last ``days`` before ``until``."""
    recent = logs.filter(F.col("created_at") > until - F.make_dt_interval(F.lit(days)))
    return recent.groupBy(F.to_date("created_at").alias("day")).agg(
        F.count("*").alias("total_queries"),
        settled(F.avg("latency_ms"), 6).alias("avg_latency_ms"),
        settled(F.avg(F.col("success").cast("int")), 6).alias("success_rate"),
    )


def prediction_frequency(logs: DataFrame) -> DataFrame:
    return logs.filter("prediction IS NOT NULL").groupBy("prediction").agg(
        F.count("*").alias("frequency"), settled(F.avg("confidence"), 6).alias("avg_confidence")
    )


def log_rows(responses: DataFrame, chars: int = LOG_RESPONSE_CHARS) -> DataFrame:
    """Rows for the query log: the response is cut, the ids stay an array."""
    return responses.select(
        F.col("query").alias("query_text"),
        "prediction",
        "confidence",
        "retrieved_doc_ids",
        F.substr("response", F.lit(1), F.lit(chars)).alias("response_text"),
        F.col("latency_ms").cast("double").alias("latency_ms"),
        F.coalesce("success", F.lit(True)).alias("success"),
        "error_message",
        "created_at",
        F.to_date("created_at").alias("log_date"),
    )


def register_models(registry: DataFrame, new: DataFrame) -> DataFrame:
    """The registry after the new rows came in, in order of created_at: the last
    registration of a model type is its only active row."""
    types = new.groupBy("model_type").agg(F.max(F.struct("created_at", "version")).alias("last"))
    both = union_all(registry, new.withColumn("is_active", F.lit(False)))
    touched = F.col("last").isNotNull()
    is_last = (F.col("created_at") == F.col("last.created_at")) & (F.col("version") == F.col("last.version"))
    return both.join(types, "model_type", "left").withColumn(
        "is_active", F.when(touched, is_last).otherwise(F.col("is_active"))
    ).drop("last")


def active_models(registry: DataFrame) -> DataFrame:
    return registry.filter("is_active").select("model_type", "version", "accuracy", "created_at")


def throughput(runs: DataFrame, baseline_scale: int = 1) -> DataFrame:
    """Adds docs_per_sec and speed_up against the baseline scale to (scale, docs, total_ms) rows."""
    rate = F.when(F.col("total_ms") > 0, F.col("docs") / (F.col("total_ms") / 1000.0)).otherwise(F.lit(0.0))
    rated = runs.withColumn("docs_per_sec", F.round(rate, 2))
    base = rated.filter(F.col("scale") == baseline_scale).select("docs_per_sec").scalar()
    return rated.withColumn("speed_up", settled(F.when(F.lit(base) > 0, F.col("docs_per_sec") / base), 2))
