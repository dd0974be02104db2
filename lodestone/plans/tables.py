"""How the provided tables play the parts of the data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.constants import CONDITIONS
from lodestone.functions.text import tokens
from lodestone.operators.ranking import hash_share
from lodestone.sources.readers import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream, whether it is one file or a folder of parts."""
    path = f"{sf_dir}/{name}.parquet"
    batch = spark.read.parquet(path)
    reader = spark.readStream.schema(batch.schema)
    if any(f.rstrip("/").endswith(f"/{name}.parquet") for f in batch.inputFiles()):
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(path)


def as_corpus(documents: DataFrame) -> DataFrame:
    """The first line is the title, the whole text the abstract."""
    return documents.select(
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("abstract"),
        F.lit("").alias("full_text"),
        "lang",
        "source",
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_corpus(spread(table(spark, sf_dir, "documents")))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item, whole, is a query."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def benchmark_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries with expected keywords (their long words) and a difficulty (by length)."""
    words = tokens("query")
    return benchmark_queries(spark, sf_dir).withColumns(
        {
            "expected_keywords": F.array_distinct(F.filter(words, lambda w: F.length(w) >= 8)),
            "difficulty": F.when(F.size(words) < 30, "standard").otherwise("complex"),
        }
    )


def benchmark_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of a query: its sentences."""
    sentences = F.filter(F.split("query", r"\.\s*"), lambda s: s != "")
    return benchmark_queries(spark, sf_dir).select("query_id", F.posexplode(sentences).alias("topic_pos", "topic"))


def centroids(embeddings: DataFrame, *by: str) -> DataFrame:
    """Mean vector per group; averaged map-side per position, so a large group stays cheap."""
    places = embeddings.select(*by, F.posexplode("embedding").alias("i", "x"))
    means = places.groupBy(*by, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("i", "x")))["x"].alias("vector"))


def request_id() -> Column:
    """A turn's own number: conv_id * 1000 + turn, as the SQL has it, while the turn has three digits.

    Later turns get numbers of a range of their own, far below zero, so no two requests share one.
    """
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    late = F.lit(-(1 << 62)) + conv * F.lit(1 << 31) + turn
    return (
        F.when(conv.isNull() | turn.isNull(), F.lit(None).cast("long"))
        .when(turn.between(0, 999), conv * 1000 + turn)
        .when(conv.between(0, (1 << 30) - 1) & turn.between(0, (1 << 31) - 1), late)
        .otherwise(F.raise_error(F.lit("no number for this conversation and turn")).cast("long"))
    )


def user_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as requests; the conversation number picks the condition, the last one unknown."""
    names = F.array(*[F.lit(c) for c in [*CONDITIONS, "Normal", "Unknown"]])
    conv = table(spark, sf_dir, "conversations").filter("role = 'user'")
    return conv.select(
        request_id().alias("query_id"),
        F.col("text").alias("query"),
        F.element_at(names, (F.col("conv_id") % 16 + 1).cast("int")).alias("condition"),
    )


def label_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, condition, label, score): the given labels with a noisy score that follows them."""
    labels = table(spark, sf_dir, "labels").unpivot("doc_id", ["quality", "toxic"], "condition", "label")
    noise = hash_share(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("condition")), 7)
    return labels.select(
        F.col("doc_id").alias("item_id"),
        "condition",
        "label",
        F.round((F.col("label") * 0.4 + noise * 0.8) / 1.2, 4).alias("score"),
    )


def condition_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, condition, score): one score per labelled document and condition."""
    items = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("item_id"), F.explode(F.array(*[F.lit(c) for c in CONDITIONS])).alias("condition")
    )
    u = hash_share(F.concat(F.col("item_id").cast("string"), F.lit(":"), F.col("condition")), 11)
    return items.withColumn("score", F.round(u * u * u, 6))


def condition_thresholds(spark: SparkSession) -> DataFrame:
    rows = [(c.replace(" ", "_"), 0.12 + 0.02 * i) for i, c in enumerate(CONDITIONS)]
    return spark.createDataFrame(rows, "condition string, threshold double")


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the log of requests."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("created_at"),
        F.col("value").alias("latency_ms"),
        (F.col("event_type") != "error").alias("success"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("prediction"),
        F.try_element_at(F.from_json("props", "map<string,double>"), F.lit("k")).alias("confidence"),
    )
