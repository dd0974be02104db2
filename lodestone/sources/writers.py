"""Sinks.  Each runs one job; counts are observed while it writes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.operators.dedup import unseen
from lodestone.operators.monitoring import log_rows, register_models
from lodestone.session import fresh_dir
from lodestone.sources.keyed_table import Insert, KeyedTable
from lodestone.sources.readers import path_exists


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_json_array(df: DataFrame, path: str) -> str:
    """Each part is one JSON array with an element a line.  One task reads a part, so parts must not grow with the table."""

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = False
        for batch in batches:
            lines = ["," + x for x in batch.column(0).to_pylist()]
            if lines and not opened:
                lines[0], opened = "[" + lines[0][1:], True
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if opened else "[]"])], ["value"])

    df.select(F.to_json(F.struct(*df.columns)).alias("value")).mapInArrow(framed, "value string").write.mode("overwrite").text(path)
    return path


def write_corpus_cache(docs: DataFrame, path: str, order: Sequence[str]) -> str:
    """Unique documents as JSON lines; the first by ``order`` of each id stays."""
    from lodestone.operators.dedup import keep_first

    return write_json(keep_first(docs, "id", order).select("id", "title", "abstract", "full_text", "year", "keywords"), path)


def insert_if_absent(spark: SparkSession, batch: DataFrame, target: str, key: Sequence[str], order: Sequence[str],
                     partition_by: Sequence[str] = (), unwritten: Sequence[str] = ()) -> dict[str, int]:
    """Appends the rows whose key the table does not hold yet; returns inserted, skipped and errors.

    Of several rows of a key in a batch the first by ``order`` stays; ``unwritten`` columns only serve that order.

    Running it again with the same batch inserts nothing, so a failed run can be repeated.
    """
    key = list(key)
    read, wrote = Observation(), Observation()
    bad = F.lit(False)
    for c in key:
        bad = bad | F.col(c).isNull()
    seen = batch.observe(read, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad")).filter(~bad)
    keys = T.StructType([batch.schema[c] for c in key])  # only the key columns of the target are read
    stored = spark.read.schema(keys).parquet(target) if path_exists(spark, target) else batch.select(*key).limit(0)
    new = unseen(seen, stored, key, order).drop(*unwritten).observe(wrote, F.count(F.lit(1)).alias("rows"))
    writer = new.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
    rows, errors, inserted = read.get["rows"], read.get["bad"], wrote.get["rows"]
    return {"inserted": inserted, "skipped": rows - errors - inserted, "errors": errors}


def _arrived(docs: DataFrame, arrival: str | None) -> DataFrame:
    return docs.withColumn("_arrival", F.col(arrival) if arrival else F.monotonically_increasing_id())


def _documents(docs: DataFrame, arrival: str | None) -> DataFrame:
    return _arrived(docs, arrival).withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()})


def _embeddings(embedded: DataFrame, model: str, strategy: str) -> DataFrame:
    return embedded.select(
        "doc_id", "chunk_index", "chunk_text", "content_hash", "embedding",
        F.lit(model).alias("embedding_model"), F.lit(strategy).alias("chunking_strategy"),
        F.current_timestamp().alias("created_at"),
    )


DOCUMENT_KEY, EMBEDDING_KEY = ["pmid"], ["content_hash", "embedding_model"]


def insert_documents(spark: SparkSession, docs: DataFrame, target: str, arrival: str | None = None) -> dict[str, int]:
    """Into medical_documents, unique by pmid; the first seen of a batch stays: by ``arrival``, else by the batch's own order."""
    return insert_if_absent(spark, _documents(docs, arrival), target, DOCUMENT_KEY, ["_arrival", "title", "abstract"], unwritten=["_arrival"])


def insert_embeddings(spark: SparkSession, embedded: DataFrame, model: str, strategy: str, target: str) -> dict[str, int]:
    """Into document_embeddings, unique by (content_hash, embedding_model)."""
    return insert_if_absent(
        spark, _embeddings(embedded, model, strategy), target, EMBEDDING_KEY, ["doc_id", "chunk_index"],
        ["embedding_model", "chunking_strategy"],
    )


def prepare_documents(spark: SparkSession, docs: DataFrame, target: str, arrival: str) -> Insert:
    """``insert_documents`` for several writers at a time: the target is a ``KeyedTable``, the rows are its after commit()."""
    return KeyedTable(spark, target, DOCUMENT_KEY).prepare(_documents(docs, arrival), ["_arrival", "title", "abstract"], ["_arrival"])


def prepare_embeddings(spark: SparkSession, embedded: DataFrame, model: str, strategy: str, target: str) -> Insert:
    """``insert_embeddings`` for several writers at a time: the target is a ``KeyedTable``, the rows are its after commit()."""
    return KeyedTable(spark, target, EMBEDDING_KEY).prepare(_embeddings(embedded, model, strategy), ["doc_id", "chunk_index"])


def commit_registry(spark: SparkSession, new: DataFrame, target: str) -> int:
    """Registers models in a shared registry; a registration that comes in meanwhile is seen.  Returns its rows."""
    table = KeyedTable(spark, target, ["model_type", "version"], buckets=1)
    return table.replace(lambda rows: register_models(rows, new), new.withColumn("is_active", F.lit(False)).limit(0))


def append_corpus(spark: SparkSession, docs: DataFrame, target: str, arrival: str | None = None) -> dict[str, int]:
    """Adds documents with unseen ids to a Parquet corpus; the first seen of a batch stays: by ``arrival``, else by the batch's own order."""
    return insert_if_absent(spark, _arrived(docs, arrival), target, ["id"], ["_arrival", "title", "abstract"], unwritten=["_arrival"])


def append_query_log(responses: DataFrame, target: str) -> None:
    log_rows(responses).write.mode("append").partitionBy("log_date").parquet(target)


def save_registry(spark: SparkSession, registry: DataFrame, new: DataFrame) -> str:
    """Writes the registry with the new rows to a fresh path and returns it; the old one stays readable."""
    path = fresh_dir(spark, "registry")
    register_models(registry, new).coalesce(1).write.parquet(path)  # a few rows per model type
    return path


def save_index(embedded: DataFrame, path: str, model: str, strategy: str) -> str:
    """Chunks and vectors in one table, partitioned by model and strategy.

    One call fills one partition, so its folder is named outright and no rows
    are sorted for it; other partitions of the table stay as they are.
    """
    write_parquet(embedded, f"{path}/embedding_model={model}/chunking_strategy={strategy}")
    return path
