"""Incremental corpus ingest: landed batches become unseen chunks of the target."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestone.operators.chunking import chunk
from lodestone.operators.cleaning import clean
from lodestone.sources.keyed_table import KeyedTable
from lodestone.sources.writers import insert_if_absent


def start_ingest(spark: SparkSession, documents: DataFrame, target: str, checkpoint: str, strategy: str | dict = "recursive_800",
                 **trigger) -> StreamingQuery:
    """``documents`` is a streaming DataFrame in corpus form.

    A batch that is replayed after a failure inserts nothing twice, because
    rows are inserted by content hash.
    """

    def load(batch: DataFrame, _: int) -> None:
        insert_if_absent(spark, chunk(clean(batch), strategy), target, ["content_hash"], ["doc_id", "chunk_index"])

    return (
        documents.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _once_per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.drop_duplicates("content_hash")


def start_stateful_ingest(spark: SparkSession, documents: DataFrame, target: str, checkpoint: str, strategy: str | dict = "recursive_800",
                          remember: str = "7 days", **trigger) -> StreamingQuery:
    """Like ``start_ingest``, into a ``KeyedTable``, but chunks seen in the last ``remember`` never reach it.

    Hashes of recent chunks are kept in RocksDB, by the time they arrived, so no row is too late and the state is bounded by
    what arrives in that time.  Only what the state doesn't know is looked up in the table, in the buckets it touches; older
    copies are found there, and so are those of a replayed batch.  Which of several equal chunks of one micro-batch stays is
    open.  Copies within an Arrow batch go before the shuffle, so a chunk in a third of all rows is a row per Arrow batch.
    """
    table = KeyedTable(spark, target, ["content_hash"])

    def load(batch: DataFrame, _: int) -> None:
        table.insert(batch, [])  # the state lets a hash through once

    chunks = chunk(clean(documents), strategy)
    recent = chunks.mapInPandas(_once_per_batch, chunks.schema).withColumn("_arrived", F.current_timestamp())
    fresh = recent.withWatermark("_arrived", remember).dropDuplicatesWithinWatermark(["content_hash"]).drop("_arrived")
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # a query keeps the store it was started with
    try:
        return (
            fresh.writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        spark.conf.set(STATE_STORE, before)
