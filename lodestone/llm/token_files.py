"""Operator 1: token ids of a corpus as binary files, coded by a static range asymmetric numeral system.

Files: ``<path>/segments`` holds a row per segment, in Parquet so that any file
system and a retried task do.  A segment is a run of whole documents in
ascending doc_id order within a shard: their ids and lengths, the frequency table
shared by the segment's blocks, and the blocks (rans.py) with their checkpoints
and checksums.  Segments are decoded independently; blocks and checkpoint spans
within them, too.

Cases: a null text is empty; an empty document has its end id only; a null
doc_id sorts before all others; equal doc_ids stay neighbours in any order; an
empty table gives files without segments; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import bounded_batches, id_and_text
from lodestone.llm.hf_bpe import encoder
from lodestone.llm.rans import Decoder, Encoder, Table

SEGMENT_IDS = 2 << 20  # a segment closes when it has so many
BLOCK_IDS = 1 << 18

BLOCK = "struct<n_ids:int,lanes:int,words:binary,check_at:array<int>,check_states:binary,crc32:bigint>"
SEGMENT = f"shard int, segment int, before long, n_ids long, doc_ids array<bigint>, lengths array<int>, bits binary, blocks array<{BLOCK}>"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_token_files(docs: DataFrame, path: str, vocabulary: str, pattern: str, end_id: int = 0, encode_special_tokens: bool = True) -> None:
    """Encodes whole texts, ends each with ``end_id`` and writes the ids in doc_id order.

    The only shuffle deals the texts out by ranges of doc_id.  encode_special_tokens: see ``hf_bpe.encoder``.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number, before = TaskContext.get().partitionId(), 0, 0
        held_ids: list[np.ndarray] = []
        held_docs: list[int | None] = []
        held_lengths: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(held_ids)
            table = Table.of(ids)
            coder = Encoder(table)
            blocks = coder.blocks(ids, BLOCK_IDS)
            row = {
                "shard": shard, "segment": number, "before": before, "n_ids": len(ids), "doc_ids": held_docs,
                "lengths": np.concatenate(held_lengths).tolist(), "bits": table.to_bytes(), "blocks": blocks,
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            coder = encoder(vocabulary, pattern, encode_special_tokens=encode_special_tokens)
            ids, many = coder.rows(batch["text"])  # a batch is bounded by rows and bytes
            held_ids.append(np.insert(ids, np.cumsum(many), end_id))
            held_lengths.append(many + 1)
            held_docs += batch["doc_id"].to_pylist()
            held += len(held_ids[-1])
            if held >= SEGMENT_IDS:
                yield close()
                number, before, held = number + 1, before + held, 0
                held_ids, held_docs, held_lengths = [], [], []
        if held:
            yield close()

    schema = _arrow(spark, SEGMENT)
    ordered = id_and_text(docs).repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(segments, SEGMENT).write.option("compression", "none").parquet(f"{path}/segments")


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def shard_starts(spark: SparkSession, path: str) -> dict[int, int]:
    """Ids before each shard.  One number per shard, that is per task of the writing job, comes to the driver."""
    sizes = spark.read.parquet(f"{path}/segments").groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    starts, total = {}, 0
    for row in sorted(sizes, key=lambda r: r["shard"]):
        starts[row["shard"]] = total
        total += row["n"]
    return starts


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids (array)."""
    return _decoded(spark, path, "doc_id long, start long, n_tokens long, ids array<bigint>", _with_ids)


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32 (over its ids as little-endian unsigned 32-bit integers)."""
    return _decoded(spark, path, ROWS, _with_crc)


def _with_ids(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int64)))


def _with_crc(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(lengths) * 4
    return pa.array([zlib.crc32(raw[e - 4 * n : e]) for e, n in zip(ends.tolist(), lengths.tolist())], pa.int64())


def _decoded(spark: SparkSession, path: str, ddl: str, last_column) -> DataFrame:
    starts, schema = shard_starts(spark, path), _arrow(spark, ddl)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                coder = Decoder(Table.from_bytes(row["bits"]))
                ids = coder.blocks(row["blocks"])
                lengths = np.array(row["lengths"], np.int64)
                at = starts[row["shard"]] + row["before"] + np.cumsum(lengths) - lengths
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(at), pa.array(lengths), last_column(ids, lengths)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    bounded_batches(spark)  # by bytes; a row is a whole segment and decoded by itself
    return spark.read.schema(SEGMENT).parquet(f"{path}/segments").mapInArrow(decode, ddl)
