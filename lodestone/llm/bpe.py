"""Operator 2: byte-level BPE encoding and decoding by recursive queries in every partition (duck_bpe.py).

Cases: a null text is empty and has no ids; a null or repeated doc_id is kept as
it is; an empty table gives an empty one; other columns are ignored.  Texts
are encoded whole; a task holds one Arrow batch of them and a bounded memory of
units it has seen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodestone.llm.common import bounded_batches, id_and_text
from lodestone.llm.duck_bpe import encoder, merger

ROWS_AT_ONCE = 250


def encode_documents(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers)."""
    bounded_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, ids, many in _encoded(batches, ranks, pattern):
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(many), pa.array(_per_row(ids, many), pa.binary())], ["doc_id", "n_tokens", "ids"])

    return id_and_text(docs).mapInArrow(encode, "doc_id long, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, ranks: str) -> DataFrame:
    """The reverse of ``encode_documents``: doc_id, text."""
    bounded_batches(encoded.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(x or b"", "<u4") for x in batch["ids"].to_pylist()]
            row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            texts = merger(ranks).decode(np.concatenate(parts) if parts else row, row, len(parts))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([t.decode() for t in texts])], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and SHA-256 of its ids and of the bytes decoded from these ids."""
    bounded_batches(docs.sparkSession)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, ids, many in _encoded(batches, ranks, pattern):
            row = np.repeat(np.arange(len(many)), many)
            texts = merger(ranks).decode(ids, row, len(many))
            columns = [doc_id, pa.array(many)]
            columns += [pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string()) for xs in (_per_row(ids, many), texts)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs).mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _encoded(batches: Iterator[pa.RecordBatch], ranks: str, pattern: str):
    coder = encoder(ranks, pattern)
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(lo, ROWS_AT_ONCE)
            ids, many = coder.rows(part["text"])
            yield part["doc_id"], ids, many


def _per_row(ids: np.ndarray, many: np.ndarray) -> list[bytes]:
    raw, ends = ids.astype("<u4").tobytes(), np.cumsum(many) * 4
    return [raw[e - 4 * n : e] for e, n in zip(ends.tolist(), many.tolist())]
