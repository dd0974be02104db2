"""What the operators of this folder share: bounded Arrow batches, worker-wide memory, digests of lists."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 2_000
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches by rows and by bytes, so that long texts don't add up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Arrow batches of up to ``rows`` rows and ``size`` bytes for the jobs run inside; the session's own settings come back."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def worker_memory(key: str, make):
    """A value that lives as long as the Python worker, which Spark uses for many tasks, or until ``forget_worker_memory``."""
    kept = sys.__dict__.setdefault("_worker_memory", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def forget_worker_memory() -> None:
    """Frees what earlier tasks of other operators left in this Python worker."""
    if sys.__dict__.get("_worker_memory"):
        sys.__dict__["_worker_memory"].clear()
        pa.default_memory_pool().release_unused()


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator needs, under names of its own; a null text becomes an empty one."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows (len + 1); null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = texts.buffers()
    at = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return data, at - at[0]


def spans(at: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of up to ``limit`` bytes; a longer row is a range of its own."""
    lo, rows = 0, len(at) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        yield lo, min(hi, rows)
        lo = min(hi, rows)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0] .. +lengths[0], starts[1] .. +lengths[1], and so on, as one array."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
