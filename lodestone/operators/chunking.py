"""One document row to many chunk rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.constants import CHUNKING_STRATEGIES, RECURSIVE_SEPARATORS
from lodestone.functions.numbers import settled
from lodestone.functions.splitters import recursive_chunks, split_texts, text_slices
from lodestone.functions.text import content_hash, preview, strip_ws


def word_chunks(text: Column, size: int) -> Column:
    """Whole words packed up to ``size`` characters; a longer word stands alone.

    The regex takes the longest run that ends at a space or at the end, which
    is greedy packing, and stays in the JVM.  A lone word takes the space behind it.
    """
    single_spaced = F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " +", " ")).otherwise(text)
    runs = F.regexp_extract_all(single_spaced, F.lit(rf"(?s)(.{{1,{size}}})(?: |\z)|([^ ]+ ?)"), F.lit(0))
    return F.filter(F.transform(runs, strip_ws), lambda c: c != "")


def window_chunks(text: Column, size: int, overlap: int) -> Column:
    """Fixed character windows; none lies wholly inside the one before."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - overlap, F.lit(1)), F.lit(size - overlap))
    windows = F.transform(starts, lambda i: F.substr(text, i, F.lit(size)))
    return F.filter(windows, lambda c: c != "")


def chunk_array(text: Column, strategy: str | dict) -> Column:
    """The chunks of one text as an array, for a named or given strategy."""
    if isinstance(strategy, str):
        if strategy not in CHUNKING_STRATEGIES:
            raise ValueError(f"unknown strategy {strategy!r}; known: {', '.join(sorted(CHUNKING_STRATEGIES))}")
        strategy = CHUNKING_STRATEGIES[strategy]
    kind = strategy["kind"]
    if kind == "document":
        return F.filter(F.array(text), lambda c: c != "")
    if kind == "words":
        return word_chunks(text, strategy["size"])
    if kind == "window":
        return window_chunks(text, strategy["size"], strategy["overlap"])
    separators = strategy.get("separators", RECURSIVE_SEPARATORS)
    if kind == "recursive":
        return recursive_chunks(text, strategy["size"], strategy["overlap"], separators)
    if kind == "natural":
        # Only long texts go to Python; the rest are passed as null and kept whole.
        long = F.length(text) > strategy["whole_up_to"]
        split = recursive_chunks(F.when(long, text), strategy["size"], strategy["overlap"], separators)
        return F.when(long, split).otherwise(F.filter(F.array(text), lambda c: c != ""))
    raise ValueError(f"unknown kind {kind!r}")


def chunk(docs: DataFrame, strategy: str | dict, text: str = "combined_text", doc_id: str = "id",
          keep: tuple[str, ...] = (), hash_chars: int = 32) -> DataFrame:
    """(doc_id, *keep, chunk_index, chunk_text, char_count, content_hash)."""
    pieces = docs.select(
        F.col(doc_id).alias("doc_id"),
        *keep,
        F.posexplode(chunk_array(F.col(text), strategy)).alias("chunk_index", "chunk_text"),
    )
    return with_chunk_stats(pieces, hash_chars)


def with_chunk_stats(pieces: DataFrame, hash_chars: int = 32) -> DataFrame:
    return pieces.withColumns(
        {"char_count": F.length("chunk_text"), "content_hash": content_hash("chunk_text", hash_chars)}
    )


def sweep(docs: DataFrame, sizes: list[int], overlap_share: float = 0.1, text: str = "combined_text",
          doc_id: str = "id", separators: list[str] = RECURSIVE_SEPARATORS) -> DataFrame:
    """Recursive chunks of several sizes in one pass over the documents, tagged ``size``."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([
        texts.schema["doc_id"], T.StructField("size", T.IntegerType(), False),
        T.StructField("chunk_index", T.IntegerType(), False), T.StructField("chunk_text", T.StringType()),
    ])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch["text"]):
                part = batch.slice(lo, hi - lo)
                for size in sizes:  # rows of one size at a time, so a worker never holds a batch in all sizes
                    chunks = split_texts(part["text"], size, int(size * overlap_share), separators)
                    many = np.asarray(chunks.value_lengths(), np.int64)
                    row = np.repeat(np.arange(len(many)), many)
                    place = (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)).astype(np.int32)
                    columns = [part["doc_id"].take(pa.array(row)), pa.array(np.full(len(row), size, np.int32)), pa.array(place), chunks.flatten()]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

    pieces = texts.mapInArrow(split, schema)
    return with_chunk_stats(pieces)


def with_title_prefix(chunks: DataFrame, title_chars: int = 80, title: str = "title") -> DataFrame:
    """``[title] chunk``; chunks must carry the title (``chunk(..., keep=('title',))``)."""
    return chunks.withColumn(
        "chunk_text", F.concat(F.lit("["), preview(title, title_chars), F.lit("] "), F.col("chunk_text"))
    )


def chunk_summary(chunks: DataFrame, *by: str) -> DataFrame:
    return chunks.groupBy(*by).agg(
        F.count("*").alias("chunks"),
        F.min("char_count").alias("min_chars"),
        settled(F.avg("char_count"), 4).alias("avg_chars"),
        F.max("char_count").alias("max_chars"),
    )
