"""Attaching vectors and model scores to rows.

Models are pluggable: a factory is called once per task and returns a function
from a list of inputs to an array, so a heavy model is loaded once and batches
stream through it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.constants import CONDITIONS, DEFAULT_THRESHOLD
from lodestone.functions.numbers import settled
from lodestone.functions.text import tokens
from lodestone.functions.vectors import sigmoid

Encoder = Callable[[list[str]], np.ndarray]
EncoderFactory = Callable[[], Encoder]

KNOWN_TOKENS = 1 << 17  # a worker's memory of hashed tokens, some 20 MB; the common ones are soon back after it is cleared


def _bucket_and_sign(token: str, dim: int) -> tuple[int, float]:
    digest = hashlib.md5(token.encode()).hexdigest()
    return int(digest[:8], 16) % dim, 1.0 if int(digest[8], 16) % 2 == 0 else -1.0


def hashing_encoder(dim: int = 64) -> EncoderFactory:
    """Signed feature hashing of tokens, scaled to unit length."""

    def factory() -> Encoder:
        known: dict[str, int] = {"": 2 * dim}  # token -> bucket, plus dim when the sign is negative

        def codes(tokens: list[str]) -> np.ndarray:
            if len(known) > KNOWN_TOKENS:
                known.clear()
                known[""] = 2 * dim
            for token in set(tokens).difference(known):
                bucket, sign = _bucket_and_sign(token, dim)
                known[token] = bucket if sign > 0 else bucket + dim
            return np.fromiter(map(known.__getitem__, tokens), dtype="int64", count=len(tokens))

        def encode(texts: list[str]) -> np.ndarray:
            words = pc.ascii_split_whitespace(pc.utf8_lower(pa.array(texts, type=pa.string())))
            row = np.repeat(np.arange(len(texts)), np.asarray(pc.fill_null(pc.list_value_length(words), 0)))
            distinct = words.flatten().dictionary_encode()
            cell = codes(distinct.dictionary.to_numpy(zero_copy_only=False).tolist())[np.asarray(distinct.indices)]
            # one column per signed bucket, and one for the empty words at the edges of a text
            width = 2 * dim + 1
            counts = np.bincount(row * width + cell, minlength=len(texts) * width).reshape(len(texts), width)
            out = (counts[:, :dim] - counts[:, dim : 2 * dim]).astype("float64")
            length = np.linalg.norm(out, axis=1, keepdims=True)
            return np.divide(out, length, out=out, where=length > 0)

        return encode

    return factory


# name -> factory; register more with ENCODERS["name"] = factory
ENCODERS: dict[str, EncoderFactory] = {
    "hash32": hashing_encoder(32),
    "hash64": hashing_encoder(64),
    "hash128": hashing_encoder(128),
}


def resolve(registry: dict, name: str):
    if name not in registry:
        raise ValueError(f"unknown name {name!r}; known: {', '.join(sorted(registry))}")
    return registry[name]


def embed(df: DataFrame, encoder: str | EncoderFactory, text: str = "chunk_text", out: str = "embedding",
          batch_size: int = 512, precise: bool = False) -> DataFrame:
    """Adds ``out``: array<float>, or array<double> with ``precise``."""
    return embed_each(df, {out: encoder}, text, batch_size, precise)


def embed_each(df: DataFrame, encoders: dict[str, str | EncoderFactory], text: str = "chunk_text", batch_size: int = 512,
               precise: bool = False) -> DataFrame:
    """``embed`` by several encoders, named by their columns, in one pass: a core has one worker, not one per encoder."""
    factories = {out: resolve(ENCODERS, e) if isinstance(e, str) else e for out, e in encoders.items()}
    element = T.DoubleType() if precise else T.FloatType()
    schema = T.StructType([*df.schema.fields, *[T.StructField(out, T.ArrayType(element), True) for out in factories]])
    arrow_element = pa.float64() if precise else pa.float32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = {out: factory() for out, factory in factories.items()}
        for batch in batches:
            for lo in range(0, batch.num_rows, batch_size):
                part = batch.slice(lo, batch_size)
                texts, vectors = part.column(text).to_pylist(), []
                for encoded in encode.values():
                    matrix = np.ascontiguousarray(encoded(texts))
                    flat = pa.array(matrix.ravel(), type=pa.float64()).cast(arrow_element)
                    starts = np.arange(0, matrix.size + 1, matrix.shape[1], dtype="int32")
                    vectors.append(pa.ListArray.from_arrays(pa.array(starts), flat))
                yield pa.RecordBatch.from_arrays([*part.columns, *vectors], names=[*part.schema.names, *encode])

    return df.mapInArrow(run, schema)


def embedding_entries(df: DataFrame, ids: list[str], vector: str = "embedding") -> DataFrame:
    """Long form (ids, position, value) of the non-zero entries."""
    return df.select(*ids, F.posexplode(vector).alias("position", "value")).filter("value != 0")


def embedding_summary(df: DataFrame, by: list[str], vector: str = "embedding", text: str = "chunk_text") -> DataFrame:
    """Per (model, strategy): chunks, mean chunk size and vector length."""
    return df.groupBy(*by).agg(
        F.count("*").alias("num_chunks"),
        settled(F.avg(F.length(text)), 1).alias("avg_chunk_chars"),
        F.max(F.size(vector)).alias("dimension"),
    )


Predictor = Callable[[list], np.ndarray]


PREDICTORS: dict[str, Callable[[], Predictor]] = {}  # image or item models by name
PAIR_SCORERS: dict[str, Callable] = {}  # models that score (query, text) pairs by name


def score_items(df: DataFrame, predictor: str | Callable[[], Predictor], item_id: str, payload: str,
                conditions: list[str] = CONDITIONS, logits: bool = True, batch_size: int = 64) -> DataFrame:
    """Long (item, condition, score) from a model that maps payloads to one row of scores each."""
    predictor = resolve(PREDICTORS, predictor) if isinstance(predictor, str) else predictor
    item_type = df.schema[item_id].dataType
    wide = T.StructType([T.StructField(item_id, item_type), T.StructField("_scores", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = predictor()
        for batch in batches:
            for lo in range(0, batch.num_rows, batch_size):
                part = batch.slice(lo, batch_size)
                scores = np.asarray(predict(part.column(payload).to_pylist()), dtype="float64")
                yield pa.RecordBatch.from_arrays(
                    [part.column(item_id), pa.array(scores.tolist(), type=pa.list_(pa.float64()))],
                    names=[item_id, "_scores"],
                )

    names = F.array(*[F.lit(c) for c in conditions])
    scored = df.select(item_id, payload).mapInArrow(run, wide)
    pairs = scored.select(item_id, F.explode(F.arrays_zip(names.alias("condition"), F.col("_scores").alias("score"))))
    score = F.col("col.score")
    return pairs.select(
        item_id, F.col("col.condition").alias("condition"), (sigmoid(score) if logits else score).alias("score")
    )


def placeholder_scores(df: DataFrame, item_id: str, conditions: list[str] = CONDITIONS) -> DataFrame:
    """What is served without a model: every condition at 0, nothing detected."""
    return df.select(item_id, F.explode(F.array(*[F.lit(c) for c in conditions])).alias("condition")).select(
        item_id,
        "condition",
        F.lit(0.0).alias("probability"),
        F.lit(False).alias("detected"),
        F.lit(DEFAULT_THRESHOLD).alias("threshold"),
    )


def token_overlap(query: str = "query", text: str = "chunk_text"):
    """Default pair score: share of distinct query tokens that the text holds."""
    wanted = F.array_distinct(tokens(query))
    shared = F.size(F.array_intersect(wanted, tokens(text)))
    return F.when(F.size(wanted) > 0, shared / F.size(wanted)).otherwise(F.lit(0.0))


def score_pairs(df: DataFrame, scorer: str | Callable[[], Callable[[list[tuple[str, str]]], np.ndarray]],
                query: str = "query", text: str = "chunk_text", out: str = "pair_score", batch_size: int = 64) -> DataFrame:
    """Adds the score a model gives to each (query, text) pair."""
    scorer = resolve(PAIR_SCORERS, scorer) if isinstance(scorer, str) else scorer
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType(), True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = scorer()
        for batch in batches:
            for lo in range(0, batch.num_rows, batch_size):
                part = batch.slice(lo, batch_size)
                pairs = list(zip(part.column(query).to_pylist(), part.column(text).to_pylist()))
                scores = pa.array(np.asarray(predict(pairs), dtype="float64"))
                yield pa.RecordBatch.from_arrays([*part.columns, scores], names=[*part.schema.names, out])

    return df.mapInArrow(run, schema)
