"""Cosine search: exact, within partitions, and over clustered cells."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.operators import topk


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    if column.null_count:
        raise ValueError("null vector; filter before searching")
    flat = np.asarray(column.flatten(), dtype="float64")
    lengths = np.asarray(column.value_lengths())
    if (lengths != lengths[0]).any():
        raise ValueError(f"vectors of different lengths: {sorted(set(lengths.tolist()))[:5]}")
    return flat.reshape(len(column), lengths[0])


def _unit(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


class CosineScorer:
    def __init__(self, queries: pa.Table, vector: str):
        self.query_ids = queries.column("query_id").to_pylist()
        self.vector = vector
        self.turned = _unit(_matrix(queries.column("query_vector"))).T
        # a sum of d products of unit vectors in single precision is off by some d * 2^-24 at most, and scores are rounded to 6 digits
        self.slack = 2e-6 + len(self.turned) * 1.2e-7
        n = len(self.query_ids)
        self.blocks = [(lo, np.ascontiguousarray(self.turned[:, lo : lo + topk.QUERIES_AT_ONCE], dtype="float32")) for lo in range(0, n, topk.QUERIES_AT_ONCE)]

    def score(self, items: pa.RecordBatch) -> np.ndarray:
        return _unit(_matrix(items.column(self.vector))) @ self.turned

    def score_some(self, items: pa.RecordBatch, queries: np.ndarray) -> np.ndarray:
        """Scores with some of the queries, given by their places."""
        return _unit(_matrix(items.column(self.vector))) @ self.turned[:, queries]

    def hold(self, items: pa.RecordBatch) -> np.ndarray:
        """Unit vectors of the rows, in single precision; ``exact`` scores cells of these rows."""
        self.held = _unit(_matrix(items.column(self.vector)))
        return self.held.astype("float32")

    def exact(self, row: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Cosines of single cells of the rows held."""
        out = np.empty(len(row))
        for lo in range(0, len(row), 1 << 16):
            some = slice(lo, lo + (1 << 16))
            out[some] = np.einsum("ij,ij->i", self.held[row[some]], self.turned.T[query[some]])
        return out


def _make(vector: str):
    return lambda block: CosineScorer(block, vector)


def vector_topk(items: DataFrame, queries: DataFrame, ids: Sequence[str], k: int, vector: str = "embedding",
                score: str = "similarity") -> DataFrame:
    """(query_id, *ids, similarity, rank) over all items; queries carry query_id, query_vector."""
    items = items.select(*ids, vector).filter(F.col(vector).isNotNull())
    found = topk.topk(items, queries.select("query_id", "query_vector"), _make(vector), ids, k, topk.WIDE)
    return found.withColumnRenamed("score", score)


def vector_topk_within(items: DataFrame, queries: DataFrame, keys: Sequence[str], ids: Sequence[str], k: int,
                       vector: str = "embedding", score: str = "similarity") -> DataFrame:
    """As ``vector_topk``, each query against the items that share its keys
    (for example the same model and chunking strategy)."""
    items = items.select(*dict.fromkeys([*keys, *ids, vector])).filter(F.col(vector).isNotNull())
    queries = queries.select(*keys, "query_id", "query_vector")
    found = topk.topk_tiled(items, queries, _make(vector), ids, k, keys)
    return found.withColumnRenamed("score", score)


def with_distance(found: DataFrame, similarity: str = "similarity") -> DataFrame:
    return found.withColumn("distance", 1 - F.col(similarity))


def fit_cells(items: DataFrame, lists: int, vector: str = "embedding", seed: int = 42, max_iter: int = 10):
    """Cluster centres for the cell column, of all items."""
    train = items.select(array_to_vector(F.col(vector)).alias("features"))
    return KMeans(k=lists, seed=seed, maxIter=max_iter).fit(train)


def assign_cells(items: DataFrame, model, vector: str = "embedding") -> DataFrame:
    """Adds the nearest cell, in the JVM."""
    with_features = items.withColumn("features", array_to_vector(F.col(vector)))
    return model.setPredictionCol("cell").transform(with_features).drop("features")


def probe_cells(queries: DataFrame, model, nprobe: int) -> DataFrame:
    """One row per query and each of its ``nprobe`` nearest cells."""
    centres = np.array(model.clusterCenters())

    @F.pandas_udf("array<int>")
    def nearest(batch: pd.Series) -> pd.Series:
        points = np.array(batch.tolist(), dtype="float64")
        gaps = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]
        return pd.Series(list(np.argsort(gaps, axis=1, kind="stable")[:, :nprobe].astype("int32")))

    return queries.withColumn("cell", F.explode(nearest("query_vector")))


def vector_topk_cells(items_with_cell: DataFrame, queries: DataFrame, model, ids: Sequence[str], k: int, nprobe: int,
                      vector: str = "embedding") -> DataFrame:
    """Approximate search: exact cosine inside the probed cells only."""
    return vector_topk_within(items_with_cell, probe_cells(queries, model, nprobe), ["cell"], ids, k, vector)


def recall_at_k(approximate: DataFrame, exact: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Share of the exact answers the approximate search also found."""
    hits = approximate.select("query_id", *ids).withColumn("hit", F.lit(1))
    return exact.join(hits, ["query_id", *ids], "left").agg(
        F.round(F.avg(F.coalesce("hit", F.lit(0))), 6).alias("recall")
    )
