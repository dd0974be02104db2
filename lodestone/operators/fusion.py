"""Reciprocal rank fusion (Cormack et al. 2009) and what follows it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.vectors import cosine
from lodestone.operators.encoding import token_overlap
from lodestone.operators.topk import SCORE_DIGITS, rank_rows
from lodestone.session import materialise

RRF_DIGITS = 9


def fuse(lists: Sequence[tuple[DataFrame, float]], ids: Sequence[str], rrf_k: int = 60) -> DataFrame:
    """(query_id, *ids, rrf): sum of weight / (rrf_k + rank); an absent list adds nothing."""
    joined = side_by_side([ranked for ranked, _ in lists], ids)
    votes = [vote(F.col(f"rank_{i}"), F.lit(float(weight)), F.lit(rrf_k)) for i, (_, weight) in enumerate(lists)]
    return joined.select("query_id", *ids, F.round(reduce(add, votes), RRF_DIGITS).alias("rrf"))


def side_by_side(lists: Sequence[DataFrame], ids: Sequence[str]) -> DataFrame:
    """(query_id, *ids, rank_0, rank_1, ...): the lists full-outer-joined, null where a list lacks the item.

    Lists come out of a window per query, so they are partitioned alike and
    the join adds no shuffle.
    """
    named = [ranked.select("query_id", *ids, F.col("rank").alias(f"rank_{i}")) for i, ranked in enumerate(lists)]
    return reduce(lambda a, b: a.join(b, ["query_id", *ids], "full_outer"), named)


def vote(rank: Column, weight: Column, rrf_k: Column) -> Column:
    return F.coalesce(weight / (rrf_k + rank), F.lit(0.0))


def with_similarity(candidates: DataFrame, items: DataFrame, queries: DataFrame, ids: Sequence[str],
                    vector: str = "embedding") -> DataFrame:
    """Cosine to the query for every candidate, also those only BM25 found.

    The candidates are written first (running the search): with their size
    known, Spark broadcasts them to the scan of the items when they are small
    and shuffles otherwise.
    """
    candidates = materialise(candidates, "candidates")
    joined = candidates.join(items.select(*ids, F.col(vector).alias("_v")), list(ids)).join(
        queries.select("query_id", "query_vector"), "query_id"
    )
    similarity = F.round(cosine(F.col("_v"), F.col("query_vector")), SCORE_DIGITS)
    return joined.withColumn("vec_sim", similarity).drop("_v", "query_vector")


def floor_filter(candidates: DataFrame, floor: float | None, similarity: str = "vec_sim") -> DataFrame:
    return candidates if floor is None else candidates.filter(F.col(similarity) >= floor)


def weighted_hybrid(vector_hits: DataFrame, bm25_hits: DataFrame, items: DataFrame, queries: DataFrame,
                    ids: Sequence[str], k: int, bm25_weight: float = 1.0, vector_weight: float = 1.0, rrf_k: int = 60,
                    floor: float | None = None, floor_last: bool = False) -> DataFrame:
    """Fuse, drop what is below the floor, rank and keep k.

    ``floor_last`` applies the floor after the cut to k, so fewer than k rows
    (or none) may remain.
    """
    fused = fuse([(vector_hits, vector_weight), (bm25_hits, bm25_weight)], ids, rrf_k)
    scored = with_similarity(fused, items, queries, ids)
    if floor_last:
        return floor_filter(rank_rows(scored, ids, k, "rrf"), floor)
    return rank_rows(floor_filter(scored, floor), ids, k, "rrf")


def rerank(candidates: DataFrame, texts: DataFrame, queries: DataFrame, ids: Sequence[str], k: int,
           pair_score=None) -> DataFrame:
    """Rescore (query, text) pairs and keep k.  ``pair_score`` is a column, or a
    function DataFrame -> DataFrame that adds ``pair_score``; default token overlap."""
    pairs = materialise(candidates, "candidates").join(texts, list(ids)).join(queries.select("query_id", "query"), "query_id")
    if pair_score is None or isinstance(pair_score, Column):
        pairs = pairs.withColumn("pair_score", token_overlap() if pair_score is None else pair_score)
    else:
        pairs = pair_score(pairs)
    pairs = pairs.withColumn("pair_score", F.round("pair_score", SCORE_DIGITS)).drop("rank")
    return rank_rows(pairs, ids, k, "pair_score")
