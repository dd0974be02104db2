"""Batch forms of the serving requests: a table of requests in, a table of answers out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.constants import EXACT_FUSION, HYBRID_PRESET, SERVED_PRESET
from lodestone.functions.numbers import settled
from lodestone.operators.encoding import embed
from lodestone.operators.fusion import fuse, rerank, weighted_hybrid
from lodestone.operators.lexical import bm25_topk
from lodestone.operators.prompts import build_prompts, focus_query, synthesise_queries
from lodestone.operators.topk import rank_rows
from lodestone.operators.vector_search import vector_topk
from lodestone.session import materialise

IDS = ["doc_id", "chunk_index"]


def encode_queries(queries: DataFrame, encoder: str, text: str = "query", precise: bool = True) -> DataFrame:
    return embed(queries.select("query_id", text), encoder, text=text, out="query_vector", precise=precise)


def with_texts(hits: DataFrame, index: DataFrame, *columns: str) -> DataFrame:
    """Hits with columns of the index.  Written first, so that the join knows how small they are."""
    return materialise(hits, "hits").join(index.select(*IDS, *(columns or ("chunk_text",))), IDS)


def retrieve(requests: DataFrame, index: DataFrame, encoder: str, k: int = SERVED_PRESET["k"], text: str = "query") -> DataFrame:
    """Vector top-k with chunk texts; similarity rounded to 4 digits."""
    hits = vector_topk(index, encode_queries(requests, encoder, text), IDS, k)
    return with_texts(hits, index).withColumn("similarity", settled("similarity", 4))


def retrieve_alike(requests: DataFrame, index: DataFrame, encoder: str, k: int = SERVED_PRESET["k"], text: str = "query") -> DataFrame:
    """``retrieve`` where many requests have the same vector, such as those made from a few conditions: each vector is searched once."""
    encoded = materialise(encode_queries(requests, encoder, text).select("query_id", "query_vector"), "encoded")
    vectors = materialise(encoded.select("query_vector").distinct().select(F.monotonically_increasing_id().alias("vector_id"), "query_vector"), "vectors")
    found = materialise(vector_topk(index, vectors.withColumnRenamed("vector_id", "query_id"), IDS, k).drop("rank").withColumnRenamed("query_id", "vector_id"), "hits")
    own = encoded.join(vectors, "query_vector").select("query_id", "vector_id")
    hits = rank_rows(own.join(found, "vector_id").drop("vector_id"), IDS, k, "similarity")  # a query_id's rows are one ranking, as in ``retrieve``
    return hits.join(index.select(*IDS, "chunk_text"), IDS).withColumn("similarity", settled("similarity", 4))


def hybrid_lists(requests: DataFrame, index: DataFrame, encoder: str, depth: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vector hits, BM25 hits, encoded queries)."""
    encoded = encode_queries(requests, encoder)
    return vector_topk(index, encoded, IDS, depth), bm25_topk(index, requests, IDS, depth), encoded


def retrieve_hybrid(requests: DataFrame, index: DataFrame, encoder: str, preset: dict = HYBRID_PRESET,
                    floor_last: bool = False) -> DataFrame:
    """Weighted fusion of vector and BM25 lists with a similarity floor."""
    vector_hits, bm25_hits, encoded = hybrid_lists(requests, index, encoder, preset["depth"])
    return weighted_hybrid(
        vector_hits, bm25_hits, index, encoded, IDS, preset["k"], preset["bm25_weight"], preset["vector_weight"],
        preset["rrf_k"], preset["floor"], floor_last,
    )


def retrieve_fused(requests: DataFrame, index: DataFrame, encoder: str, preset: dict = EXACT_FUSION) -> DataFrame:
    """Unweighted fusion, no floor."""
    vector_hits, bm25_hits, _ = hybrid_lists(requests, index, encoder, preset["depth"])
    return rank_rows(fuse([(vector_hits, 1.0), (bm25_hits, 1.0)], IDS, preset["rrf_k"]), IDS, preset["k"], "rrf")


def retrieve_reranked(requests: DataFrame, index: DataFrame, encoder: str, preset: dict = EXACT_FUSION, pair_score=None) -> DataFrame:
    """Fusion down to ``depth`` candidates, then pair scores decide the last k."""
    candidates = retrieve_fused(requests, index, encoder, {**preset, "k": preset["depth"]})
    texts = index.select(*IDS, "chunk_text")
    return rerank(candidates, texts, requests, IDS, preset["k"], pair_score)


def batch_retrieve(requests: DataFrame, index: DataFrame, encoder: str, k: int = SERVED_PRESET["k"]) -> DataFrame:
    """Requests (query_id, query, condition): augment the query, then search."""
    return retrieve(focus_query(requests), index, encoder, k, "focused_query")


def batch_query(requests: DataFrame, index: DataFrame, encoder: str, k: int = SERVED_PRESET["k"], style: str = "clinical") -> DataFrame:
    """Requests (query_id, query, finding, confidence[, condition]) with prompts over what was retrieved.

    Without a condition the finding takes its place; an unknown one is shown as not specified.
    """
    condition = F.coalesce(F.nullif("condition", F.lit("")), "finding") if "condition" in requests.columns else F.col("finding")
    asked = requests.withColumn("condition", condition)
    hits = batch_retrieve(asked, index, encoder, k)
    shown = F.when(F.col("condition") == "unknown", "not specified").otherwise(F.col("condition"))
    return build_prompts(asked.withColumn("finding", shown), hits, style)


def batch_analyse(predictions: DataFrame, item_id: str, index: DataFrame, encoder: str, k: int = SERVED_PRESET["k"]) -> DataFrame:
    """From per-item predictions to prompts: make the query, search with its context, assemble."""
    asked = synthesise_queries(predictions, item_id).withColumnRenamed(item_id, "query_id")
    hits = retrieve_alike(asked, index, encoder, k, "focused_query")
    return build_prompts(asked, hits)
