"""Evaluation of retrieval over a grid of models and chunking strategies."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.unions import union_all
from lodestone.operators.chunking import chunk
from lodestone.operators.cleaning import clean
from lodestone.operators.encoding import embed, embed_each, embedding_summary
from lodestone.operators.retrieval_eval import keyword_scores, per_config, semantic_scores
from lodestone.operators.vector_search import vector_topk
from lodestone.plans.search import IDS, encode_queries, with_texts
from lodestone.session import materialise

BY = ["model", "strategy"]


def grid_hits(spark: SparkSession, docs: DataFrame, cases: DataFrame, models: Sequence[str], strategies: Sequence[str],
              k: int = 5, precise: bool = True) -> DataFrame:
    """(model, strategy, query_id, rank, chunk_text, embedding, similarity) for every configuration.

    The configurations are a short fixed list; each one adds a branch to one plan.
    """
    branches = []
    for strategy in strategies:
        vectors = chunk(clean(docs), strategy).select(*IDS, "chunk_text")
        vectors = embed_each(vectors, {f"embedding_{model}": model for model in models}, precise=precise)
        index = materialise(vectors, "grid")  # chunked once, encoded by every model
        for model in models:
            items = index.select(*IDS, "chunk_text", F.col(f"embedding_{model}").alias("embedding"))
            hits = vector_topk(items, encode_queries(cases, model), IDS, k)
            kept = with_texts(hits, items, "chunk_text", "embedding")
            branches.append(kept.select(F.lit(model).alias("model"), F.lit(strategy).alias("strategy"), "*"))
    return union_all(*branches)


def embedding_comparison(spark: SparkSession, docs: DataFrame, models: Sequence[str], strategies: Sequence[str]) -> DataFrame:
    """(model, strategy, num_chunks, avg_chunk_chars, embed_time_sec, avg_embed_time_ms, dimension).

    Runs one timed embedding job per configuration, over chunks written before the clock starts.
    """
    timed = []
    for strategy in strategies:
        chunks = materialise(chunk(clean(docs), strategy).select("chunk_text"), "compare")
        for model in models:
            started = time.perf_counter()
            tagged = embed(chunks, model).withColumns({"model": F.lit(model), "strategy": F.lit(strategy)})
            row = embedding_summary(tagged, BY).first()
            seconds = time.perf_counter() - started
            if row is not None:
                per_chunk = round(seconds / row["num_chunks"] * 1000, 2)
                timed.append((*row[:4], round(seconds, 3), per_chunk, row["dimension"]))
    return spark.createDataFrame(
        timed,
        "model string, strategy string, num_chunks long, avg_chunk_chars double, embed_time_sec double, "
        "avg_embed_time_ms double, dimension int",
    )


def grid_cases(cases: DataFrame, models: Sequence[str], strategies: Sequence[str]) -> DataFrame:
    return per_config(cases, [{"model": m, "strategy": s} for m in models for s in strategies])


def keyword_grid(spark: SparkSession, docs: DataFrame, cases: DataFrame, models: Sequence[str], strategies: Sequence[str],
                 k: int = 5) -> DataFrame:
    """(model, strategy, query_id, precision_at_k, keyword_coverage)."""
    hits = grid_hits(spark, docs, cases, models, strategies, k)
    return keyword_scores(hits, grid_cases(cases, models, strategies), k, BY)


def semantic_grid(spark: SparkSession, docs: DataFrame, cases: DataFrame, topics: DataFrame, models: Sequence[str],
                  strategies: Sequence[str], k: int = 5) -> DataFrame:
    """(model, strategy, query_id, semantic_precision, topic_coverage, best_similarity, kept); topics are texts."""
    hits = grid_hits(spark, docs, cases, models, strategies, k)
    texts = topics.select("query_id", "topic_pos", "topic")
    encoded = union_all(
        *[
            embed(texts, m, "topic", "topic_vector", precise=True)
            .select(F.lit(m).alias("model"), "query_id", "topic_pos", "topic_vector")
            for m in models
        ]
    )
    return semantic_scores(hits, encoded, BY, ["model", "query_id"], cases=grid_cases(cases, models, strategies))
