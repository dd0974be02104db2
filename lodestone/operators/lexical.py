"""BM25 ranking of chunks (Okapi, Robertson & Zaragoza 2009).

Two passes over the chunks: one aggregation gives document frequencies, the
chunk count and the mean length; the second scores chunks against the query
block and keeps a running top n.  Postings are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.text import tokens
from lodestone.operators import topk
from lodestone.session import materialise

K1 = 1.5
B = 0.75
MAX_VOCABULARY = 500_000  # query terms whose filter is broadcast


def query_terms(queries: DataFrame, text: str = "query") -> DataFrame:
    """(query_id, term, qtf)."""
    exploded = queries.select("query_id", F.explode(tokens(text)).alias("term"))
    return exploded.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def term_statistics(chunks: DataFrame, vocabulary: DataFrame | None = None, toks: str = "tokens") -> DataFrame:
    """(term, df) plus one row with a null term: chunk count and total length.

    Counting is map-side first, so a term that is in every chunk costs no more
    shuffle than a rare one.
    """
    marked = F.concat(F.array(F.lit(None).cast("string")), F.array_distinct(toks))
    rows = chunks.select(F.explode(marked).alias("term"), F.size(toks).alias("dl"))
    if vocabulary is not None:
        known = vocabulary.select("term", F.lit(True).alias("known"))
        rows = rows.join(F.broadcast(known), "term", "left").filter("known OR term IS NULL")
    return rows.groupBy("term").agg(
        F.count("*").alias("df"),
        F.sum(F.when(F.col("term").isNull(), F.col("dl"))).alias("total_len"),
    )


def weighted_queries(chunks: DataFrame, queries: DataFrame, text: str = "query", toks: str = "tokens") -> DataFrame:
    """(query_id, terms, weights, mean_len): qtf * idf for each query term that occurs.

    Runs the statistics pass.
    """
    terms = query_terms(queries, text)
    vocabulary = terms.select("term").distinct()
    bounded = vocabulary.limit(MAX_VOCABULARY + 1).count() <= MAX_VOCABULARY
    # One pass over the chunks; the small result is read three times below.
    stats = materialise(term_statistics(chunks, vocabulary if bounded else None, toks), "terms")
    totals = stats.filter(F.col("term").isNull())
    n = F.lit(totals.select("df").scalar()).cast("double")
    mean_len = totals.select(F.col("total_len") / F.col("df")).scalar()
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = terms.join(stats.filter(F.col("term").isNotNull()).select("term", "df"), "term")
    return (
        weighted.withColumn("weight", F.col("qtf") * idf)
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("tw"))
        .select(
            "query_id",
            F.col("tw.term").alias("terms"),
            F.col("tw.weight").alias("weights"),
            mean_len.alias("mean_len"),
        )
    )


class BM25Scorer:
    def __init__(self, queries: pa.Table, toks: str, k1: float, b: float, pad_zero: bool):
        self.query_ids = queries.column("query_id").to_pylist()
        self.toks, self.k1, self.b, self.pad_zero = toks, k1, b, pad_zero
        self.mean_len = queries.column("mean_len")[0].as_py() if queries.num_rows else 1.0
        terms = queries.column("terms").to_pylist()
        weights = queries.column("weights").to_pylist()
        vocabulary = sorted({t for row in terms for t in row})
        place = {t: i for i, t in enumerate(vocabulary)}
        entries = sorted(
            (place[t], q, w) for q, (row, ws) in enumerate(zip(terms, weights)) for t, w in zip(row, ws)
        )
        self.vocabulary = pa.array(vocabulary, type=pa.string())
        self.query_of = np.array([e[1] for e in entries], dtype="int64")
        self.weight_of = np.array([e[2] for e in entries], dtype="float64")
        self.first = np.searchsorted([e[0] for e in entries], np.arange(len(vocabulary) + 1))

    def score(self, items: pa.RecordBatch) -> np.ndarray:
        rows, width, queries = items.num_rows, max(1, len(self.vocabulary)), len(self.query_ids)
        column = items.column(self.toks)
        lengths = np.asarray(column.value_lengths(), dtype="int64")
        term = pc.index_in(column.flatten().cast(pa.string()), value_set=self.vocabulary)
        known = np.asarray(term.is_valid())
        row = np.repeat(np.arange(rows), lengths)[known]
        cell, tf = np.unique(row * width + np.asarray(term.drop_null(), dtype="int64"), return_counts=True)
        row, term_no = cell // width, cell % width
        saturated = tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * lengths[row] / self.mean_len))
        # each (row, term) meets every query that holds the term
        fan = self.first[term_no + 1] - self.first[term_no]
        source = np.repeat(np.arange(len(cell)), fan)
        entry = np.arange(len(source)) - np.repeat(np.cumsum(fan) - fan, fan) + self.first[term_no][source]
        flat = np.bincount(
            row[source] * queries + self.query_of[entry],
            weights=saturated[source] * self.weight_of[entry],
            minlength=rows * queries,
        )
        scores = flat.reshape(rows, queries)
        return scores if self.pad_zero else np.where(scores > 0, scores, -np.inf)


def bm25_topk(chunks: DataFrame, queries: DataFrame, ids: Sequence[str], k: int, text: str = "chunk_text",
              query: str = "query", k1: float = K1, b: float = B, pad_zero: bool = False) -> DataFrame:
    """(query_id, *ids, bm25, rank).  Chunks without a query term are left out unless ``pad_zero``."""
    tokenised = chunks.filter(F.col(text).isNotNull()).select(*ids, tokens(text).alias("tokens"))
    weighted = weighted_queries(tokenised, queries, query)
    found = topk.topk(
        tokenised, weighted, lambda block: BM25Scorer(block, "tokens", k1, b, pad_zero), ids, k
    )
    return found.withColumnRenamed("score", "bm25")
