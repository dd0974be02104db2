"""Search queries: embeddings, exact and approximate vectors, BM25, fusion, requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.constants import EXACT_FUSION, HYBRID_PRESET
from lodestone.functions.text import relevance_grade
from lodestone.functions.unions import union_all
from lodestone.operators import cell_index, cleaning, encoding, lexical, postings, prompts, vector_search
from lodestone.operators.chunking import chunk
from lodestone.operators.classifier import apply_thresholds
from lodestone.operators.monitoring import log_rows
from lodestone.plans import search
from lodestone.plans.catalog import query
from lodestone.plans.corpus import build_index
from lodestone.plans.search import IDS
from lodestone.plans.sql import (
    CLEAN,
    PREDICTIONS,
    QUERIES,
    REQUESTS,
    bm25_hits,
    embedding,
    focused,
    quoted,
    toks,
    vector_hits,
    word_chunks,
)
from lodestone.plans.tables import (
    benchmark_queries,
    centroids,
    condition_scores,
    condition_thresholds,
    corpus,
    table,
    request_id,
    user_requests,
)
from lodestone.session import fresh_dir, materialise
from lodestone.sources.readers import load_index, spread

ENCODER = "hash64"


def text_index(spark, sf) -> DataFrame:
    """Documents in word chunks with double vectors, so results agree with SQL to the last digit shown."""
    return build_index(spark, corpus(spark, sf), "fixed_512", ENCODER, precise=True)


@query("hash_embed", f"WITH {embedding('e', 'documents', 'doc_id', 'text')} SELECT doc_id, bucket AS position, round(v, 6) AS value FROM e")
def hash_embed(spark, sf):
    vectors = encoding.embed(spread(table(spark, sf, "documents").select("doc_id", "text")), ENCODER, "text", precise=True)
    return encoding.embedding_entries(vectors, ["doc_id"]).withColumn("value", F.round("value", 6))


@query("embed_summary", f"""WITH {CLEAN}, {word_chunks(512)}, {word_chunks(256, 'small')}
SELECT 'hash64' AS model, 'fixed_512' AS strategy, count(*) AS num_chunks, round(avg(length(chunk_text)) + 1e-9, 1) AS avg_chunk_chars, 64 AS dimension FROM chunks
UNION ALL SELECT 'hash32', 'fixed_256', count(*), round(avg(length(chunk_text)) + 1e-9, 1), 32 FROM small""")
def embed_summary(spark, sf):
    docs = cleaning.clean(corpus(spark, sf))

    def one(model: str, strategy: str) -> DataFrame:
        vectors = encoding.embed(chunk(docs, strategy).select("chunk_text"), model)
        return vectors.select(F.lit(model).alias("model"), F.lit(strategy).alias("strategy"), "*")

    both = union_all(one("hash64", "fixed_512"), one("hash32", "fixed_256"))
    return encoding.embedding_summary(both, ["model", "strategy"])


def _all_as_queries(spark, sf) -> tuple[DataFrame, DataFrame]:
    items = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    return items, items.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))


@query("vector_topk", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
s AS (SELECT a.vec_id AS query_id, b.vec_id, round(list_cosine_similarity(a.v, b.v), 6) AS similarity FROM e a, e b)
SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id))::INTEGER AS rank FROM s QUALIFY rank <= 5""")
def vector_topk(spark, sf):
    items, queries = _all_as_queries(spark, sf)
    return vector_search.vector_topk(items, queries, ["vec_id"], 5)


CENTROIDS = """
e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
c AS MATERIALIZED (
  SELECT label, list(x ORDER BY i) AS cv FROM (
    SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e) GROUP BY label, i)
  GROUP BY label)"""


@query("vector_topk_filtered", f"""WITH {CENTROIDS},
s AS (SELECT c.label AS query_id, vec_id, round(list_cosine_similarity(v, cv), 6) AS similarity FROM e JOIN c USING (label))
SELECT *, round(1 - similarity, 6) AS distance, (row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id))::INTEGER AS rank
FROM s QUALIFY rank <= 10""")
def vector_topk_filtered(spark, sf):
    """Each label's mean vector searches only the vectors of its own label."""
    items = table(spark, sf, "embeddings")
    queries = centroids(items, "label").select("label", F.col("label").alias("query_id"), F.col("vector").alias("query_vector"))
    found = vector_search.vector_topk_within(items, queries, ["label"], ["vec_id"], 10)
    return vector_search.with_distance(found).withColumn("distance", F.round("distance", 6))


def _cells(spark, sf, nprobe: int = 3) -> tuple[DataFrame, DataFrame]:
    items, queries = _all_as_queries(spark, sf)
    model = vector_search.fit_cells(items, lists=10)
    placed = vector_search.assign_cells(items, model)
    found = vector_search.vector_topk_cells(placed, queries, model, ["vec_id"], 5, nprobe)
    return found, vector_search.vector_topk(items, queries, ["vec_id"], 5)


@query("vector_topk_ivf")
def vector_topk_ivf(spark, sf):
    return _cells(spark, sf)[0]


def _stored_cells(spark, sf, one_in: int = 1) -> tuple[DataFrame, DataFrame]:
    """Queries are the rows whose vec_id is divisible by ``one_in``, against all rows; probes follow all rows as queries."""
    items, every = _all_as_queries(spark, sf)
    path = cell_index.build_cells(items, fresh_dir(spark, "cells"), ["vec_id"])
    exact = materialise(cell_index.exact_finds(spark, path, every, ["vec_id"], 5), "exact-finds")
    nprobe = cell_index.probes_needed(spark, path, every, ["vec_id"], 5, exact=exact)
    asked = F.col("query_id") % one_in == 0 if one_in > 1 else F.lit(True)
    return cell_index.search_cells(spark, path, every.filter(asked), ["vec_id"], 5, nprobe), exact.filter(asked).drop("cell")


@query("vector_stored_cells")
def vector_stored_cells(spark, sf):
    """Search of a saved cell index by a twentieth of its rows; as many of its cells as all rows as queries need for a recall of 0.95."""
    return _stored_cells(spark, sf, 20)[0]


@query("stored_cells_recall")
def stored_cells_recall(spark, sf):
    """Recall over every row as a query."""
    return vector_search.recall_at_k(*_stored_cells(spark, sf), ["vec_id"])


@query("ivf_recall")
def ivf_recall(spark, sf):
    return vector_search.recall_at_k(*_cells(spark, sf), ["vec_id"])


@query("index_search", f"""WITH {CLEAN}, {word_chunks(256)}, {QUERIES}, {embedding('cv', 'chunks', 'doc_id, chunk_index', 'chunk_text', 32)},
{embedding('qv', 'q', 'query_id', 'query', 32)}, {vector_hits('v', 5)}
SELECT query_id, doc_id, chunk_index, similarity, round(1 - similarity, 6) AS distance, rank FROM v""")
def index_search(spark, sf):
    """One saved table holds two models; the search reads the partition of one of them."""
    path = fresh_dir(spark, "index")
    for model, strategy in [("hash32", "fixed_256"), ("hash64", "document")]:
        build_index(spark, corpus(spark, sf), strategy, model, path, precise=True)
    one = load_index(spark, path, "hash32", "fixed_256")
    found = vector_search.vector_topk(one, search.encode_queries(benchmark_queries(spark, sf), "hash32"), IDS, 5)
    return vector_search.with_distance(found).withColumn("distance", F.round("distance", 6))


@query("bm25_topk", f"""WITH {CLEAN}, {word_chunks(512)}, {QUERIES}, {bm25_hits('b', 10)}
SELECT query_id, doc_id, chunk_index, bm25, rank FROM b""")
def bm25_topk(spark, sf):
    chunks = chunk(cleaning.clean(corpus(spark, sf)), "fixed_512")
    return lexical.bm25_topk(chunks, benchmark_queries(spark, sf), IDS, 10)


@query("bm25_stored_topk", f"""WITH {CLEAN}, {word_chunks(512)}, {QUERIES}, {bm25_hits('b', 10)}
SELECT query_id, doc_id, chunk_index, bm25, rank FROM b""")
def bm25_stored_topk(spark, sf):
    """The same ranking from a stored inverted index: the search reads the query terms' buckets and no text."""
    path = postings.build_postings(chunk(cleaning.clean(corpus(spark, sf)), "fixed_512"), fresh_dir(spark, "postings"), IDS)
    return postings.search_postings(spark, path, benchmark_queries(spark, sf), IDS, 10)


@query("bm25_term_stats", f"""WITH {CLEAN}, {word_chunks(512)}, {QUERIES}, {bm25_hits('b', 1)}
SELECT term, df, NULL::BIGINT AS total_len FROM b_d WHERE term IN (SELECT term FROM b_q)
UNION ALL SELECT NULL, count(*), sum(len(ts))::BIGINT FROM b_k""")
def bm25_term_stats(spark, sf):
    chunks = chunk(cleaning.clean(corpus(spark, sf)), "fixed_512")
    tokenised = chunks.select(lexical.tokens("chunk_text").alias("tokens"))
    vocabulary = lexical.query_terms(benchmark_queries(spark, sf)).select("term").distinct()
    return lexical.term_statistics(tokenised, vocabulary)


def _lists_sql(depth: int) -> str:
    return (
        f"WITH {CLEAN}, {word_chunks(512)}, {QUERIES}, {embedding('cv', 'chunks', 'doc_id, chunk_index', 'chunk_text')}, "
        f"{embedding('qv', 'q', 'query_id', 'query')}, {vector_hits('v', depth)}, {bm25_hits('b', depth)}"
    )


def _fused_sql(k: int, depth: int = EXACT_FUSION["depth"]) -> str:
    return f"""{_lists_sql(depth)}, votes AS (
  SELECT query_id, doc_id, chunk_index, 1.0::DOUBLE / (60 + rank) AS vote FROM v
  UNION ALL SELECT query_id, doc_id, chunk_index, 1.0::DOUBLE / (60 + rank) FROM b),
fused AS (SELECT query_id, doc_id, chunk_index, round(sum(vote), 9) AS rrf FROM votes GROUP BY ALL),
top AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, doc_id, chunk_index))::INTEGER AS rank FROM fused QUALIFY rank <= {k})"""


@query("rrf_fuse", f"{_fused_sql(5)} SELECT query_id, doc_id, chunk_index, rrf, rank FROM top")
def rrf_fuse(spark, sf):
    return search.retrieve_fused(benchmark_queries(spark, sf), text_index(spark, sf), ENCODER)


WEIGHTED_SQL = f"""{_lists_sql(HYBRID_PRESET['depth'])}, votes AS (
  SELECT query_id, doc_id, chunk_index, 1.0::DOUBLE / (60 + rank) AS vote FROM v
  UNION ALL SELECT query_id, doc_id, chunk_index, 2.0::DOUBLE / (60 + rank) FROM b),
fused AS (SELECT query_id, doc_id, chunk_index, round(sum(vote), 9) AS rrf FROM votes GROUP BY ALL),
kept AS (SELECT query_id, doc_id, chunk_index, rrf, coalesce(similarity, 0) AS vec_sim
  FROM fused LEFT JOIN v_s USING (query_id, doc_id, chunk_index) WHERE coalesce(similarity, 0) >= 0.30::DOUBLE),
top AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, doc_id, chunk_index))::INTEGER AS rank FROM kept QUALIFY rank <= 7)"""


@query("rrf_weighted_floor", f"{WEIGHTED_SQL} SELECT query_id, doc_id, chunk_index, rrf, vec_sim, rank FROM top")
def rrf_weighted_floor(spark, sf):
    return search.retrieve_hybrid(benchmark_queries(spark, sf), text_index(spark, sf), ENCODER)


@query("relevance_grade", f"""{WEIGHTED_SQL}, graded AS (SELECT query_id,
  CASE WHEN vec_sim > 0.45::DOUBLE THEN 'RELEVANT' WHEN vec_sim < 0.30::DOUBLE THEN 'NOISE' ELSE 'MARGINAL' END AS grade FROM top)
SELECT query_id, grade, count(*) AS n FROM graded GROUP BY ALL""")
def relevance_grades(spark, sf):
    hits = search.retrieve_hybrid(benchmark_queries(spark, sf), text_index(spark, sf), ENCODER)
    return hits.groupBy("query_id", relevance_grade("vec_sim").alias("grade")).agg(F.count("*").alias("n"))


@query("hybrid_rerank", f"""{_fused_sql(20)},
pairs AS (
  SELECT query_id, doc_id, chunk_index, list_distinct({toks('query')}) AS qt, list_distinct({toks('chunk_text')}) AS ct
  FROM top JOIN chunks USING (doc_id, chunk_index) JOIN q USING (query_id)),
rescored AS (SELECT query_id, doc_id, chunk_index, round(len(list_intersect(qt, ct))::DOUBLE / len(qt), 6) AS pair_score FROM pairs)
SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY pair_score DESC, doc_id, chunk_index))::INTEGER AS rank FROM rescored QUALIFY rank <= 5""")
def hybrid_rerank(spark, sf):
    found = search.retrieve_reranked(benchmark_queries(spark, sf), text_index(spark, sf), ENCODER)
    return found.select("query_id", *IDS, "pair_score", "rank")


@query("focused_query", f"WITH {REQUESTS} SELECT query_id, condition, focused_query FROM freq")
def focused_query(spark, sf):
    return prompts.focus_query(user_requests(spark, sf)).select("query_id", "condition", "focused_query")


@query("request_validation", """
WITH r AS (SELECT conv_id * 1000 + turn AS query_id, text AS query, (length(text) % 300) / 250.0::DOUBLE - 0.05::DOUBLE AS confidence,
  CASE WHEN role = 'user' THEN 'image/png' ELSE 'text/plain' END AS content_type FROM conversations)
SELECT query_id, nullif(concat_ws('; ', CASE WHEN length(query) < 5 THEN 'query too short' END,
  CASE WHEN confidence < 0 OR confidence > 1 THEN 'confidence out of range' END,
  CASE WHEN NOT starts_with(content_type, 'image/') THEN 'not an image' END), '') AS reason FROM r""")
def request_validation(spark, sf):
    requests = table(spark, sf, "conversations").select(
        request_id().alias("query_id"),
        F.col("text").alias("query"),
        ((F.length("text") % 300) / F.lit(250.0) - F.lit(0.05)).alias("confidence"),
        F.when(F.col("role") == "user", "image/png").otherwise("text/plain").alias("content_type"),
    )
    return cleaning.validate_requests(requests).select("query_id", "reason")


RETRIEVE = f"""{CLEAN}, {word_chunks(512)}, {REQUESTS}, {embedding('cv', 'chunks', 'doc_id, chunk_index', 'chunk_text')},
{embedding('qv', 'freq', 'query_id', 'focused_query')}, {vector_hits('v', 7)},
hits AS MATERIALIZED (SELECT query_id, doc_id, chunk_index, chunk_text, round(similarity + 1e-9, 4) AS similarity, rank FROM v JOIN chunks USING (doc_id, chunk_index))"""


@query("batch_retrieve", f"WITH {RETRIEVE} SELECT query_id, doc_id, chunk_index, chunk_text, similarity, rank FROM hits")
def batch_retrieve(spark, sf):
    return search.batch_retrieve(user_requests(spark, sf), text_index(spark, sf), ENCODER)


# Three decimals with halves away from zero, as the Java formatter prints a four-digit number.
RELEVANCE = "printf('%.3f', round(similarity + 1e-9, 3))"
BLOCK = f"""blocks AS (SELECT query_id, count(*) AS n, string_agg('[Source ' || rank || '] (PMID: ' || doc_id || ', relevance: ' ||
  {RELEVANCE} || ')' || chr(10) || chunk_text, chr(10) || chr(10) ORDER BY rank) AS context FROM hits GROUP BY query_id)"""


def _prompt_sql(finding: str, confidence: str) -> str:
    gap = "chr(10) || chr(10)"
    return (
        f"{quoted(prompts.CLINICAL_PROMPT_HEAD)} || {gap} || '**AI Classification Result:**' || chr(10) || '- Prediction: ' || {finding} "
        f"|| chr(10) || '- Confidence: ' || printf('%.1f%%', round(({confidence}) * 100 + 1e-9, 1)) || {gap} || '**Clinical Query:**' || chr(10) || query || {gap} "
        f"|| '**Retrieved Medical Literature (' || n || ' sources):**' || chr(10) || context || {gap} || {quoted(prompts.CLINICAL_PROMPT_TAIL)}"
    )


@query("prompt_table", f"""WITH {RETRIEVE}, {BLOCK}
SELECT query_id, {_prompt_sql('condition', '(query_id % 101) / 100.0::DOUBLE')} AS prompt, n::INTEGER AS n_sources FROM freq JOIN blocks USING (query_id)""")
def prompt_table(spark, sf):
    asked = user_requests(spark, sf).withColumns(
        {"finding": F.col("condition"), "confidence": F.pmod("query_id", F.lit(101)) / F.lit(100.0)}
    )
    made = search.batch_query(asked, text_index(spark, sf), ENCODER)
    return made.select("query_id", "prompt", "n_sources")


SYNTH = f"""{PREDICTIONS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY probability DESC, condition) AS pos FROM pred),
context AS (SELECT condition, trim({focused("''", "condition")}) AS words FROM cond),
per AS (
  SELECT item_id, count(*) FILTER (WHERE detected) AS n, max(probability) AS confidence, min(condition) FILTER (WHERE pos = 1) AS top,
         string_agg(condition, ', ' ORDER BY pos) FILTER (WHERE detected) AS names,
         string_agg(words, ' ' ORDER BY pos) FILTER (WHERE detected AND dpos <= 3) AS ctx,
         string_agg(condition || ' (' || printf('%.0f%%', round(probability * 100 + 1e-9, 0)) || ')', ', ' ORDER BY pos) FILTER (WHERE detected AND dpos <= 5) AS described,
         min(words) FILTER (WHERE pos = 1) AS top_words
  FROM (SELECT *, count(*) FILTER (WHERE detected) OVER (PARTITION BY item_id ORDER BY pos) AS dpos FROM ranked) JOIN context USING (condition)
  GROUP BY item_id),
made AS MATERIALIZED (
  SELECT item_id, confidence, coalesce(names, '') AS detected_conditions,
    CASE WHEN n > 0 THEN 'Chest X-ray findings suggest: ' || names || '. Provide clinical guidance.'
         ELSE 'Chest X-ray analysis. Top finding: ' || top || ' (' || printf('%.0f%%', round(confidence * 100 + 1e-9, 0)) || ' confidence).' END AS query,
    CASE WHEN n > 0 THEN ctx ELSE top_words END AS terms,
    CASE WHEN n > 0 THEN described ELSE top || ' (' || printf('%.0f%%', round(confidence * 100 + 1e-9, 0)) || ')' END AS finding
  FROM per),
asked AS MATERIALIZED (SELECT *, query || ' ' || terms AS focused_query FROM made)"""


def _predictions(spark, sf) -> DataFrame:
    return apply_thresholds(condition_scores(spark, sf), condition_thresholds(spark))


@query("synthesised_queries", f"WITH {SYNTH} SELECT item_id, query, focused_query, finding, confidence, detected_conditions FROM asked")
def synthesised_queries(spark, sf):
    made = prompts.synthesise_queries(_predictions(spark, sf), "item_id")
    return made.withColumn("detected_conditions", F.array_join("detected_conditions", ", "))


@query("batch_analyse", f"""WITH {CLEAN}, {word_chunks(512)}, {SYNTH}, {embedding('cv', 'chunks', 'doc_id, chunk_index', 'chunk_text')},
aq AS (SELECT item_id AS query_id, focused_query FROM asked), {embedding('qv', 'aq', 'query_id', 'focused_query')}, {vector_hits('v', 7)},
hits AS (SELECT query_id, doc_id, chunk_index, chunk_text, round(similarity + 1e-9, 4) AS similarity, rank FROM v JOIN chunks USING (doc_id, chunk_index)), {BLOCK}
SELECT query_id, {_prompt_sql('finding', 'confidence')} AS prompt FROM blocks JOIN asked ON item_id = query_id""")
def batch_analyse(spark, sf):
    made = search.batch_analyse(_predictions(spark, sf), "item_id", text_index(spark, sf), ENCODER)
    return made.select("query_id", "prompt")


@query("query_log_rows", """
SELECT u.text AS query_text, length(a.text) / 10.0::DOUBLE AS latency_ms, substr(a.text, 1, 2000) AS response_text, a.text IS NOT NULL AS success,
       CASE WHEN a.text IS NULL THEN 'no answer' END AS error_message
FROM conversations u LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'""")
def query_log_rows(spark, sf):
    turns = table(spark, sf, "conversations")
    answers = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("query"))
    responses = asked.join(answers, ["conv_id", "turn"], "left").select(
        "query",
        F.lit(None).cast("string").alias("prediction"),
        F.lit(None).cast("double").alias("confidence"),
        F.array().cast("array<string>").alias("retrieved_doc_ids"),
        "response",
        (F.length("response") / F.lit(10.0)).alias("latency_ms"),
        F.col("response").isNotNull().alias("success"),
        F.when(F.col("response").isNull(), "no answer").alias("error_message"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )
    return log_rows(responses).select("query_text", "latency_ms", "response_text", "success", "error_message")
