"""Evaluation queries: keyword and semantic metrics, the grid, sweeps and comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.constants import BM25_WEIGHT_SWEEP, FLOOR_SWEEP, K_SWEEP
from lodestone.operators import retrieval_eval as ev
from lodestone.operators.chunking import chunk
from lodestone.operators.cleaning import clean
from lodestone.operators.encoding import embed
from lodestone.operators.lexical import bm25_topk
from lodestone.operators.vector_search import vector_topk
from lodestone.plans.catalog import query
from lodestone.plans.evaluation import BY, keyword_grid
from lodestone.plans.queries_search import ENCODER, CENTROIDS, _lists_sql, text_index
from lodestone.plans.search import IDS, hybrid_lists, with_texts
from lodestone.plans.sql import CASES, CLEAN, QUERIES, bm25_hits, embedding, vector_hits, word_chunks
from lodestone.plans.tables import benchmark_cases, benchmark_queries, benchmark_topics, centroids, corpus, table
from lodestone.session import materialise

# Per case: hits(query_id, rank, chunk_text) against cases.
SCORES = """
judged AS (
  SELECT h.query_id, count(*) FILTER (WHERE len(list_filter(expected_keywords, lambda w: contains(lower(chunk_text), w))) > 0) AS relevant,
         string_agg(chunk_text, ' ' ORDER BY rank) AS joined
  FROM {hits} h JOIN cases USING (query_id) GROUP BY h.query_id),
{name} AS (
  SELECT query_id, difficulty, round(coalesce(relevant / 5.0::DOUBLE, 0) + 1e-9, 4) AS precision_at_k,
         round(CASE WHEN len(expected_keywords) > 0 THEN len(list_filter(expected_keywords, lambda w: contains(lower(coalesce(joined, '')), w)))::DOUBLE
               / len(expected_keywords) ELSE 0 END + 1e-9, 4) AS keyword_coverage
  FROM cases LEFT JOIN judged USING (query_id))"""


@query("keyword_scores", f"""WITH {CLEAN}, {word_chunks(512)}, {QUERIES}, {bm25_hits('b', 5)}, {CASES},
hits AS (SELECT query_id, rank, chunk_text FROM b JOIN chunks USING (doc_id, chunk_index)), {SCORES.format(hits='hits', name='per_case')}
SELECT query_id, precision_at_k, keyword_coverage FROM per_case""")
def keyword_scores(spark, sf):
    chunks = materialise(chunk(clean(corpus(spark, sf)), "fixed_512").select(*IDS, "chunk_text"), "chunks")
    cases = benchmark_cases(spark, sf)
    hits = with_texts(bm25_topk(chunks, cases, IDS, 5), chunks)
    return ev.keyword_scores(hits, cases, 5)


MODELS = ["hash32", "hash64"]
STRATEGIES = ["fixed_256", "fixed_512"]


def _grid_sql() -> str:
    parts, last = [CLEAN, QUERIES, CASES, word_chunks(256, "fixed_256"), word_chunks(512, "fixed_512")], []
    for model in MODELS:
        dim = int(model.removeprefix("hash"))
        parts.append(embedding(f"q_{model}", "q", "query_id", "query", dim))
        for strategy in STRATEGIES:
            at = f"{model}_{strategy}"
            parts.append(embedding(f"c_{at}", strategy, "doc_id, chunk_index", "chunk_text", dim))
            parts.append(vector_hits(f"v_{at}", 5, f"q_{model}", f"c_{at}"))
            parts.append(f"h_{at} AS (SELECT query_id, rank, chunk_text FROM v_{at} JOIN {strategy} USING (doc_id, chunk_index))")
            parts.append(SCORES.replace("judged", f"judged_{at}").format(hits=f"h_{at}", name=f"s_{at}"))
            last.append(f"SELECT '{model}' AS model, '{strategy}' AS strategy, * FROM s_{at}")
    return f"WITH {', '.join(parts)}, grid AS MATERIALIZED ({' UNION ALL '.join(last)})"


GRID = _grid_sql()
MEANS = f"""{GRID}, means AS (
  SELECT model, strategy, round(avg(precision_at_k) + 1e-9, 4) AS mean_precision_at_k, round(avg(keyword_coverage) + 1e-9, 4) AS mean_keyword_coverage,
         count(*) AS num_cases FROM grid GROUP BY model, strategy),
ranked AS (SELECT *, (row_number() OVER (ORDER BY mean_precision_at_k DESC, model, strategy))::INTEGER AS rank FROM means)"""


def _grid(spark, sf) -> DataFrame:
    return keyword_grid(spark, corpus(spark, sf), benchmark_cases(spark, sf), MODELS, STRATEGIES)


def _ranked(spark, sf) -> tuple[DataFrame, DataFrame]:
    per_case = _grid(spark, sf)
    means = ev.config_means(per_case, BY, ["precision_at_k", "keyword_coverage"])
    return per_case, ev.rank_configs(means, "mean_precision_at_k", BY)


@query("config_grid", f"{GRID} SELECT model, strategy, query_id, precision_at_k, keyword_coverage FROM grid")
def config_grid(spark, sf):
    return _grid(spark, sf)


@query("config_ranking", f"{MEANS} SELECT * FROM ranked")
def config_ranking(spark, sf):
    return _ranked(spark, sf)[1]


@query("config_winner", f"""{MEANS}, w AS (SELECT *, round(mean_precision_at_k - lead(mean_precision_at_k) OVER (ORDER BY rank) + 1e-9, 4) AS lead FROM ranked),
d AS (SELECT count(DISTINCT model) AS models, count(DISTINCT strategy) AS strategies FROM means)
SELECT w.*, models, strategies FROM w, d WHERE rank = 1""")
def config_winner(spark, sf):
    ranked = _ranked(spark, sf)[1]
    counted = ev.with_distinct_counts(ranked, models="model", strategies="strategy")
    return ev.versus_runner_up(counted, "mean_precision_at_k")


@query("config_by_difficulty", f"{GRID} SELECT model, strategy, difficulty, count(*) AS n, round(avg(precision_at_k) + 1e-9, 4) AS mean_precision_at_k FROM grid GROUP BY ALL")
def config_by_difficulty(spark, sf):
    return ev.by_difficulty(_grid(spark, sf), benchmark_cases(spark, sf), "precision_at_k", BY)


@query("results_export", f"""{MEANS}, nested AS (
  SELECT model, strategy, to_json(list({{'query_id': query_id, 'precision_at_k': precision_at_k, 'keyword_coverage': keyword_coverage}} ORDER BY query_id)) AS per_case
  FROM grid GROUP BY model, strategy)
SELECT model, strategy, mean_precision_at_k, mean_keyword_coverage, num_cases, per_case::VARCHAR AS per_case FROM means JOIN nested USING (model, strategy)""")
def results_export(spark, sf):
    per_case = _grid(spark, sf)
    means = ev.config_means(per_case, BY, ["precision_at_k", "keyword_coverage"])
    nested = ev.nested_results(per_case, means, BY, ["precision_at_k", "keyword_coverage"])
    return nested.withColumn("per_case", F.to_json("per_case"))


@query("config_gain", f"""{MEANS}, named AS (SELECT *, model || '/' || strategy AS label FROM means), base AS (SELECT * FROM named WHERE label = 'hash32/fixed_256')
SELECT n.label, n.mean_precision_at_k, n.mean_keyword_coverage,
  round(CASE WHEN b.mean_precision_at_k > 0 THEN (n.mean_precision_at_k - b.mean_precision_at_k) / b.mean_precision_at_k * 100 ELSE 0 END + 1e-9, 1) AS mean_precision_at_k_gain_pct,
  round(CASE WHEN b.mean_keyword_coverage > 0 THEN (n.mean_keyword_coverage - b.mean_keyword_coverage) / b.mean_keyword_coverage * 100 ELSE 0 END + 1e-9, 1) AS mean_keyword_coverage_gain_pct
FROM named n, base b""")
def config_gain(spark, sf):
    means = _ranked(spark, sf)[1].select(F.concat_ws("/", *BY).alias("label"), "mean_precision_at_k", "mean_keyword_coverage")
    return ev.improvement(means, "hash32/fixed_256", "label", ["mean_precision_at_k", "mean_keyword_coverage"])


def _vector_cases(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Label means as queries over all vectors; the topics of a label are the means of its quarters."""
    items = table(spark, sf, "embeddings")
    queries = centroids(items, "label").select(F.col("label").alias("query_id"), F.col("vector").alias("query_vector"))
    quarters = items.withColumn("topic_pos", F.col("vec_id") % 4)
    topics = centroids(quarters, "label", "topic_pos").select(
        F.col("label").alias("query_id"), "topic_pos", F.col("vector").alias("topic_vector")
    )
    return items, queries, topics


def _semantic_sql(k: int) -> str:
    return f"""WITH {CENTROIDS},
t AS MATERIALIZED (
  SELECT label AS query_id, pos, list(x ORDER BY i) AS tv FROM (
    SELECT label, pos, i, avg(x) AS x FROM (SELECT label, vec_id % 4 AS pos, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e) GROUP BY label, pos, i)
  GROUP BY label, pos),
s AS (SELECT c.label AS query_id, vec_id, v, round(list_cosine_similarity(v, cv), 6) AS similarity FROM e, c),
h AS MATERIALIZED (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id))::INTEGER AS rank FROM s QUALIFY rank <= {k})"""


def _score_sql(sims: str, by: str) -> str:
    """(by, query_id, metrics) from sims(by, query_id, hit, pos, sim)."""
    return f"""
best AS (SELECT {by}, hit, max(sim) AS m FROM {sims} GROUP BY ALL),
sp AS (SELECT {by}, round(avg(m) + 1e-9, 4) AS semantic_precision, round(max(m) + 1e-9, 4) AS best_similarity, count(*) AS kept FROM best GROUP BY ALL),
tc AS (SELECT {by}, round(avg(CASE WHEN m > 0.45::DOUBLE THEN 1.0::DOUBLE ELSE 0 END) + 1e-9, 4) AS topic_coverage
       FROM (SELECT {by}, pos, max(sim) AS m FROM {sims} GROUP BY ALL) GROUP BY ALL)"""


@query("semantic_scores", f"""{_semantic_sql(5)},
sims AS (SELECT query_id, vec_id AS hit, pos, round(list_cosine_similarity(v, tv), 6) AS sim FROM h JOIN t USING (query_id)),
{_score_sql('sims', 'query_id')}
SELECT query_id, semantic_precision, topic_coverage, best_similarity, kept FROM sp JOIN tc USING (query_id)""")
def semantic_scores(spark, sf):
    items, queries, topics = _vector_cases(spark, sf)
    hits = vector_topk(items, queries, ["vec_id"], 5).join(items.select("vec_id", "embedding"), "vec_id")
    return ev.semantic_scores(hits, topics)


@query("k_sweep", f"""{_semantic_sql(max(K_SWEEP))}, ks AS (SELECT unnest({K_SWEEP}) AS k),
sims AS (SELECT k, query_id, vec_id AS hit, pos, round(list_cosine_similarity(v, tv), 6) AS sim FROM h JOIN ks ON rank <= k JOIN t USING (query_id)),
{_score_sql('sims', 'k, query_id')}
SELECT k, round(avg(semantic_precision) + 1e-9, 4) AS mean_semantic_precision, round(avg(topic_coverage) + 1e-9, 4) AS mean_topic_coverage, count(*) AS num_cases
FROM sp JOIN tc USING (k, query_id) GROUP BY k""")
def k_sweep(spark, sf):
    items, queries, topics = _vector_cases(spark, sf)
    hits = vector_topk(items, queries, ["vec_id"], max(K_SWEEP)).join(items.select("vec_id", "embedding"), "vec_id")
    per_case = ev.semantic_scores(ev.sweep_k(hits, K_SWEEP), topics, ["k"])
    return ev.config_means(per_case, ["k"], ["semantic_precision", "topic_coverage"])


# Settings of the fusion sweep: BM25 weights, floors before the cut, floors after it, and the broad presets.
SETTINGS = (
    [{"label": f"weight {w}", "bm25_weight": w, "k": 7} for w in BM25_WEIGHT_SWEEP]
    + [{"label": f"floor {f}", "floor": f, "k": 15} for f in FLOOR_SWEEP]
    + [{"label": f"late floor {f}", "floor": f, "k": 10, "floor_last": True} for f in FLOOR_SWEEP]
    + [
        {"label": "broad 30 to 10", "bm25_weight": 2.0, "depth": 30, "k": 10, "floor": 0.30},
        {"label": "broad 40 to 7", "bm25_weight": 2.0, "depth": 40, "k": 7, "floor": 0.30},
    ]
)
DEPTH = 40


def _settings_sql() -> str:
    rows = []
    for i, s in enumerate(SETTINGS):
        floor = s.get("floor")
        rows.append(f"({i}, '{s['label']}', {s.get('depth', 20)}, {s['k']}, {s.get('bm25_weight', 1.0)}::DOUBLE, "
                    f"{'NULL' if floor is None else floor}::DOUBLE, {str(s.get('floor_last', False)).upper()})")
    return f"settings AS (SELECT * FROM (VALUES {', '.join(rows)}) AS x(pos, label, depth, k, w, floor, late))"


SWEEP = f"""{_lists_sql(DEPTH)}, {_settings_sql()},
votes AS (
  SELECT label, query_id, doc_id, chunk_index, 1.0::DOUBLE / (60 + rank) AS vote FROM v JOIN settings ON rank <= depth
  UNION ALL SELECT label, query_id, doc_id, chunk_index, w / (60 + rank) FROM b JOIN settings ON rank <= depth),
fused AS (SELECT label, query_id, doc_id, chunk_index, round(sum(vote), 9) AS rrf FROM votes GROUP BY ALL),
sim AS (SELECT f.*, coalesce(similarity, 0) AS vec_sim FROM fused f LEFT JOIN v_s USING (query_id, doc_id, chunk_index)),
early AS (SELECT sim.*, k, floor FROM sim JOIN settings USING (label) WHERE late OR floor IS NULL OR vec_sim >= floor),
cut AS (SELECT *, (row_number() OVER (PARTITION BY label, query_id ORDER BY rrf DESC, doc_id, chunk_index))::INTEGER AS rank FROM early QUALIFY rank <= k),
final AS MATERIALIZED (SELECT label, query_id, doc_id, chunk_index, rrf, vec_sim, rank FROM cut WHERE floor IS NULL OR vec_sim >= floor)"""


def _sweep_hits(spark, sf) -> tuple[DataFrame, DataFrame]:
    index = text_index(spark, sf)
    vector_hits_, bm25_hits_, encoded = hybrid_lists(benchmark_queries(spark, sf), index, ENCODER, DEPTH)
    return ev.sweep_fusion(vector_hits_, bm25_hits_, index, encoded, IDS, SETTINGS), index


@query("fusion_sweep", f"{SWEEP} SELECT label, query_id, doc_id, chunk_index, rrf, vec_sim, rank FROM final")
def fusion_sweep(spark, sf):
    return _sweep_hits(spark, sf)[0]


TOPICS_SQL = r"""
tp AS MATERIALIZED (
  SELECT query_id, (generate_subscripts(ts, 1) - 1)::INTEGER AS pos, unnest(ts) AS topic
  FROM (SELECT query_id, list_filter(regexp_split_to_array(query, '\.\s*'), lambda s: s <> '') AS ts FROM q))"""
SWEEP_MEANS = f"""{SWEEP}, {TOPICS_SQL}, {embedding('tv', 'tp', 'query_id, pos', 'topic')},
ts AS MATERIALIZED (
  SELECT query_id, doc_id, chunk_index, pos, round(sum(t.v * c.v), 6) AS sim
  FROM (SELECT DISTINCT query_id, doc_id, chunk_index FROM final) f JOIN tv t USING (query_id) JOIN cv c USING (doc_id, chunk_index, bucket) GROUP BY ALL),
sims AS (
  SELECT label, f.query_id, f.doc_id || ':' || f.chunk_index AS hit, tp.pos, coalesce(sim, 0) AS sim
  FROM final f JOIN tp USING (query_id) LEFT JOIN ts ON ts.query_id = f.query_id AND ts.doc_id = f.doc_id AND ts.chunk_index = f.chunk_index AND ts.pos = tp.pos),
{_score_sql('sims', 'label, query_id')},
per_case AS (
  SELECT label, q.query_id, coalesce(semantic_precision, 0) AS semantic_precision, coalesce(topic_coverage, 0) AS topic_coverage, coalesce(kept, 0) AS kept
  FROM settings CROSS JOIN q LEFT JOIN sp USING (label, query_id) LEFT JOIN tc USING (label, query_id)),
means AS (SELECT label, round(avg(semantic_precision) + 1e-9, 4) AS mean_semantic_precision, round(avg(topic_coverage) + 1e-9, 4) AS mean_topic_coverage,
  round(avg(kept) + 1e-9, 4) AS mean_kept, count(*) AS num_cases FROM per_case GROUP BY label)"""


def _sweep_means(spark, sf) -> DataFrame:
    hits, index = _sweep_hits(spark, sf)
    with_vectors = with_texts(hits, index, "embedding")
    topics = embed(benchmark_topics(spark, sf), ENCODER, "topic", "topic_vector", precise=True)
    cases = ev.per_config(benchmark_queries(spark, sf).select("query_id"), [{"label": s["label"]} for s in SETTINGS])
    per_case = ev.semantic_scores(with_vectors, topics, ["label"], cases=cases)
    return ev.config_means(per_case, ["label"], ["semantic_precision", "topic_coverage", "kept"])


@query("config_sweep", f"{SWEEP_MEANS} SELECT * FROM means")
def config_sweep(spark, sf):
    return _sweep_means(spark, sf)


@query("config_best", f"""{SWEEP_MEANS}
SELECT means.*, pos, round(0.5::DOUBLE * mean_semantic_precision + 0.5::DOUBLE * mean_topic_coverage + 1e-9, 6) AS combined
FROM means JOIN settings USING (label) ORDER BY combined DESC, pos LIMIT 1""")
def config_best(spark, sf):
    places = F.array(*[F.lit(s["label"]) for s in SETTINGS])
    means = _sweep_means(spark, sf).withColumn("pos", (F.array_position(places, F.col("label")) - 1).cast("int"))
    return ev.best_combined(means, "pos")
