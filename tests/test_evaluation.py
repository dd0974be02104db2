import math

import pytest
from pyspark.sql import functions as F

from lodestone.operators import retrieval_eval as ev
from lodestone.operators.fusion import weighted_hybrid
from lodestone.plans import evaluation


def test_keyword_scores(spark):
    hits = spark.createDataFrame(
        [(1, 1, "Empiric ANTIBIOTICS given"), (1, 2, "nothing here"), (1, 3, "sputum culture"), (2, 1, "no match")],
        "query_id int, rank int, chunk_text string",
    )
    cases = spark.createDataFrame(
        [(1, ["antibiotics", "Sputum Culture", "copd"]), (2, ["x-ray"]), (3, ["absent"]), (4, [])],
        "query_id int, expected_keywords array<string>",
    )
    got = {r["query_id"]: (r["precision_at_k"], r["keyword_coverage"]) for r in ev.keyword_scores(hits, cases, 5).collect()}
    assert got == {1: (0.4, 0.6667), 2: (0.0, 0.0), 3: (0.0, 0.0), 4: (0.0, 0.0)}
    cut = {r["query_id"]: r["precision_at_k"] for r in ev.keyword_scores(hits, cases, 2).collect()}
    assert cut[1] == 0.5


def angle(cos):
    return [cos, math.sqrt(1 - cos * cos)]


def test_semantic_scores_and_the_limit(spark):
    # topics along both axes; the second hit has similarity exactly 0.45 to the first topic
    topics = spark.createDataFrame(
        [(1, 0, [1.0, 0.0]), (1, 1, [0.0, -1.0]), (2, 0, [1.0, 0.0])], "query_id int, topic_pos int, topic_vector array<double>"
    )
    hits = spark.createDataFrame(
        [(1, 1, angle(0.45)), (2, 1, angle(0.46))], "query_id int, rank int, embedding array<double>"
    )
    cases = spark.createDataFrame([(1,), (2,), (3,)], "query_id int")
    got = {r["query_id"]: tuple(r)[1:] for r in ev.semantic_scores(hits, topics, cases=cases).collect()}
    assert got == {1: (0.45, 0.0, 0.45, 1), 2: (0.46, 1.0, 0.46, 1), 3: (0.0, 0.0, 0.0, 0)}


def test_grid_tables(spark, rows):
    cases = spark.createDataFrame([(1, "standard"), (2, "complex")], "query_id int, difficulty string")
    grid = ev.per_config(cases, [{"model": "a", "strategy": "s"}, {"model": "b", "strategy": "s"}])
    assert grid.count() == 4
    scores = grid.withColumn("p", F.when(F.col("model") == "a", 0.5).otherwise(F.col("query_id") / 2.0))
    by = ["model", "strategy"]
    means = ev.config_means(scores, by, ["p"])
    assert rows(means) == [("a", "s", 0.5, 2), ("b", "s", 0.75, 2)]
    ranked = ev.rank_configs(means, "mean_p", by)
    best = ev.versus_runner_up(ranked, "mean_p").first()
    assert (best["model"], best["lead"]) == ("b", 0.25)
    assert rows(ev.by_difficulty(scores.drop("difficulty"), cases, "p", ["model"]))[1] == ("a", "standard", 1, 0.5)
    nested = {r["model"]: [tuple(c) for c in r["per_case"]] for r in ev.nested_results(scores, means, by, ["p"]).collect()}
    assert nested["b"] == [(1, 0.5), (2, 1.0)]
    gains = {r["model"]: r["mean_p_gain_pct"] for r in ev.improvement(means, "a", "model", ["mean_p"]).collect()}
    assert gains == {"a": 0.0, "b": 50.0}
    zero = spark.createDataFrame([("z", 0.0), ("y", 1.0)], "model string, m double")
    assert {r["m_gain_pct"] for r in ev.improvement(zero, "z", "model", ["m"]).collect()} == {0.0}


def test_best_combined_takes_the_earliest(spark):
    m = spark.createDataFrame([(0, 0.4, 0.6), (1, 0.6, 0.4), (2, 0.1, 0.2)], "pos int, mean_semantic_precision double, mean_topic_coverage double")
    assert ev.best_combined(m, "pos").first()["pos"] == 0


def test_sweep_equals_one_by_one(spark):
    def ranked(pairs):
        return spark.createDataFrame([(q, i, r) for q in (0, 1) for r, i in enumerate(pairs[q], 1)], "query_id int, item int, rank int")

    vec, bm = ranked([[1, 2, 3, 4, 5], [5, 4, 3, 2, 1]]), ranked([[6, 2, 7, 1], [1, 8, 5, 6]])
    items = spark.createDataFrame([(i, angle(i / 10)) for i in range(1, 9)], "item int, embedding array<double>")
    queries = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0])], "query_id int, query_vector array<double>")
    settings = [
        {"label": "a", "depth": 5, "k": 3},
        {"label": "b", "depth": 2, "k": 4, "bm25_weight": 2.0},
        {"label": "c", "depth": 5, "k": 3, "floor": 0.3},
        {"label": "d", "depth": 5, "k": 3, "floor": 0.3, "floor_last": True},
    ]
    swept = ev.sweep_fusion(vec, bm, items, queries, ["item"], settings).collect()
    for s in settings:
        alone = weighted_hybrid(
            vec.filter(F.col("rank") <= s["depth"]), bm.filter(F.col("rank") <= s["depth"]), items, queries, ["item"], s["k"],
            s.get("bm25_weight", 1.0), 1.0, 60, s.get("floor"), s.get("floor_last", False),
        ).collect()
        want = sorted((r["query_id"], r["rank"], r["item"], r["rrf"], r["vec_sim"]) for r in alone)
        got = sorted((r["query_id"], r["rank"], r["item"], r["rrf"], r["vec_sim"]) for r in swept if r["label"] == s["label"])
        assert got == want and want


def test_grid_from_documents(spark):
    docs = spark.createDataFrame(
        [(1, "Pneumonia", "Pneumonia is treated with antibiotics in most adult patients seen."),
         (2, "Effusion", "Pleural effusion is drained by thoracentesis in most adult patients."),
         (3, "Other", "A text about something else that no query will ever want to find.")],
        "id int, title string, abstract string",
    )
    cases = spark.createDataFrame(
        [(10, "pneumonia antibiotics", ["antibiotics"]), (11, "pleural effusion", ["thoracentesis"])],
        "query_id int, query string, expected_keywords array<string>",
    )
    models, strategies = ["hash64", "hash128"], ["document", "sentence_based"]
    scores = evaluation.keyword_grid(spark, docs, cases, models, strategies, k=1)
    assert scores.count() == 8 and scores.filter("precision_at_k = 1 AND keyword_coverage = 1").count() == 8
    topics = spark.createDataFrame([(10, 0, "pneumonia antibiotics"), (11, 0, "something far away")], "query_id int, topic_pos int, topic string")
    sem = evaluation.semantic_grid(spark, docs, cases, topics, models, strategies, k=1)
    assert sem.count() == 8 and sem.filter("query_id = 10").agg(F.min("best_similarity")).first()[0] > 0.3
    with pytest.raises(ValueError, match="unknown name"):
        evaluation.keyword_grid(spark, docs, cases, ["biobert"], strategies)


def test_k_sweep_and_previews(spark):
    hits = spark.createDataFrame([(0, r, "x" * 130) for r in range(1, 16)], "query_id int, rank int, chunk_text string")
    counts = {r["k"]: r["count"] for r in ev.sweep_k(hits, [3, 5, 15]).groupBy("k").count().collect()}
    assert counts == {3: 3, 5: 5, 15: 15}
    assert ev.hit_previews(hits).first()["preview"] == "x" * 120 + "..."
    with_kw = ev.with_case_keywords(hits.select("query_id").distinct(), spark.createDataFrame([(9, 0.5)], "query_id int, keyword_precision double"))
    assert with_kw.first()["keyword_precision"] == 0.0


def test_embedding_comparison(spark):
    docs = spark.createDataFrame([(1, "Title", "word " * 60)], "id int, title string, abstract string")
    got = {(r["model"], r["strategy"]): r for r in evaluation.embedding_comparison(spark, docs, ["hash32", "hash64"], ["document", "fixed_256"]).collect()}
    assert len(got) == 4 and got["hash64", "document"]["dimension"] == 64 and got["hash32", "fixed_256"]["num_chunks"] == 2
    assert all(r["embed_time_sec"] > 0 for r in got.values())
