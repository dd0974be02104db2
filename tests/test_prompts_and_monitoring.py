import datetime as dt

from pyspark.sql import functions as F

from lodestone.constants import CONDITION_CONTEXT
from lodestone.operators import monitoring, prompts
from lodestone.session import fresh_dir
from lodestone.sources import writers


def test_focus(spark):
    df = spark.createDataFrame([("q", "Mass"), ("q", "Unknown"), ("q", None)], "query string, condition string")
    got = [r["focused_query"] for r in prompts.focus_query(df).collect()]
    assert got == ["q " + CONDITION_CONTEXT["Mass"], "q", "q"]


def predictions(spark, rows):
    return spark.createDataFrame(rows, "item int, condition string, probability double, detected boolean")


def test_query_from_predictions(spark):
    rows = [(1, c, p, True) for c, p in [("Mass", 0.5), ("Edema", 0.9), ("Nodule", 0.4), ("Hernia", 0.3)]]
    rows += [(2, "Mass", 0.105, False), (2, "Edema", 0.10, False)]
    got = {r["item"]: r for r in prompts.synthesise_queries(predictions(spark, rows), "item").collect()}
    assert got[1]["query"] == "Chest X-ray findings suggest: Edema, Mass, Nodule, Hernia. Provide clinical guidance."
    terms = " ".join(CONDITION_CONTEXT[c] for c in ["Edema", "Mass", "Nodule"])
    assert got[1]["focused_query"] == got[1]["query"] + " " + terms
    assert got[1]["finding"] == "Edema (90%), Mass (50%), Nodule (40%), Hernia (30%)"
    assert got[2]["query"] == "Chest X-ray analysis. Top finding: Mass (11% confidence)."
    assert got[2]["focused_query"].endswith(CONDITION_CONTEXT["Mass"]) and got[2]["detected_conditions"] == []
    asked = predictions(spark, rows).withColumn("asked", F.when(F.col("item") == 1, "my question").otherwise(""))
    given = {r["item"]: r["query"] for r in prompts.synthesise_queries(asked, "item", "asked").collect()}
    assert given[1] == "my question" and given[2].startswith("Chest X-ray analysis")


def test_prompts_number_sources_in_rank_order(spark):
    hits = spark.createDataFrame(
        [(1, 2, "d2", "second", 0.25), (1, 1, "d1", "first", 0.75)],
        "query_id int, rank int, doc_id string, chunk_text string, similarity double",
    )
    asked = spark.createDataFrame([(1, "why", "Mass", 0.5), (2, "none", "Mass", 0.5)], "query_id int, query string, finding string, confidence double")
    clinical = {r["query_id"]: r for r in prompts.build_prompts(asked, hits).collect()}
    assert "(2 sources):**\n[Source 1] (PMID: d1, relevance: 0.750)\nfirst\n\n[Source 2] (PMID: d2, relevance: 0.250)\nsecond\n\nBased" in clinical[1]["prompt"]
    assert clinical[2]["n_sources"] == 0
    other = prompts.build_prompts(asked, hits, style="assistant").filter("query_id = 1").first()["prompt"]
    assert "[Source 1: d1] (relevance: 0.750)\nfirst" in other and "- Confidence: 50.0%" in other and other.endswith("**Clinical Summary:**")


def test_usage(spark, rows):
    day = dt.datetime(2024, 1, 10, 12)
    data = [(day - dt.timedelta(days=d), 10.0 * d, d != 1, "p" if d else None, 0.5) for d in (0, 1, 1, 6, 7, 8)]
    logs = spark.createDataFrame(data, "created_at timestamp, latency_ms double, success boolean, prediction string, confidence double")
    got = {str(r["day"]): tuple(r)[1:] for r in monitoring.usage_daily(logs, F.lit(day), 7).collect()}
    assert got == {"2024-01-10": (1, 0.0, 1.0), "2024-01-09": (2, 10.0, 0.0), "2024-01-04": (1, 60.0, 1.0)}
    assert rows(monitoring.prediction_frequency(logs)) == [("p", 5, 0.5)]


def test_terms(spark, rows):
    df = spark.createDataFrame([("Lung Cancer", "lung cancer, asthma"), ("x", None)], "title string, abstract string")
    assert rows(monitoring.term_mentions(df, ["lung cancer", "asthma", "lupus"], "title", "abstract")) == [
        ("asthma", 1, False), ("lung cancer", 2, False), ("lupus", 0, True),
    ]
    assert rows(monitoring.largest_groups(spark.createDataFrame([("b",), ("a",), ("b",)], "k string"), "k", 1)) == [("b", 2)]


def test_registry(spark):
    def version(kind, name, hour, active=False):
        return (kind, name, 0.9, "{}", "/m", active, dt.datetime(2024, 1, 1, hour))

    schema = "model_type string, version string, accuracy double, metrics string, file_path string, is_active boolean, created_at timestamp"
    old = spark.createDataFrame([version("cnn", "v1", 1, True), version("emb", "e1", 1, True)], schema)
    new = spark.createDataFrame([version("cnn", "v2", 2), version("cnn", "v3", 3)], schema).drop("is_active")
    path = writers.save_registry(spark, old, new)
    after = spark.read.parquet(path)
    assert after.count() == 4
    assert sorted(r["version"] for r in monitoring.active_models(after).collect()) == ["e1", "v3"]


def test_query_log(spark):
    df = spark.createDataFrame(
        [("q", "Mass", 0.5, ["PMID:1", "PMID:2"], "r" * 3000, 12.5, None, None, dt.datetime(2024, 1, 2, 3))],
        "query string, prediction string, confidence double, retrieved_doc_ids array<string>, response string, latency_ms double, "
        "success boolean, error_message string, created_at timestamp",
    )
    target = fresh_dir(spark, "log")
    writers.append_query_log(df, target)
    writers.append_query_log(df, target)
    log = spark.read.parquet(target)
    row = log.first()
    assert log.count() == 2 and len(row["response_text"]) == 2000 and row["success"] and str(row["log_date"]) == "2024-01-02"
    assert row["retrieved_doc_ids"] == ["PMID:1", "PMID:2"]


def test_throughput(spark):
    runs = spark.createDataFrame([(1, 775, 22868.0), (10, 7750, 16051.0)], "scale int, docs int, total_ms double")
    got = {r["scale"]: (r["docs_per_sec"], r["speed_up"]) for r in monitoring.throughput(runs).collect()}
    assert got == {1: (33.89, 1.0), 10: (482.84, 14.25)}
