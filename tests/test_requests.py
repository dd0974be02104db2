"""Requests of long conversations keep apart."""

from pyspark.sql import functions as F

import __spark_entry__ as entry

TURNS = [(1, 1, "chest pain and cough"), (1, 999, "fever"), (1, 1000, "short breath"), (1, 1001, "swollen legs"), (2, 0, "old fracture"), (2, 1, "dry skin"), (2, 2001, "night sweats"), (4, 1, "back pain")]


def test_requests_of_long_conversations(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(40)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    turns = spark.createDataFrame([(c, t, "user", x) for c, t, x in TURNS], "conv_id long, turn int, role string, text string")
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    asked = {r.query_id: r.focused_query for r in entry.queries()["focused_query"](spark, str(tmp_path)).collect()}
    assert len(asked) == len(TURNS)
    assert {c * 1000 + t for c, t, _ in TURNS if t < 1000} <= set(asked)
    assert entry.queries()["request_validation"](spark, str(tmp_path)).select("query_id").distinct().count() == len(TURNS)
    hits = entry.queries()["batch_retrieve"](spark, str(tmp_path))
    per_request = {r.query_id: (r.n, r.ranks) for r in hits.groupBy("query_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("rank")).alias("ranks")).collect()}
    assert set(per_request) == set(asked) and all(ranks == list(range(1, n + 1)) for n, ranks in per_request.values())
    prompts = entry.queries()["prompt_table"](spark, str(tmp_path)).collect()
    assert len(prompts) == len(TURNS) and all(asked[r.query_id].startswith(q) for r in prompts for _, _, q in TURNS if q in r.prompt)
