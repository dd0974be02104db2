"""Sinks and predictors behind the queries over landed files, on odd rows."""

import json

from pyspark.sql import functions as F

from lodestone.operators.encoding import score_items
from lodestone.plans.queries_sources import label_mean_predictor
from lodestone.session import fresh_dir
from lodestone.sources import readers, writers

ODD = ['a "quoted", text', "two\nlines", "[,]", "", None, "ä€😀", "\\", "x" * 300_000]


def test_json_arrays_come_back_whole(spark, tmp_path):
    rows = [(str(i), t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "id string, abstract string")
    for parts in (1, 3, 20):  # of 20 parts some are empty
        path = writers.write_json_array(df.repartition(parts), str(tmp_path / f"p{parts}"))
        for part in (tmp_path / f"p{parts}").glob("part-*"):
            assert isinstance(json.loads(part.read_text()), list)
        got = {r["id"]: r["abstract"] for r in readers.read_corpus(spark, path).collect()}
        assert got == {i: t or "" for i, t in rows}
    empty = writers.write_json_array(df.filter("false"), fresh_dir(spark, "none"))
    assert readers.read_corpus(spark, empty).count() == 0


def test_json_array_of_many_batches(spark, tmp_path):
    path = writers.write_json_array(spark.range(10_000).select(F.col("id").cast("string")).coalesce(1), str(tmp_path / "many"))
    assert sorted(int(r["id"]) for r in readers.read_corpus(spark, path).select("id").collect()) == list(range(10_000))


def test_broken_lines_are_kept_as_rejects(spark, tmp_path):
    from lodestone.operators import records

    good = {"MedlineCitation": {"PMID": "1", "Article": {"ArticleTitle": "T", "Abstract": {"AbstractText": "x" * 60}}}}
    short = {"MedlineCitation": {"PMID": "2", "Article": {"ArticleTitle": "T"}}}
    lines = [json.dumps(good), json.dumps(good)[:40], "", "no json", json.dumps(short), "{}"]
    (tmp_path / "r.jsonl").write_text("\n".join(lines))
    flat = records.flatten_records(readers.read_raw_records(spark, str(tmp_path / "r.jsonl")))
    assert [r["id"] for r in records.usable(flat).collect()] == ["PMID:1"]
    assert sorted(r["reason"] for r in records.rejected(flat).collect()) == ["malformed", "malformed", "malformed", "short abstract"]


def test_label_means_as_a_model(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 1), (3, [1.0, 0.0], 99)], "vec_id long, embedding array<float>, label int")
    got = {(r["vec_id"], r["condition"]): r["score"] for r in score_items(items, label_mean_predictor(items), "vec_id", "embedding").collect()}
    assert len(got) == 3 * 14 and got[1, "Atelectasis"] > 0.99 and got[2, "Atelectasis"] == 0.5 == got[1, "Hernia"] and got[3, "Atelectasis"] > 0.99
    none = items.filter("false")
    assert score_items(none, label_mean_predictor(none), "vec_id", "embedding").count() == 0
