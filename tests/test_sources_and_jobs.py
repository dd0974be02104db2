import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lodestone.functions.vectors import has_dimension
from lodestone.operators.chunking import chunk
from lodestone.operators.cleaning import clean
from lodestone.operators.dedup import dedup_chunks
from lodestone.plans import corpus as job
from lodestone.plans.tables import as_corpus, table
from lodestone.session import fresh_dir
from lodestone.sources import readers, writers
from lodestone.streaming.ingest import start_ingest
from lodestone.streaming.usage import start_usage, usage_windows

SF = "/root/testdata/sf0.001"


def test_corpus_json(spark, tmp_path):
    docs = [{"id": "PMID:1", "title": "T", "abstract": "A", "full_text": "", "year": "2020", "keywords": ["k"]}, {"id": "PMID:2", "title": "U"}]
    array, lines = tmp_path / "a.json", tmp_path / "l.jsonl"
    array.write_text(json.dumps(docs))
    lines.write_text("\n".join(json.dumps(d) for d in docs))
    for got in (readers.read_corpus(spark, str(array)), readers.read_corpus(spark, str(lines), lines=True)):
        by_id = {r["id"]: r for r in got.collect()}
        assert by_id["PMID:1"]["keywords"] == ["k"] and by_id["PMID:1"]["year"] == "2020"
        assert by_id["PMID:2"]["abstract"] == "" and by_id["PMID:2"]["year"] is None and by_id["PMID:2"]["keywords"] == []
    fallback = spark.createDataFrame([("f",)], "id string")
    assert readers.load_corpus(spark, str(tmp_path / "none.json"), fallback).first()["id"] == "f"
    assert readers.load_corpus(spark, str(array), fallback).count() == 2
    twice = readers.read_corpus(spark, str(array)).withColumn("pos", F.explode(F.array(F.lit(0), F.lit(1))))
    out = writers.write_corpus_cache(twice, fresh_dir(spark, "cache"), ["pos"])
    assert readers.read_corpus(spark, out, lines=True).count() == 2


def test_image_labels_and_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_image_labels(spark, str(tmp_path))
    (tmp_path / "Data_Entry_2017_v2020.csv").write_text(
        "Image Index,Finding Labels,Follow-up #,Patient ID\na.png,Mass|Edema,0,7\nb.png,No Finding,0,8\nc.png,Mass,1,9\n"
    )
    labels = readers.read_image_labels(spark, str(tmp_path))
    assert {tuple(r) for r in labels.collect()} == {("a.png", "Mass|Edema", "7"), ("b.png", "No Finding", "8"), ("c.png", "Mass", "9")}
    for place, body in [("images_002/images/a.png", b"2i"), ("images_001/a.png", b"1"), ("images_003/images/b.png", b"3i"), ("b.png", b"top"), ("images_013/c.png", b"13")]:
        path = tmp_path / "img" / place
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    images = readers.read_images(spark, str(tmp_path / "img"))
    got = {r["image"]: (r["is_missing"], bytes(r["content"]) if r["content"] else None) for r in readers.with_images(labels, images).collect()}
    assert got == {"a.png": (False, b"2i"), "b.png": (False, b"top"), "c.png": (True, None)}


def test_class_folders(spark, tmp_path):
    for split, cls in [("train", "PNEUMONIA"), ("train", "NORMAL"), ("val", "NORMAL"), ("test", "PNEUMONIA")]:
        folder = tmp_path / split / cls
        folder.mkdir(parents=True)
        (folder / "x.jpeg").write_bytes(b"x")
    got = {(r["split"], r["class_name"], r["class_index"]) for r in readers.read_class_folders(spark, str(tmp_path)).collect()}
    assert got == {("train", "PNEUMONIA", 1), ("train", "NORMAL", 0), ("val", "NORMAL", 0), ("test", "PNEUMONIA", 1)}


def test_thresholds_file(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text(json.dumps({"thresholds": {"Mass": 0.2, "Pleural_Thickening": 0.3}, "method": "f1"}, indent=1))
    got = {r["condition"]: r["threshold"] for r in readers.read_thresholds(spark, str(path)).collect()}
    assert len(got) == 14 and (got["Mass"], got["Pleural Thickening"], got["Edema"]) == (0.2, 0.3, 0.5)
    assert {r["threshold"] for r in readers.read_thresholds(spark, str(tmp_path / "no.json")).collect()} == {0.5}


def test_cases(spark, tmp_path):
    path = tmp_path / "cases.json"
    path.write_text(json.dumps([{"id": 1, "query": "q", "expected_topics": ["a", "b"], "expected_keywords": ["k"], "difficulty": "standard"}]))
    assert readers.read_keyword_cases(spark, str(path)).first()["expected_keywords"] == ["k"]
    assert [(r["query_id"], r["topic_pos"], r["topic"]) for r in readers.read_topics(spark, str(path)).collect()] == [(1, 0, "a"), (1, 1, "b")]


def test_index_round_trip_and_pruning(spark):
    docs = as_corpus(table(spark, SF, "documents"))
    path = fresh_dir(spark, "index")
    index = job.build_index(spark, docs, "fixed_512", "hash32", path)
    job.build_index(spark, docs, "fixed_256", "hash64", path)
    assert index.filter(~has_dimension(F.col("embedding"), 32)).count() == 0
    one = readers.load_index(spark, path, "hash32", "fixed_512")
    assert one.count() == index.count() and readers.load_index(spark, path).count() > one.count()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(embedding_model" in plan


def test_corpus_job_counts_in_one_run(spark):
    docs = as_corpus(table(spark, SF, "documents"))
    got = job.run_corpus_job(docs, fresh_dir(spark, "job"), "recursive_800")
    cleaned = clean(docs)
    chunks = chunk(cleaned, "recursive_800")
    assert (got["docs_in"], got["docs"], got["chunks_in"]) == (docs.count(), cleaned.count(), chunks.count())
    assert got["chunks"] == dedup_chunks(chunks).count() and got["duplicates"] == got["chunks_in"] - got["chunks"] > 0
    embedded = fresh_dir(spark, "job")
    job.run_corpus_job(docs, embedded, "fixed_512", "hash32")
    assert spark.read.parquet(embedded).first()["embedding"] is not None


def test_result_does_not_depend_on_partitions(spark, rows):
    docs = as_corpus(table(spark, SF, "documents"))
    one = rows(job.unique_chunks(docs.coalesce(1), "recursive_800"))
    assert one == rows(job.unique_chunks(docs.repartition(8), "recursive_800"))


def test_scaled_copies(spark):
    docs = spark.createDataFrame([("a", "t", "x")], "id string, title string, abstract string")
    got = {(r["id"], r["abstract"]) for r in job.scaled(docs, 3).collect()}
    assert got == {("a", "x"), ("a_copy1", "[Batch 1] x"), ("a_copy2", "[Batch 2] x")}
    runs = job.scale_test(spark, as_corpus(table(spark, SF, "documents")), factors=(1, 2))
    assert [r["docs"] for r in runs.orderBy("scale").collect()][1] > 0


def test_streamed_ingest_equals_batch_and_replays(spark, rows):
    docs = as_corpus(table(spark, SF, "documents"))
    landed, target = fresh_dir(spark, "landed"), fresh_dir(spark, "target")
    checkpoint = fresh_dir(spark, "cp")

    def run(cp):
        stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(landed)
        start_ingest(spark, stream, target, cp, "recursive_800").awaitTermination()

    docs.filter("id < 100").coalesce(1).write.mode("append").parquet(landed)
    run(checkpoint)
    docs.filter("id >= 100").coalesce(1).write.mode("append").parquet(landed)
    run(checkpoint)
    batch = dedup_chunks(chunk(clean(docs), "recursive_800"))
    assert rows(spark.read.parquet(target)) == rows(batch)
    run(fresh_dir(spark, "cp"))  # everything is read again, nothing is inserted again
    assert spark.read.parquet(target).count() == batch.count()


def test_usage_stream_closes_windows_and_drops_late_rows(spark, rows):
    base = dt.datetime(2024, 1, 1)
    on_time = [(base + dt.timedelta(hours=h), float(h), h % 5 != 0) for h in range(0, 75)]
    schema = "created_at timestamp, latency_ms double, success boolean"
    landed, target, cp = fresh_dir(spark, "landed"), fresh_dir(spark, "target"), fresh_dir(spark, "cp")

    def run():
        stream = spark.readStream.schema(schema).parquet(landed)
        start_usage(stream, target, cp).awaitTermination()

    spark.createDataFrame(on_time, schema).coalesce(1).write.mode("append").parquet(landed)
    run()
    late = [(base + dt.timedelta(hours=1), 1000.0, True), (base + dt.timedelta(hours=120), 1.0, True)]
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(landed)
    run()
    closed = spark.read.parquet(target)
    batch = usage_windows(spark.createDataFrame(on_time, schema))
    assert closed.count() == 4  # the last window is still open
    assert rows(closed) == rows(batch)
