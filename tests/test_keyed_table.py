"""Tables of unique keys with several writers."""

import threading

import pytest
from pyspark.sql import functions as F

from lodestone.operators.monitoring import register_models
from lodestone.session import fresh_dir
from lodestone.sources.keyed_table import KeyedTable

SCHEMA = "k string, n int, word string"


def table(spark, buckets=8):
    return KeyedTable(spark, fresh_dir(spark, "keyed"), ["k"], buckets)


def batch(spark, lo, hi, word="x"):
    return spark.createDataFrame([(f"k{i}", i, word) for i in range(lo, hi)], SCHEMA)


def test_inserts_once_and_counts(spark, rows):
    t = table(spark)
    data = batch(spark, 0, 5).unionByName(spark.createDataFrame([("k1", 9, "late"), (None, 1, "bad"), (None, 2, "bad")], SCHEMA))
    assert t.insert(data, ["n"]) == {"inserted": 5, "skipped": 1, "errors": 2}
    assert t.insert(data, ["n"]) == {"inserted": 0, "skipped": 6, "errors": 2} and t.snapshot().version == 1
    assert t.insert(batch(spark, 3, 9, "y"), ["n"]) == {"inserted": 4, "skipped": 2, "errors": 0}
    assert rows(t.read()) == sorted([(f"k{i}", i, "x" if i < 5 else "y") for i in range(9)], key=repr)


def test_interleaved_writers_insert_a_key_once(spark, rows):
    t = table(spark)
    first, second, third = (t.prepare(batch(spark, lo, hi, w), ["n"]) for lo, hi, w in ((0, 60, "a"), (30, 90, "b"), (10, 20, "c")))
    assert second.commit() == {"inserted": 60, "skipped": 0, "errors": 0}
    before = t.read()
    assert first.commit() == {"inserted": 30, "skipped": 30, "errors": 0}
    assert third.commit() == {"inserted": 0, "skipped": 10, "errors": 0}
    got = rows(t.read())
    assert [r[0] for r in got] == sorted({f"k{i}" for i in range(90)}, key=lambda k: repr((k,)))
    assert {r[1]: r[2] for r in got} == {i: "a" if i < 30 else "b" for i in range(90)}
    assert before.count() == 60  # a reader keeps its commit


def test_writers_in_threads(spark):
    t, done = table(spark), []
    work = [threading.Thread(target=lambda lo=lo: done.append(KeyedTable(spark, t.path, ["k"], 8).insert(batch(spark, lo, lo + 40), ["n"]))) for lo in (0, 20, 40)]
    [w.start() for w in work]
    [w.join() for w in work]
    assert sum(d["inserted"] for d in done) == 80 == t.read().count() == t.read().select("k").distinct().count()


def test_only_touched_buckets_are_read(spark):
    t = table(spark, 32)
    t.insert(batch(spark, 0, 500), ["n"])
    pending = t.prepare(batch(spark, 700, 702), ["n"])
    assert 1 <= len(pending.touched) <= 2
    files = t.read(buckets=pending.touched).inputFiles()
    plan = t.read(buckets=pending.touched).select("k")._jdf.queryExecution().executedPlan().toString()
    assert len(t.read().inputFiles()) >= 32 and "PartitionFilters" in plan and "_bucket" in plan and "ReadSchema: struct<k:string>" in plan
    assert files
    read = t.read(buckets=pending.touched).select(F.col("_metadata.file_path")).distinct().count()
    assert read < 8


def test_compaction_keeps_what_comes_meanwhile(spark, rows):
    t = table(spark)
    for lo in (0, 10, 20):
        t.insert(batch(spark, lo, lo + 10), ["n"])
    pending = t.prepare(batch(spark, 25, 40, "new"), ["n"])
    before = rows(t.read())
    assert t.compact() == 4 and len(t.snapshot().batches) == 1 and rows(t.read()) == before
    assert pending.commit() == {"inserted": 10, "skipped": 5, "errors": 0} and t.read().count() == 40
    assert t.compact() == 6 and t.compact() == 6 and t.read().count() == 40


def test_empty_batches_other_columns_and_keys(spark, rows):
    t = table(spark)
    assert t.insert(batch(spark, 0, 0), ["n"]) == {"inserted": 0, "skipped": 0, "errors": 0} and t.snapshot().version == 0
    with pytest.raises(ValueError, match="no commit"):
        t.read()
    with pytest.raises(ValueError, match="needs a key"):
        KeyedTable(spark, fresh_dir(spark, "keyed")).prepare(batch(spark, 0, 1), ["n"])
    t.insert(batch(spark, 0, 1), ["n"])
    other = spark.createDataFrame([("z", 5, 1), ("k0", 6, 2)], "k string, n long, _bucket int").withColumn("_batch", F.lit("b"))
    assert t.insert(other, ["n"]) == {"inserted": 1, "skipped": 1, "errors": 0}
    assert rows(t.read()) == [("k0", 0, "x"), ("z", 5, None)] and t.read().columns == ["k", "n", "word"]
    assert KeyedTable(spark, t.path).read().count() == 2  # the key is the table's


def test_two_registrations_both_count(spark):
    def row(version, at):
        return spark.createDataFrame([("cnn", version, 0.5, at)], "model_type string, version string, accuracy double, created_at int")

    t = KeyedTable(spark, fresh_dir(spark, "keyed"), ["model_type", "version"], 1)
    empty = row("v", 0).withColumn("is_active", F.lit(False)).limit(0)
    calls = []

    def change(rows):
        calls.append(1)
        if len(calls) == 1:  # someone else registers while we do
            KeyedTable(spark, t.path, t.new.key, 1).replace(lambda r: register_models(r, row("v1", 1)), empty)
        return register_models(rows, row("v2", 2))

    assert t.replace(change, empty) == 2 and len(calls) == 2
    assert {r.version: r.is_active for r in t.read().collect()} == {"v1": False, "v2": True}
