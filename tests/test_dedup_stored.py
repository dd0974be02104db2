"""Duplicates of a stored chunk table, found without moving its texts."""

import pytest
from pyspark.sql import functions as F

from lodestone.operators import dedup
from lodestone.session import fresh_dir


def stored(spark, data, parts=5, text_size=1):
    df = spark.createDataFrame(data, "doc_id string, chunk_index int, chunk_text string").repartition(parts)
    df = df.withColumn("content_hash", F.md5("chunk_text")).withColumn("chunk_text", F.repeat("chunk_text", F.lit(text_size)))
    path = fresh_dir(spark, "stored")
    df.write.parquet(path)
    return spark.read.parquet(path)


# A third of the rows are one text, and one has no text.
DATA = [(f"d{i % 700:03d}", i // 700, "same" if i % 3 == 0 else None if i == 1000 else f"t{i % 997}") for i in range(9000)]


@pytest.mark.parametrize("sent", [1 << 13, 2, 1, 0])
def test_same_survivors_in_any_number_of_groups(spark, rows, monkeypatch, sent):
    monkeypatch.setattr(dedup, "BITMAPS_SENT", sent)
    chunks = stored(spark, DATA)
    got = dedup.dedup_stored(chunks)
    assert got.columns == chunks.columns and rows(got) == rows(dedup.dedup_chunks(chunks))
    assert sum(r["content_hash"] is None for r in got.collect()) == 1


def test_more_rows_than_a_bitmap_holds(spark):
    data = spark.range(100_000).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("chunk_index"), F.md5((F.col("id") % 60_000).cast("string")).alias("content_hash")
    )
    path = fresh_dir(spark, "stored")
    data.coalesce(1).write.parquet(path)
    got = dedup.dedup_stored(spark.read.parquet(path))
    assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == list(range(60_000))


def test_repeated_rows_empty_tables_and_other_columns(spark, rows):
    twice = stored(spark, [("a", 0, "x"), ("a", 0, "x"), ("b", 0, "y")], 3)
    assert rows(dedup.dedup_stored(twice).select("doc_id", "chunk_text")) == [("a", "x"), ("b", "y")]
    assert dedup.dedup_stored(twice.filter("false")).count() == 0
    clashing = twice.withColumns({"_bits": F.lit(1), "_row": F.lit(2), "_file": F.lit(3), "_path": F.lit(4)})
    for some, n in [("true", 2), ("false", 0)]:
        path = fresh_dir(spark, "stored")
        clashing.filter(some).write.parquet(path)
        got = dedup.dedup_stored(spark.read.parquet(path))
        assert got.columns == clashing.columns and got.count() == n


def exchanged(spark, run):
    """Bytes that all stages of ``run`` wrote to shuffles."""
    tracker, group = spark.sparkContext.statusTracker(), fresh_dir(spark, "group")
    spark.sparkContext.setJobGroup(group, "")
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return sum(store.lastStageAttempt(s).shuffleWriteBytes() for s in stages)


def test_shuffled_bytes_do_not_grow_with_the_texts(spark):
    small, large = stored(spark, DATA, text_size=1), stored(spark, DATA, text_size=400)
    few, many = (exchanged(spark, lambda: dedup.dedup_stored(x).write.format("noop").mode("overwrite").save()) for x in (small, large))
    assert 0 < many < 1.05 * few
    whole = exchanged(spark, lambda: dedup.dedup_chunks(large).write.format("noop").mode("overwrite").save())
    assert whole > few
