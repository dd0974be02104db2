"""Ingest with the hashes of recent chunks in a state store."""

import time

from lodestone.operators.chunking import chunk
from lodestone.operators.cleaning import clean
from lodestone.operators.dedup import dedup_chunks
from lodestone.plans.tables import as_corpus, table
from lodestone.session import fresh_dir
from lodestone.sources.keyed_table import KeyedTable
from lodestone.streaming.ingest import STATE_STORE, start_stateful_ingest

SF = "/root/testdata/sf0.001"


def setting(spark):
    docs = as_corpus(table(spark, SF, "documents"))
    landed, target, checkpoint = (fresh_dir(spark, x) for x in ("landed", "target", "cp"))

    def run(cp=checkpoint, **more):
        stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(landed)
        query = start_stateful_ingest(spark, stream, target, cp, "recursive_800", **more)
        query.awaitTermination()
        return query

    def land(some):
        some.coalesce(1).write.mode("append").parquet(landed)

    return docs, land, run, lambda: KeyedTable(spark, target).read()


def test_restarts_replays_and_later_copies_insert_nothing_twice(spark):
    docs, land, run, stored = setting(spark)
    before = spark.conf.get(STATE_STORE)
    want = {r.content_hash for r in dedup_chunks(chunk(clean(docs), "recursive_800")).collect()}
    land(docs.filter("id < 100"))
    land(docs.filter("id < 50"))  # a micro-batch of copies
    run()
    land(docs)  # restarted from the checkpoint, with copies and new ones
    query = run()
    got = [r.content_hash for r in stored().collect()]
    assert len(got) == len(set(got)) and set(got) == want and spark.conf.get(STATE_STORE) == before
    state = query.lastProgress["stateOperators"][0]
    assert "rocksdb" in str(state["customMetrics"]).lower() and state["numRowsTotal"] == len(want)
    run(fresh_dir(spark, "cp"))  # without a state all is seen anew; the table knows it
    assert stored().count() == len(want)


def test_state_is_bounded_by_what_is_remembered(spark):
    docs, land, run, stored = setting(spark)
    rows = []
    for lo in (0, 60, 120):
        land(docs.filter(f"id >= {lo} AND id < {lo + 60}"))
        query = run(remember="1 second")
        rows.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(2)
    land(docs.filter("id < 60"))  # forgotten by the state, known to the table
    n = stored().count()
    run(remember="1 second")
    assert rows[-1] < n and stored().count() == n
