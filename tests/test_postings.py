"""The stored inverted index against the scan it replaces, its pruning, and top-k for many queries."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lodestone.operators import postings, topk
from lodestone.operators.lexical import bm25_topk
from lodestone.operators.postings import ShardSearch, build_postings, query_postings, saturation, search_postings
from lodestone.operators.vector_search import vector_topk
from lodestone.session import fresh_dir

IDS = ["doc_id", "chunk_index"]


def corpus(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    words = np.array([f"t{i}" for i in range(300)])
    weights = 1 / np.arange(1, 301)
    rows = [(i // 3, i % 3, " ".join(rng.choice(words, int(rng.integers(1, 60)), p=weights / weights.sum()))) for i in range(n)]
    rows += [(9000, 0, ""), (9001, 0, None), (9002, 0, "t1 " * 500), (9003, 0, "t299"), (9004, 0, "t299")]
    return spark.createDataFrame(rows, "doc_id long, chunk_index int, chunk_text string").repartition(5)


def asked(spark):
    rows = [(1, "t0 t7 t120"), (2, "t299"), (3, "unseen words"), (4, ""), (5, None), (6, "t1 t1 t2 t3 t250 t251"), (7, " ".join(f"t{i}" for i in range(0, 300, 3)))]
    return spark.createDataFrame(rows, "query_id long, query string")


def rows_of(df):
    return sorted((r["query_id"], r["rank"], r["doc_id"], r["chunk_index"], round(r["bm25"], 5)) for r in df.collect())


def test_stored_index_gives_the_ranking_of_the_scan(spark, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK", 8)
    monkeypatch.setattr(postings, "SHARD_CHUNKS", 150)
    chunks = corpus(spark, 1500)
    path = build_postings(chunks, fresh_dir(spark, "postings"), IDS, buckets=16)
    for k in (1, 10):
        assert rows_of(search_postings(spark, path, asked(spark), IDS, k)) == rows_of(bm25_topk(chunks, asked(spark), IDS, k))
    monkeypatch.setattr(topk, "MAX_BLOCK_QUERIES", 2)  # several blocks of queries
    assert rows_of(search_postings(spark, path, asked(spark), IDS, 4)) == rows_of(bm25_topk(chunks, asked(spark), IDS, 4))


def test_search_reads_only_the_buckets_of_the_terms(spark):
    path = build_postings(corpus(spark, 300), fresh_dir(spark, "postings"), IDS, buckets=16)
    terms = spark.createDataFrame([("t5",), ("t17",)], "term string")
    wanted = {postings.bucket_of(t, 16) for t in ("t5", "t17")}
    blocks = query_postings(spark, path, terms)
    assert {r["bucket"] for r in blocks.select("bucket").distinct().collect()} <= wanted
    assert {r["term"] for r in blocks.collect()} == {"t5", "t17"}
    assert "chunk_text" not in blocks.columns
    scans = [line for line in blocks._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line]
    assert any("bucket" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)


def test_no_chunks_and_no_queries(spark):
    empty = build_postings(corpus(spark, 30).filter("false"), fresh_dir(spark, "postings"), IDS)
    assert search_postings(spark, empty, asked(spark), IDS, 3).count() == 0
    some = build_postings(corpus(spark, 30), fresh_dir(spark, "postings"), IDS)
    assert search_postings(spark, some, asked(spark).filter("false"), IDS, 3).count() == 0


def shard(rng, chunks, terms):
    """Blocks of 8 postings; term 0 is in every chunk."""
    out = {c: [] for c in ("term", "first_doc", "last_doc", "max_tf", "min_len", "docs", "tfs", "lens")}
    length = rng.integers(5, 400, chunks)
    for t in range(terms):
        docs = np.flatnonzero(rng.random(chunks) < (1 if t == 0 else 0.6 / t))
        tfs = rng.geometric(0.4, len(docs))
        for a in range(0, len(docs), 8):
            d, f = docs[a : a + 8], tfs[a : a + 8]
            for c, v in zip(out, (f"t{t}", d[0], d[-1], f.max(), length[d].min(), d.tolist(), f.tolist(), length[d].tolist())):
                out[c].append(v)
    return pa.table(out)


def test_pruning_skips_blocks_and_loses_nothing():
    rng = np.random.default_rng(2)
    table = shard(rng, 4000, 40)
    search = ShardSearch(table, 180.0, 1.5, 0.75)
    rows = table.to_pylist()
    for trial in range(30):
        terms = [f"t{t}" for t in rng.choice(40, 5, replace=False)] + ["t0"]
        weights = [0.01 if t == "t0" else float(rng.random() * 5 + 0.5) for t in terms]
        scores = np.zeros(4000)
        for r in rows:
            for t, w in zip(terms, weights):
                if t == r["term"]:
                    scores[r["docs"]] += w * saturation(np.array(r["tfs"]), np.array(r["lens"]), 180.0, 1.5, 0.75)
        scores = np.round(scores, 6)
        want = np.lexsort((np.arange(4000), -scores))[:10]
        [(_, docs, got)] = search.each(pa.table({"terms": [terms], "weights": [weights]}), 10)
        assert docs.tolist() == want.tolist() and np.allclose(got, scores[want], atol=1e-6)
    assert search.skipped > search.opened  # the common term's blocks are opened for candidates only


def test_many_queries_go_in_blocks_over_items_in_place(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(700)] + [(800 + i, [1.0] * 8) for i in range(9)] + [(900, [0.0] * 8)]
    items = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    queries = items.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    once = sorted(map(tuple, vector_topk(items, queries, ["vec_id"], 4).collect()))
    unit = np.array([v for _, v in rows])
    unit = unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-300)
    cosine, ids = np.round(unit @ unit.T, 6), np.array([i for i, _ in rows])
    want = sorted((int(ids[q]), int(ids[j]), r + 1) for q in range(len(rows)) for r, j in enumerate(np.lexsort((ids, -cosine[q]))[:4]))
    assert sorted((r[0], r[1], r[3]) for r in once) == want
    monkeypatch.setattr(topk, "MAX_BLOCK_QUERIES", 100)
    found = vector_topk(items, queries, ["vec_id"], 4)
    assert "FlatMapCoGroups" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == once
