"""The stored cell index against brute force, what it reads, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lodestone.operators import cell_index, topk
from lodestone.operators.vector_search import recall_at_k, vector_topk
from lodestone.session import fresh_dir


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(11)
    middles = rng.normal(size=(12, 8))
    rows = [(i, [float(x) for x in middles[i % 12 if i % 3 else 0] + 0.3 * rng.normal(size=8)], "x") for i in range(900)]  # a third near one middle
    rows += [(5000, None, "x"), (5001, [1.0] * 7 + [None], "x"), (5002, [float("nan")] * 8, "x"), (5003, [float("inf")] * 8, "x"), (5004, [0.0] * 8, "x"), (3, rows[3][1], "x")]
    return spark.createDataFrame(rows, "item long, embedding array<double>, cell string").repartition(6)


@pytest.fixture(scope="module")
def stored(spark, clustered):
    return cell_index.build_cells(clustered, fresh_dir(spark, "cells-test"), ["item"])


@pytest.fixture(scope="module")
def asked(clustered):
    return clustered.filter("item % 10 = 0 OR item > 4999").select(F.col("item").alias("query_id"), F.col("embedding").alias("query_vector"))


def fine(df):
    return df.filter("item < 5000 OR item = 5004")


def brute(clustered, asked, k):
    unit = lambda v: np.array(v) / max(np.linalg.norm(v), 1e-300)
    items = [(r["item"], unit(r["embedding"])) for r in fine(clustered).collect()]
    out = []
    for q in asked.filter("query_id < 5000 OR query_id = 5004").collect():
        best = sorted((-round(float(unit(q["query_vector"]) @ v), 6), i) for i, v in items)[:k]
        out += [(q["query_id"], i, pytest.approx(-s, abs=2e-6), r + 1) for r, (s, i) in enumerate(best)]
    return sorted(out, key=lambda r: (r[0], r[3]))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[3]))


def test_every_row_is_indexed_once_and_cells_follow_the_count(spark, clustered, stored):
    items = spark.read.parquet(f"{stored}/items")
    assert sorted(r["item"] for r in items.collect()) == sorted(r["item"] for r in fine(clustered).collect())
    assert spark.read.parquet(f"{stored}/centres").count() == cell_index.cell_count(902) == 30
    assert [cell_index.cell_count(n) for n in (0, 1, 10_000, 10**12)] == [1, 1, 100, cell_index.MAX_CELLS]


def test_all_cells_are_exact(spark, clustered, stored, asked, monkeypatch):
    want = brute(clustered, asked, 4)
    assert rows_of(cell_index.search_cells(spark, stored, asked, ["item"], 4, 999)) == want
    monkeypatch.setattr(topk, "MAX_BLOCK_QUERIES", 17)
    monkeypatch.setattr(topk, "CELLS_PER_STEP", 64)
    assert rows_of(cell_index.search_cells(spark, stored, asked, ["item"], 4, 999)) == want


def test_some_cells_find_most_and_are_exact_within(spark, clustered, stored, asked):
    good = asked.filter("query_id < 5000")
    found = cell_index.search_cells(spark, stored, good, ["item"], 5, 6)
    exact = vector_topk(fine(clustered), good, ["item"], 5)
    assert recall_at_k(found.dropDuplicates(["query_id", "item"]), exact, ["item"]).first()[0] >= 0.9
    cells = {r["query_id"]: set(r["cells"]) for r in cell_index.probes(spark, stored, good, 6).collect()}
    assert all(len(c) == 6 for c in cells.values())
    where = {r["item"]: r["cell"] for r in spark.read.parquet(f"{stored}/items").collect()}
    assert all(where[r["item"]] in cells[r["query_id"]] for r in found.collect())


def test_probes_follow_the_recall_asked_for(spark, clustered, stored, asked):
    good = asked.filter("query_id < 5000 AND query_id <> 3")
    exact = rows_of(cell_index.search_cells(spark, stored, good, ["item"], 3, 999))
    few, most, every = (cell_index.probes_needed(spark, stored, good, ["item"], 3, target) for target in (0.5, 0.9, 1.0))
    assert 1 <= few <= most <= every <= 30
    assert rows_of(cell_index.search_cells(spark, stored, good, ["item"], 3, every)) == exact
    found = {(q, i) for q, i, *_ in rows_of(cell_index.search_cells(spark, stored, good, ["item"], 3, most))}
    assert len(found & {(q, i) for q, i, *_ in exact}) >= 0.9 * len({(q, i) for q, i, *_ in exact})
    assert cell_index.probes_needed(spark, stored, good.limit(0), ["item"], 3) == 1


def test_only_probed_partitions_are_read(spark, stored, asked):
    one = asked.filter("query_id = 10")
    cells = cell_index.probes(spark, stored, one, 2).first()["cells"]
    rows = cell_index.read_cells(spark, stored, cells)
    files = {r[0] for r in rows.select(F.input_file_name()).distinct().collect()}
    assert files and all(any(f"/cell={c}/" in f for c in cells) for f in files)


def test_no_rows_no_queries(spark, clustered, stored, asked):
    empty = cell_index.build_cells(clustered.limit(0), fresh_dir(spark, "cells-test"), ["item"])
    assert cell_index.search_cells(spark, empty, asked, ["item"], 3, 2).count() == 0
    assert cell_index.search_cells(spark, stored, asked.limit(0), ["item"], 3, 2).count() == 0


def test_queries_are_the_rows_divisible_by_20(spark, tmp_path):
    """F8, F11: what goes through the driver is the query set, not the table; every row is still searched."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)], i % 4) for i in range(240)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = entry.queries()["vector_stored_cells"](spark, str(tmp_path)).collect()
    assert {r.query_id for r in found} == set(range(0, 240, 20)) and {r.vec_id for r in found if r.vec_id % 20}
    assert entry.queries()["stored_cells_recall"](spark, str(tmp_path)).first()["recall"] >= 0.9


def test_probes_and_recall_follow_every_row(spark, tmp_path, monkeypatch):
    """of more than 512 queries the one that needs most counts, and the recall is that of all rows."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=5)], 0) for i in range(1500)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    items = spark.read.parquet(f"{tmp_path}/embeddings.parquet")
    path = cell_index.build_cells(items, fresh_dir(spark, "cells-test"), ["vec_id"])
    every = items.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    centres = np.array([r["centre"] for r in spark.read.parquet(f"{path}/centres").orderBy("cell").collect()])
    stored = spark.read.parquet(f"{path}/items").orderBy("vec_id").collect()
    unit = np.array([r["embedding"] for r in stored], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    best = np.argsort(-np.round(unit @ unit.T, 6), axis=1, kind="stable")[:, :5]
    place = np.argsort(np.argsort((centres**2).sum(1)[None, :] - 2 * unit @ centres.T, axis=1, kind="stable"), axis=1) + 1
    needed = np.sort([place[q, stored[i]["cell"]] for q in range(1500) for i in best[q]])
    for target in (0.95, 0.99, 1.0):
        assert cell_index.probes_needed(spark, path, every, ["vec_id"], 5, target) == needed[int(np.ceil(target * len(needed))) - 1]
    seen, plain = [], recall_at_k
    monkeypatch.setattr("lodestone.operators.vector_search.recall_at_k", lambda found, exact, ids: seen.append({r[0] for r in exact.select("query_id").collect()}) or plain(found, exact, ids))
    assert entry.queries()["stored_cells_recall"](spark, str(tmp_path)).first()["recall"] >= 0.95
    assert seen == [set(range(1500))]


def test_centres_are_fitted_on_all_rows(spark):
    """a converged centre is the mean of its cell, of every row in it."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in (3 * (i % 2), 3 * (1 - i % 2), 0) + rng.normal(size=3)]) for i in range(2100)]
    path = cell_index.build_cells(spark.createDataFrame(rows, "item long, embedding array<double>"), fresh_dir(spark, "cells-test"), ["item"], cells=2)
    stored = spark.read.parquet(f"{path}/items").collect()
    for r in spark.read.parquet(f"{path}/centres").collect():
        own = np.array([s["embedding"] for s in stored if s["cell"] == r["cell"]])
        assert np.allclose((own / np.linalg.norm(own, axis=1, keepdims=True)).mean(0), r["centre"], atol=1e-3)


def test_probes_of_repeated_and_null_query_ids(spark, stored, clustered):
    rows = [r for r in clustered.filter("item IN (10, 20, 30)").collect()]
    asked = spark.createDataFrame([(1, rows[0]["embedding"]), (1, rows[1]["embedding"]), (None, rows[2]["embedding"])], "query_id long, query_vector array<double>")
    every = cell_index.probes_needed(spark, stored, asked, ["item"], 3, 1.0)
    exact = rows_of(cell_index.search_cells(spark, stored, asked.filter("query_id = 1"), ["item"], 3, 999))
    assert rows_of(cell_index.search_cells(spark, stored, asked.filter("query_id = 1"), ["item"], 3, every)) == exact
