"""Inserts keep the first row of an id; cells are fitted on all items."""

import inspect

from lodestone.operators.vector_search import fit_cells
from lodestone.session import fresh_dir
from lodestone.sources import writers


def test_inserts_keep_the_first_seen(spark):
    rows = [("1", "Z", "first", 9), ("2", "B", "other", 3), ("1", "A", "second", 2), ("1", "M", "third", 1)]
    for insert, key in ((writers.insert_documents, "pmid"), (writers.append_corpus, "id")):
        docs = spark.createDataFrame(rows, f"{key} string, title string, abstract string, at int").coalesce(2)
        for arrival, title in ((None, "Z"), ("at", "M")):
            target = fresh_dir(spark, "first-seen")
            assert insert(spark, docs, target, arrival) == {"inserted": 2, "skipped": 2, "errors": 0}
            stored = spark.read.parquet(target)
            assert {r[key]: r.title for r in stored.collect()} == {"1": title, "2": "B"} and "_arrival" not in stored.columns


def test_cells_are_fitted_on_all_items():
    assert "sample_rows" not in inspect.signature(fit_cells).parameters
