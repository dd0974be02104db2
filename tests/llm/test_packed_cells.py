"""Cells of operator 12: what stands beside the shingles is small, as their number grows with the ranges."""

import numpy as np

from lodestone.llm.prefix_join import cells


def _texts(count, words=400):
    random = np.random.default_rng(3)
    return [" ".join(map(str, random.integers(0, 1 << 40, words).tolist())) for _ in range(count)]


def test_cells_of_many_ranges_stay_small(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(_texts(40))], "doc_id long, text string")
    rows = cells(docs, 5, 10).collect()
    made = sum(len(r["sets"]) // 8 for r in rows)
    beside = sum(len(r["sets"]) + len(r["sizes"]) + len(r["lengths"]) for r in rows)
    assert sum(len(r["keys"]) // 6 for r in rows) == 40 * 396
    assert beside <= 12 * made + 2 * len(rows)
