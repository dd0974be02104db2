"""Rows that can't have an id stay where they are; all others are joined."""

import numpy as np

from lodestone.llm.anchors import without_repeats
from lodestone.llm.id_filter import id_filter, split_rows
from lodestone.llm.near_dups import without_near_duplicates


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_split_without_a_shuffle(spark, rows):
    wanted = [None, 0, -1, 7, 7, 1 << 62, -(1 << 63), (1 << 63) - 1, *range(1000, 1300)]
    every = [None, None, *sorted({x for x in wanted if x is not None}), *range(20_000, 24_000)]
    docs = spark.createDataFrame([(x, f"text {x}") for x in every], "doc_id long, text string")
    chunks = id_filter(spark.createDataFrame([(x,) for x in wanted], "doc_id long"), "test-ids")
    some, others = split_rows(docs, chunks)
    assert rows(some.union(others)) == rows(docs)
    held = {r.doc_id for r in some.collect()}
    assert {x for x in wanted if x is not None} <= held and None not in held
    assert len(held) < 400
    assert all("Exchange hashpartitioning" not in _plan(x) and some.columns == docs.columns for x in (some, others))
    nothing = id_filter(spark.createDataFrame([], "doc_id long"), "test-no-ids")
    assert rows(split_rows(docs, nothing)[1]) == rows(docs) and split_rows(docs, nothing)[0].isEmpty()


def test_only_texts_that_may_change_are_shuffled(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 120)) for _ in range(60)]
    texts[7] = "before it " + texts[3]  # a passage that is repeated
    texts[9] = texts[4]  # a copy
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[5]), (None, None)], "doc_id long, text string")
    for change, gone, cut in ((without_repeats, set(), {7: "before it", 9: ""}), (without_near_duplicates, {7, 9}, {})):
        found = change(docs)
        want = {k: cut.get(k, t) for k, t in enumerate(texts) if k not in gone}
        got = [(r.doc_id, r.text) for r in found.collect()]
        assert {k: t for k, t in got if k is not None} == want and len(got) == len(want) + 2
        assert {t for k, t in got if k is None} == {texts[5], None}
        assert "Union" in _plan(found)  # the others' side has no shuffle
