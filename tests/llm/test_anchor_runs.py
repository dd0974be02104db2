"""Of the runs that operator 3's filter lets through, those that windows need."""

import hashlib

import numpy as np

from lodestone.llm.anchors import BLOCK, WINDOW, _filter, _least, _look, _probe, repeat_report
from lodestone.llm.words import Words
from lodestone.session import materialise


def _words(seed, n):
    return [f"w{x}" for x in np.random.default_rng(seed).integers(0, 400, n)]


def _group():
    """One passage, at every distance from a document's blocks."""
    return [" ".join([f"d{k}"] * k + _words(99, 300)) for k in range(BLOCK)]


def test_a_window_gives_the_run_of_least_hash():
    counts = np.array([WINDOW, 200, WINDOW - 1, 70])
    first = np.concatenate([[0], np.cumsum(counts)])
    n = int(first[-1])
    none = np.zeros(0, np.uint8)
    words = Words((0, 4), none, np.arange(n), np.arange(n) + 1, first, np.zeros(n, np.uint64), np.zeros(n, np.uint64))
    rng = np.random.default_rng(1)
    inside = np.flatnonzero(words.room() >= BLOCK)
    for share in (1.0, 0.1, 0.0):
        at = inside[rng.random(len(inside)) < share]
        h = rng.integers(0, 1 << 8, len(at)).astype(np.uint64)  # some are equal
        value, want = dict(zip(at.tolist(), h.tolist())), set()
        for start in np.flatnonzero(words.room() >= WINDOW).tolist():
            held = [p for p in range(start, start + WINDOW - BLOCK + 1) if p in value]
            least = min((value[p] for p in held), default=None)
            want.update(p for p in held if value[p] == least)
        assert set(at[_least(words, h, at)].tolist()) == want


def test_a_group_of_copies_gives_few_runs(spark):
    docs = spark.createDataFrame(list(enumerate(_group())), "doc_id long, text string")
    seen = materialise(_look(docs), "test-seen")
    hits = _probe(docs, _filter(seen.filter("chunk IS NOT NULL"))).count()
    places = BLOCK * (300 - BLOCK + 1)  # each of them is some document's block
    assert 0 < 6 * hits < places


def test_a_group_of_copies_loses_the_passage(spark):
    texts = _group()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in repeat_report(docs).collect():
        kept = texts[0].split() if r.doc_id == 0 else [f"d{r.doc_id}"] * r.doc_id
        assert (r.n_removed, r.kept_sha256) == (300 * (r.doc_id > 0), hashlib.sha256(" ".join(kept).encode()).hexdigest())
