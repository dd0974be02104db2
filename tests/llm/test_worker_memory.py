"""What a Python worker holds: bounded by slices, and nothing that another operator left."""

import sys
import tracemalloc

import numpy as np
import pyarrow as pa

from lodestone.llm.common import worker_memory
from lodestone.llm.mixing_lm import _units
from lodestone.llm.words import BLANKS, each_slice, hash_spans


def _texts(count, words=400):
    random = np.random.default_rng(3)
    return [" ".join(map(str, random.integers(0, 1 << 40, words).tolist())) for _ in range(count)]


def _peak(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_words_of_a_batch_take_bounded_memory():
    texts = pa.array(_texts(800))  # 4 MB
    assert _peak(lambda: [None for _ in each_slice(texts, BLANKS, lower=True)]) < 60


def test_units_of_a_batch_take_bounded_memory():
    texts = pa.array(_texts(800))
    assert _peak(lambda: [None for _ in _units(texts)]) < 60


def test_hashes_of_many_spans_are_those_of_each():
    data = np.frombuffer(" ".join(_texts(300)).encode(), np.uint8)
    starts = np.arange(0, len(data) - 20, 7)
    many = hash_spans(data, starts, starts + 11)
    some = hash_spans(data, starts[-5:], starts[-5:] + 11)
    assert all((m[-5:] == s).all() and len(m) == len(starts) for m, s in zip(many, some))


def test_words_free_what_another_operator_left():
    worker_memory("test:left", lambda: [0])
    list(each_slice(pa.array(["a b"]), BLANKS, lower=True))
    assert not sys.__dict__["_worker_memory"]
