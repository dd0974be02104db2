"""Words of whole texts as arrays: bounds, two 64-bit hashes, hashes of runs of words.

Words are found on UTF-8 bytes.  All separators are ASCII, so that gives the
words of the character patterns, and a text never becomes a list of strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from lodestone.llm.common import buffers, forget_worker_memory, ranges, spans

SLICE_BYTES = 512 << 10  # of text at once; a byte takes some 50 in between
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of the two hash families


def _bytes_in(*bounds: tuple[int, int]) -> np.ndarray:
    found = np.zeros(256, bool)
    for lo, hi in bounds:
        found[lo : hi + 1] = True
    return found


BLANKS = _bytes_in((0x20, 0x20), (0x09, 0x0D))  # words [^\x20\x09-\x0D]+
NOT_ALNUM = _bytes_in((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))  # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Words:
    rows: tuple[int, int]  # the rows of the column these words are from
    data: np.ndarray  # bytes of these rows
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each row, its first word; one more than rows
    h1: np.ndarray
    h2: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def room(self) -> np.ndarray:
        """For each word, the words from it to the end of its row."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two hashes of the bytes of each span; spans mustn't be empty."""
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in BASES]
    lengths = ends - starts
    if len(starts) > 1 and lengths.sum() > SLICE_BYTES:  # some at a time
        parts = [hash_spans(data, starts[lo:hi], ends[lo:hi]) for lo, hi in spans(np.concatenate([[0], np.cumsum(lengths)]), SLICE_BYTES)]
        return [np.concatenate(p) for p in zip(*parts)]
    where = np.cumsum(lengths) - lengths
    value = data[ranges(starts, lengths)].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(value), dtype=np.int64) - np.repeat(where, lengths)
    return [mix(np.add.reduceat(value * powers(base, int(lengths.max()))[place], where)) for base in BASES]


def each_slice(texts: pa.Array, separators: np.ndarray, lower: bool, size: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of a column, some rows of about ``size`` bytes at a time."""
    forget_worker_memory()
    everything, at = buffers(texts)
    for lo, hi in spans(at, size):
        data = everything[at[lo] : at[hi]]
        data = LOWER[data] if lower else data
        inside = ~separators[data]
        bounds = at[lo : hi + 1] - at[lo]
        edge = np.zeros(len(data) + 1, bool)  # a row begins or ends here
        edge[bounds] = True
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        yield Words((lo, hi), data, starts, ends, np.searchsorted(starts, bounds), *hash_spans(data, starts, ends))


def rolling(h: np.ndarray, width: int, family: int = 0) -> np.ndarray:
    """A hash for each run of ``width`` words; runs over the end of a row are for the caller to leave out."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = BASES[family] ^ 0x5851F42D4C957F2C
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(base, len(h)), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * powers(pow(base, -1, 1 << 64), n))
