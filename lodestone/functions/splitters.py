"""Recursive text splitting, worked out on cut positions.

A piece always begins with the separator it was cut at, so pieces tile the
text and every chunk is one ``text[a:b]`` slice: packing only moves two
positions over a sorted list of cuts and never joins strings.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_AT_ONCE = 4 << 20  # bytes of text that a worker holds as Python strings


def _cuts(text: str, lo: int, hi: int, sep: str) -> list[int]:
    """``lo``, each occurrence of ``sep`` after it, and ``hi``."""
    found = [lo]
    at = text.find(sep, lo, hi)
    while at != -1:
        if at > lo:
            found.append(at)
        at = text.find(sep, at + len(sep), hi)
    found.append(hi)
    return found


def _pack(cuts: Sequence[int], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Slices that take as many whole pieces as fit, each starting far enough
    back to repeat at most ``overlap`` characters of the one before."""
    last = len(cuts) - 1
    start = 0
    while True:
        stop = min(bisect_right(cuts, cuts[start] + size) - 1, last)
        yield cuts[start], cuts[stop]
        if stop == last:
            return
        # Carry a tail, but only as much as leaves room for the next piece.
        start = bisect_left(cuts, max(cuts[stop] - overlap, cuts[stop + 1] - size))


def _spans(text: str, lo: int, hi: int, seps: Sequence[str], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    depth = next((i for i, sep in enumerate(seps) if text.find(sep, lo, hi) != -1), None)
    if depth is None:
        yield lo, hi
        return
    finer = seps[depth + 1 :]
    run: list[int] = []  # cuts of neighbouring pieces that fit
    cuts = _cuts(text, lo, hi, seps[depth])
    for a, b in zip(cuts, cuts[1:]):
        if b - a < size:
            if not run:
                run.append(a)
            run.append(b)
            continue
        if run:
            yield from _pack(run, size, overlap)
            run = []
        if finer:
            yield from _spans(text, a, b, finer, size, overlap)
        else:
            yield a, b
    if run:
        yield from _pack(run, size, overlap)


def split_recursive(text: str | None, size: int, overlap: int, separators: Sequence[str]) -> list[str]:
    """Chunks of at most ``size`` characters unless a piece cannot be cut further."""
    if not text:
        return []
    spans = _spans(text, 0, len(text), separators, size, overlap)
    return [chunk for a, b in spans if (chunk := text[a:b].strip())]


def text_slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of up to ``TEXT_AT_ONCE`` bytes; a longer text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    lo = held = 0
    for hi, size in enumerate(sizes):
        if hi > lo and held + size > TEXT_AT_ONCE:
            yield lo, hi
            lo, held = hi, 0
        held += size
    if lo < len(sizes):
        yield lo, len(sizes)


def split_texts(texts: pa.Array, size: int, overlap: int, separators: Sequence[str]) -> pa.Array:
    """A list of chunks per text."""
    return pa.array([split_recursive(t, size, overlap, separators) for t in texts.to_pylist()], pa.list_(pa.string()))


def recursive_chunks(text: Column, size: int, overlap: int, separators: Sequence[str]) -> Column:
    """``array<string>`` of chunks, in Arrow batches; a bounded part of a batch at a time is Python strings."""

    @F.arrow_udf("array<string>")
    def split(batch: pa.Array) -> pa.Array:
        parts = [split_texts(batch.slice(lo, hi - lo), size, overlap, separators) for lo, hi in text_slices(batch)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    return split(text)
