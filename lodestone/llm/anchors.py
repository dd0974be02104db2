"""Operator 3: substring dedup by fixed-block anchors.

Every document gives its non-overlapping blocks of half a window as references.
Any window holds at least one whole block of each document it occurs in, so
every rolling run of block length is probed, and a document needs a closer look
only around runs that another document shares.  There the hits are extended to
all windows that hold them; a window goes if its words also start in a document
with a smaller doc_id, and windows in line make the maximal repeats.

Only runs that may be a block leave the tasks: a bit filter of fixed size, made
from all blocks, is sent to them.  At any size it only lets through too much.
Of these runs a window needs one: the one of the least hash.  What the filter
lets through depends on a run's words alone, so documents that share a window
choose the same run of it.
Documents with the same words throughout are settled by one digest each.
Texts are only shuffled if their document may have a place to look at: a bit
filter of doc_ids of fixed size is sent to them, too.

Cases: a null text has no words; a text shorter than a window loses nothing; a
null doc_id is neither smaller nor larger, so it loses and takes nothing; rows
with equal doc_ids are taken to be repeated rows of one document; a repeat
within one document is no reason to remove; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.unions import union_all
from lodestone.llm.common import bounded_batches, id_and_text, ranges
from lodestone.llm.id_filter import id_filter, split_rows
from lodestone.llm.words import BLANKS, Words, each_slice, mix, rolling
from lodestone.session import materialise

WINDOW = 50
BLOCK = WINDOW // 2
FILTER_BITS = 27  # of the filter's size; 16 MB
CHUNK_BITS = 15  # a chunk of the filter is 4 KB, as bitmap_or_agg wants it

SEEN = "doc_id long, n_words long, s1 long, s2 long, sha256 string, chunk int, bits binary"
HITS = "run long, doc_id long, pos int"
WINDOWS = "w1 long, w2 long, doc_id long, pos int"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _joined(words: Words, keep: np.ndarray | None = None) -> list[bytes]:
    """Each row's (kept) words, joined by one space."""
    starts, ends, counts = words.starts, words.ends, words.counts
    if keep is not None:
        starts, ends = starts[keep], ends[keep]
        counts = np.add.reduceat(np.append(keep, False).astype(np.int64), words.first[:-1]) * (counts > 0) if len(counts) else counts
    sizes = ends - starts + 1
    data = np.append(words.data, np.uint8(32))[ranges(starts, sizes)]
    stops = np.cumsum(sizes)
    data[stops - 1] = 32
    raw, bound = memoryview(data.tobytes()), np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum(counts)])]
    return [bytes(raw[b : max(b, e - 1)]) for b, e in zip(bound[:-1].tolist(), bound[1:].tolist())]


def _filter_places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64), (h & mask).astype(np.int64)


def _runs(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, word, place in the row) of every run of block length in rows that hold a window."""
    h = rolling(words.h1, BLOCK)
    ok = (words.room()[: len(h)] >= BLOCK) & np.repeat(words.counts >= WINDOW, words.counts)[: len(h)]
    at = np.flatnonzero(ok)
    return h[at], at, at - np.repeat(words.first[:-1], words.counts)[at]


def _look(docs: DataFrame) -> DataFrame:
    """Per document its size and digests; per task the filter's chunks with the task's blocks."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        names = [c.split()[0] for c in SEEN.split(", ")]
        for batch in batches:
            for words in each_slice(batch["text"], BLANKS, lower=False):
                h, _, place = _runs(words)
                for where in _filter_places(h[place % BLOCK == 0]):
                    np.bitwise_or.at(bits, where >> 3, (1 << (where & 7)).astype(np.uint8))
                lo, hi = words.rows
                n = words.counts
                place = np.arange(len(words.h1)) - np.repeat(words.first[:-1], n)
                salt = mix(place.astype(np.uint64) + np.uint64(1))
                sums = [np.add.reduceat(np.append(mix(h ^ salt), np.uint64(0)), words.first[:-1]) * (n > 0) for h in (words.h1, words.h2)]
                sha = pa.array([hashlib.sha256(x).hexdigest() for x in _joined(words)], pa.string())
                blank = [pa.nulls(hi - lo, pa.int32()), pa.nulls(hi - lo, pa.binary())]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), pa.array(n), *map(_signed, sums), sha, *blank], names)
        size = 1 << (CHUNK_BITS - 3)
        used = np.flatnonzero(bits.reshape(-1, size).any(axis=1))
        for some in np.array_split(used, max(1, len(used) // 256)):
            if len(some):
                blank = [pa.nulls(len(some), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())]
                chunks = pa.array([bits[c * size : (c + 1) * size].tobytes() for c in some], pa.binary())
                yield pa.RecordBatch.from_arrays([*blank, pa.array(some.astype(np.int32)), chunks], names)

    return docs.mapInArrow(look, SEEN)


def _filter(chunks: DataFrame) -> bytes:
    """The filter, 16 MB at any input size."""
    size = 1 << (CHUNK_BITS - 3)
    out = bytearray(1 << (FILTER_BITS - 3))
    for row in chunks.groupBy("chunk").agg(F.expr("bitmap_or_agg(bits)").alias("bits")).toLocalIterator():
        out[row["chunk"] * size : (row["chunk"] + 1) * size] = row["bits"]
    return bytes(out)


def _least(words: Words, h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of runs (hash, word), those with the least hash of any window that holds them."""
    most, width = np.uint64(np.iinfo(np.uint64).max), WINDOW - BLOCK + 1  # runs in a window

    def slid(x: np.ndarray, best) -> np.ndarray:
        size = 1
        while 2 * size <= width:
            x, size = best(x[:-size], x[size:]), 2 * size
        return best(x[: len(x) - (width - size)], x[width - size :])

    value = np.full(len(words.h1) + width - 1, most)
    value[at] = h
    least = np.where(words.room() >= WINDOW, slid(value, np.minimum), np.uint64(0))
    return slid(np.concatenate([np.zeros(width - 1, np.uint64), least]), np.maximum)[at] == h


def _probe(docs: DataFrame, known: bytes) -> DataFrame:
    """Every run that may be some document's block and is the least such run of a window."""
    held = docs.sparkSession.sparkContext.broadcast(known)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, np.uint8)
        for batch in batches:
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            for words in each_slice(batch["text"], BLANKS, lower=False):
                h, at, place = _runs(words)
                hit = np.ones(len(h), bool)
                for where in _filter_places(h):
                    hit &= (bits[where >> 3] >> (where & 7).astype(np.uint8) & 1).astype(bool)
                hit = np.flatnonzero(hit)
                hit = hit[_least(words, h[hit], at[hit])]
                row = words.rows[0] + words.row_of()[at[hit]]
                yield pa.RecordBatch.from_arrays([_signed(h[hit]), pa.array(ids[row].astype(np.int64)), pa.array(place[hit].astype(np.int32))], ["run", "doc_id", "pos"])

    return docs.mapInArrow(probe, HITS)


def _windows(near: DataFrame) -> DataFrame:
    """The windows that hold a hit, of (doc_id, text, pos)."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hits = batch["doc_id"].to_numpy(zero_copy_only=False), batch["pos"]
            for words in each_slice(batch["text"], BLANKS, lower=False):
                both = [rolling(h, WINDOW, k) for k, h in enumerate((words.h1, words.h2))]
                lo, hi = words.rows
                some = hits.slice(lo, hi - lo)
                many = np.asarray([len(x) for x in some])
                pos = some.flatten().to_numpy().astype(np.int64)
                row = np.repeat(np.arange(hi - lo), many)
                edge = np.zeros(len(words.h1) + 1, np.int64)
                np.add.at(edge, words.first[row] + np.maximum(0, pos - (WINDOW - BLOCK)), 1)
                np.add.at(edge, words.first[row] + pos + 1, -1)
                at = np.flatnonzero((np.cumsum(edge)[:-1] > 0) & (words.room() >= WINDOW))
                doc = words.row_of()[at]
                yield pa.RecordBatch.from_arrays(
                    [_signed(both[0][at]), _signed(both[1][at]), pa.array(ids[lo + doc].astype(np.int64)), pa.array((at - words.first[doc]).astype(np.int32))],
                    ["w1", "w2", "doc_id", "pos"],
                )

    return near.select("doc_id", "text", "pos").mapInArrow(windows, WINDOWS)


def _shared(rows: DataFrame, *key: str) -> DataFrame:
    """Keys of more than one document, with the smallest; combined before the shuffle."""
    return rows.groupBy(*key).agg(F.min("doc_id").alias("smallest"), F.max("doc_id").alias("largest")).filter("smallest < largest").drop("largest")


class Repeats:
    """What is repeated where.  ``all``: every document; ``cut``: those that lose some words but aren't copies."""

    def __init__(self, docs: DataFrame):
        bounded_batches(docs.sparkSession)
        texts = id_and_text(docs)
        seen = materialise(_look(texts), "anchors-seen")
        everyone = seen.filter("chunk IS NULL").drop("chunk", "bits")
        copies = _shared(everyone.filter(f"n_words >= {WINDOW}"), "n_words", "s1", "s2")
        marked = everyone.join(copies, ["n_words", "s1", "s2"], "left")
        # a copy: every window of it starts in the smallest document of its class
        self.all = materialise(marked.select("doc_id", "n_words", "sha256", F.coalesce(F.col("doc_id") > F.col("smallest"), F.lit(False)).alias("copy")), "anchors-all")
        known = _filter(seen.filter("chunk IS NOT NULL"))
        hits = materialise(_probe(texts.filter("doc_id IS NOT NULL"), known), "anchors-hits")
        # Written first, so that Spark deals out both sides of the join anew and can split a run that a third of the rows share.
        runs = materialise(_shared(hits, "run").select("run"), "anchors-runs")
        places = hits.join(runs, "run", "left_semi").groupBy("doc_id").agg(F.collect_set("pos").alias("pos"))
        places = materialise(places.join(self.all.filter("copy").select("doc_id").distinct(), "doc_id", "left_anti"), "anchors-places")
        some, _ = split_rows(texts, id_filter(places, "anchors-ids"))
        self.near = materialise(some.join(places, "doc_id"), "anchors-near")
        windows = materialise(_windows(self.near), "anchors-windows")
        firsts = materialise(_shared(windows, "w1", "w2"), "anchors-firsts")
        again = windows.join(firsts, ["w1", "w2"]).filter("doc_id > smallest")
        starts = again.groupBy("doc_id").agg(F.collect_set("pos").alias("starts"))  # no more than the document's words
        self.cut = self.near.drop("pos").dropDuplicates(["doc_id"]).join(starts, "doc_id")


def _kept(batch: pa.RecordBatch) -> Iterator[tuple[Words, np.ndarray]]:
    """The words of (text, starts) rows, and which of them stay."""
    for words in each_slice(batch["text"], BLANKS, lower=False):
        lo, hi = words.rows
        some = batch["starts"].slice(lo, hi - lo)
        row = np.repeat(np.arange(hi - lo), np.asarray([len(x) for x in some]))
        at = words.first[row] + some.flatten().to_numpy()
        edge = np.zeros(len(words.h1) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WINDOW, -1)
        yield words, np.cumsum(edge)[:-1] == 0


def repeat_report(docs: DataFrame) -> DataFrame:
    """Per document: n_words, n_removed and the SHA-256 of its kept words joined by one space."""
    found = Repeats(docs)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, keep in _kept(batch):
                lo, hi = words.rows
                gone = np.add.reduceat(np.append(~keep, False).astype(np.int64), words.first[:-1])
                sha = [hashlib.sha256(x).hexdigest() for x in _joined(words, keep)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), pa.array(gone), pa.array(sha)], ["doc_id", "gone", "kept"])

    cut = found.cut.mapInArrow(digests, "doc_id long, gone long, kept string")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.all.join(cut, "doc_id", "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(nothing)).otherwise(F.coalesce("kept", "sha256")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated words cut out of their texts.  Texts that lose nothing stay as they are."""
    found = Repeats(docs)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, keep in _kept(batch):
                lo, hi = words.rows
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), pa.array([x.decode() for x in _joined(words, keep)])], ["_id", "_text"])

    copies = found.all.filter("copy").select(F.col("doc_id").alias("_id"), F.lit("").alias("_text")).distinct()
    cut = materialise(found.cut.mapInArrow(texts, "_id long, _text string"), "anchors-cut")
    changed = cut.unionByName(copies)
    some, others = split_rows(docs, id_filter(changed.select("_id"), "anchors-changed", "_id"))
    joined = some.join(changed, some["doc_id"].cast("long") == changed["_id"], "left")
    hit = changed["_id"].isNotNull()
    new = {"text": F.when(hit, changed["_text"]).otherwise(some["text"])}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(hit, F.length(changed["_text"])).otherwise(some["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return union_all(joined.select(*[new[c].alias(c) if c in new else some[c] for c in docs.columns]), others)
