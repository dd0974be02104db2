"""Operator 10: benchmark decontamination by suffix arrays over the training texts.

A shard is a slice of documents.  Its suffix array holds the word positions in
order of the words that follow, on numbers of the benchmark's words; a position
can only be where a benchmark window begins if every pair of neighbours behind
it is one of the benchmark's, so the others are left out of the array.  Every
benchmark suffix is looked up by two binary searches, which give all its
occurrences in the shard; occurrences in line make the longest verbatim matches.

The benchmark travels to the tasks in blocks of bounded size; a further block
is a further pass over what the last one wrote, and no pass has a shuffle.

Cases: a null text has no words, is never hit and never a window; an item
without words matches nothing; items with equal ids are one item, null ids are
the item ''; equal texts in several items count for each; an empty benchmark
hits nothing; an empty table gives an empty one; other columns are kept by
``remove_contaminated`` and ignored by the others.  Item ids are strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.llm.common import bounded_batches, ranges
from lodestone.llm.words import NOT_ALNUM, Words, each_slice
from lodestone.session import materialise

WINDOW = 13
SEEN = "_found in earlier blocks"  # a column between passes
SHARE = 20  # contaminated: 20 * n_hit >= n_words
BLOCK_BYTES = 16 << 20  # of benchmark texts sent to the tasks at once
REPORT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
MATCH = "doc_id long, item_id string, doc_word long, item_word long, n_words long"


@dataclass
class Suffixes:
    """The benchmark's side: numbered words, known neighbours, and every window as a key."""

    vocabulary: tuple[np.ndarray, np.ndarray]  # ascending h1, and h2
    pairs: np.ndarray  # ascending left * (words + 1) + right
    keys: np.ndarray  # distinct windows: numbers of their words as big-endian bytes, zeros behind
    width: np.ndarray
    use_key: np.ndarray  # each window of an item, by key: its item and place
    use_item: np.ndarray
    use_place: np.ndarray
    use_from: np.ndarray  # first use of each key; one more
    items: list[str]

    @classmethod
    def of(cls, ids: list[str], texts: list[str]) -> Suffixes:
        names = sorted(set(ids))
        number_of = {n: i for i, n in enumerate(names)}
        keys, widths, item, place = [], [], [], []
        slices = list(each_slice(pa.array(texts, pa.string()), NOT_ALNUM, lower=True))
        both = [np.concatenate([getattr(w, h) for w in slices]) if slices else np.zeros(0, np.uint64) for h in ("h1", "h2")]
        h1, at = np.unique(both[0], return_index=True)
        vocabulary = (h1, both[1][at])
        pairs = [np.zeros(0, np.int64)]
        for words in slices:
            number = np.searchsorted(h1, words.h1) + 1
            for row in range(words.rows[1] - words.rows[0]):
                line = number[words.first[row] : words.first[row + 1]]
                width = min(WINDOW, len(line))
                if not width:
                    continue
                pairs.append(line[:-1] * (len(h1) + 1) + line[1:])
                windows = np.zeros((len(line) - width + 1, WINDOW), ">u4")
                windows[:, :width] = np.lib.stride_tricks.sliding_window_view(line, width)
                keys.append(windows)
                widths += [width] * len(windows)
                item += [number_of[ids[words.rows[0] + row]]] * len(windows)
                place += range(len(windows))
        flat = as_keys(np.concatenate(keys)) if keys else np.zeros(0, f"S{4 * WINDOW}")
        distinct, first, which = np.unique(flat, return_index=True, return_inverse=True)
        order = np.argsort(which, kind="stable")
        return cls(
            vocabulary, np.unique(np.concatenate(pairs)), distinct, np.array(widths, np.int64)[first], which[order],
            np.array(item, np.int64)[order], np.array(place, np.int64)[order], np.searchsorted(which[order], np.arange(len(distinct) + 1)), names,
        )

    def occurrences(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(position, key) of every benchmark window in a shard."""
        none = np.zeros(0, np.int64)
        h1, h2 = self.vocabulary
        if not len(h1) or not len(words.h1):
            return none, none
        at = np.minimum(np.searchsorted(h1, words.h1), len(h1) - 1)
        number = np.where((h1[at] == words.h1) & (h2[at] == words.h2), at + 1, 0)
        n = len(number)
        room = words.room()
        linked = np.zeros(n + 1, bool)  # this word and the next are neighbours in the benchmark
        code = number[:-1] * (len(h1) + 1) + number[1:]
        if len(self.pairs):
            where = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            linked[: n - 1] = (self.pairs[where] == code) & (number[:-1] > 0) & (number[1:] > 0) & (room[:-1] > 1)
        stop = np.where(linked, n, np.arange(n + 1))
        reach = np.where(number > 0, np.minimum.accumulate(stop[::-1])[::-1][:n] - np.arange(n) + 1, 0)
        kept = np.flatnonzero(reach >= self.width.min())
        if not len(kept):
            return none, none
        step = np.arange(WINDOW)
        suffix = number[np.minimum(kept[:, None] + step, n - 1)]
        suffix[step >= reach[kept][:, None]] = 0
        suffix = as_keys(suffix)
        order = np.argsort(suffix, kind="stable")
        array = suffix[order]  # the suffix array, by the words in reach
        lo = np.searchsorted(array, self.keys, side="left")
        top = self.keys.view(">u4").reshape(-1, WINDOW).copy()
        top[step >= self.width[:, None]] = 0xFFFFFFFF
        found = np.searchsorted(array, as_keys(top), side="right") - lo
        return kept[order[ranges(lo, found)]], np.repeat(np.arange(len(self.keys)), found)


def as_keys(numbers: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(numbers.astype(">u4")).view(f"S{4 * WINDOW}").ravel()


def _blocks(benchmark: DataFrame) -> list[Suffixes]:
    """The benchmark in blocks of bounded size, one after another on the driver."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = -(-size // BLOCK_BYTES)
    for k in range(parts):
        some = rows if parts == 1 else rows.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == k)
        got = some.toArrow()
        yield Suffixes.of(got["item"].to_pylist(), got["text"].to_pylist())


def _scan(docs: DataFrame, benchmark: DataFrame, text_col: str, last) -> DataFrame:
    """Collects spans and items of all blocks per row; ``last`` turns a batch and these into the result."""
    spark = docs.sparkSession
    bounded_batches(spark)
    schema, finish = last
    blocks = [Suffixes.of([], [])]
    blocks = list(_blocks(benchmark)) or blocks
    found = T.StructType([*docs.schema, T.StructField(SEEN, T.BinaryType())])
    for k, block in enumerate(blocks):
        held = spark.sparkContext.broadcast(vars(block))
        final = k == len(blocks) - 1

        def scan(batches: Iterator[pa.RecordBatch], held=held, final=final) -> Iterator[pa.RecordBatch]:
            import pickle

            for batch in batches:
                names = batch.schema.names
                before = batch[SEEN].to_pylist() if SEEN in names else [None] * batch.num_rows
                rows = [pickle.loads(x) if x else ([], set(), 0) for x in before]
                _mark(batch[text_col], Suffixes(**held.value), rows)
                plain = batch.select([n for n in names if n != SEEN])
                if final:
                    yield from finish(plain, rows)
                else:
                    yield pa.RecordBatch.from_arrays([*plain.columns, pa.array([pickle.dumps(r) for r in rows], pa.binary())], [*plain.schema.names, SEEN])

        docs = docs.mapInArrow(scan, schema if final else found)
        if not final:
            docs = materialise(docs, "decontaminate")
    return docs


def _mark(texts: pa.Array, block: Suffixes, rows: list) -> None:
    """Adds a block's findings to the rows: hit spans (start, end), items, and the number of words."""
    for words in each_slice(texts, NOT_ALNUM, lower=True):
        position, key = block.occurrences(words)
        for k, n in enumerate(words.counts.tolist()):
            spans, items, _ = rows[words.rows[0] + k]
            rows[words.rows[0] + k] = (spans, items, n)
        if not len(position):
            continue
        n = len(words.h1)
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, position, 1)
        np.add.at(edge, position + block.width[key], -1)
        hit = np.concatenate([[0], (np.cumsum(edge)[:n] > 0).astype(np.int8), [0]])
        row_of = words.row_of()
        begins, ends = np.flatnonzero(np.diff(hit) > 0), np.flatnonzero(np.diff(hit) < 0)
        # spans of neighbouring rows can touch; they are cut where rows meet
        cuts = words.first[1:-1]
        inner = cuts[(np.searchsorted(begins, cuts, side="left") > 0) & (hit[cuts] == 1) & (hit[np.minimum(cuts + 1, n)] == 1)] if len(cuts) else cuts
        begins, ends = np.sort(np.concatenate([begins, inner])), np.sort(np.concatenate([ends, inner]))
        for b, e in zip(begins.tolist(), ends.tolist()):
            if e > b:
                r = int(row_of[b])
                rows[words.rows[0] + r][0].append((b - int(words.first[r]), e - int(words.first[r])))
        uses = block.use_from[key + 1] - block.use_from[key]
        which = block.use_item[ranges(block.use_from[key], uses)]
        pairs = np.unique(np.repeat(row_of[position], uses) * len(block.items) + which)
        for p in pairs.tolist():
            rows[words.rows[0] + p // len(block.items)][1].add(block.items[p % len(block.items)])


def _hit(spans: list[tuple[int, int]]) -> int:
    total, reached = 0, 0
    for b, e in sorted(spans):
        total += max(0, e - max(b, reached))
        reached = max(reached, e)
    return total


def contaminated(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and SHARE * n_hit >= n_words


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 and whether it is contaminated."""

    def finish(batch: pa.RecordBatch, rows: list) -> Iterator[pa.RecordBatch]:
        hits = [_hit(spans) for spans, _, _ in rows]
        columns = [
            batch["doc_id"],
            pa.array([n for _, _, n in rows], pa.int64()),
            pa.array(hits, pa.int64()),
            pa.array([len(items) for _, items, _ in rows], pa.int64()),
            pa.array([hashlib.sha256(",".join(sorted(items)).encode()).hexdigest() for _, items, _ in rows], pa.string()),
            pa.array([contaminated(n, h) for (_, _, n), h in zip(rows, hits)], pa.bool_()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return _scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, "text", (REPORT, finish))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that aren't contaminated, with all their columns."""

    def finish(batch: pa.RecordBatch, rows: list) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array([not contaminated(n, _hit(spans)) for spans, _, n in rows], pa.bool_()))

    return _scan(docs, benchmark, "text", (docs.schema, finish))


def verbatim_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The longest verbatim matches of at least a window and where they are, in words, per block of the benchmark."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for block in _blocks(benchmark):
        held = spark.sparkContext.broadcast(vars(block))

        def match(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            block = Suffixes(**held.value)
            for batch in batches:
                for words in each_slice(batch["text"], NOT_ALNUM, lower=True):
                    position, key = block.occurrences(words)
                    uses = block.use_from[key + 1] - block.use_from[key]
                    use = ranges(block.use_from[key], uses)
                    at, width = np.repeat(position, uses), np.repeat(block.width[key], uses)
                    item, place = block.use_item[use], block.use_place[use]
                    row = words.row_of()[at] if len(at) else at
                    order = np.lexsort((at, at - place, item, row))
                    at, width, item, place, row = (x[order] for x in (at, width, item, place, row))
                    new = np.ones(len(at), bool)
                    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (at[1:] - place[1:] != at[:-1] - place[:-1]) | (at[1:] != at[:-1] + 1)
                    head = np.flatnonzero(new)
                    tail = np.append(head[1:], len(at)) - 1 if len(head) else head
                    yield pa.RecordBatch.from_arrays([
                        batch["doc_id"].take(pa.array(words.rows[0] + row[head])),
                        pa.array([block.items[i] for i in item[head]], pa.string()),
                        pa.array((at - words.first[row] if len(at) else at)[head]),
                        pa.array(place[head]),
                        pa.array(at[tail] + width[tail] - at[head]),
                    ], ["doc_id", "item_id", "doc_word", "item_word", "n_words"])

        found = texts.mapInArrow(match, MATCH)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], MATCH)
