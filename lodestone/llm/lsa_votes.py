"""Operator 4: quality by nearest neighbours among labelled latent-semantic vectors.

Features of a whole text: how often each run of three character classes occurs,
and a few measures of its form (size, repetition of words, of neighbours
and of lines, word length), each in soft bins.  Weighted by rarity and reduced by a truncated
singular value decomposition they are the text's vector.  The labelled sample's
vectors travel to the tasks, which take blocks of documents, compute all cosines
with the sample exactly, and let the nearest vote, weighted by similarity.

The sample is bounded (``sample``: the labelled rows with the smallest hash of
doc_id, outside the held-out fold); nothing else is.  Labels, lang, source and
doc_id aren't inputs of a score.

Cases: a null text is empty; a text without features has the share of label 1
as its score, 0.5 without any labels; null labels are ignored, of several labels
of a document the largest counts; a null doc_id is in no fold's training part
and not held out; an empty table gives an empty one.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import bounded_batches, buffers, id_and_text, spans
from lodestone.llm.words import BLANKS, each_slice

FOLDS, HELD_OUT = 5, 0
SAMPLE = 4_000
DIMENSIONS = 48
NEIGHBOURS = 15
CUT = 0.3
CLASSES = 13
FORM_BINS = 12
FORMS = 5
FEATURES = CLASSES**3 + FORM_BINS * FORMS
ROWS = 400

# classes of bytes: blank, line end, lower, upper, digit, beyond ASCII, and the marks that texts use differently
_KIND = np.full(256, 12, np.uint8)
_KIND[[9, 11, 12, 13, 32]] = 0
_KIND[10] = 1
_KIND[97:123] = 2
_KIND[65:91] = 3
_KIND[48:58] = 4
_KIND[128:] = 5
for _k, _marks in enumerate((b".", b",", b"!?", b"|", b"#$%&*", b"'\"-()"), 6):
    _KIND[list(_marks)] = _k


def _soft_bins(value: np.ndarray) -> np.ndarray:
    """A number in [0, 1] shared between the two bins beside it."""
    at = np.clip(value, 0, 1) * (FORM_BINS - 1)
    return np.maximum(0, 1 - np.abs(at[:, None] - np.arange(FORM_BINS)))


def features(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES numbers per text; zeros for an empty one."""
    data, at = buffers(texts)
    n = len(at) - 1
    out = np.zeros((n, FEATURES), np.float32)
    for lo, hi in spans(at, 2 << 20):
        kind = _KIND[data[at[lo] : at[hi]]].astype(np.int64)
        if not len(kind):
            continue
        row = np.repeat(np.arange(hi - lo), np.diff(at[lo : hi + 1]))
        three = (kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:]
        same = row[:-2] == row[2:]
        counts = np.bincount(row[:-2][same] * CLASSES**3 + three[same], minlength=(hi - lo) * CLASSES**3).reshape(hi - lo, -1)
        out[lo:hi, : CLASSES**3] = np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))
    for words in each_slice(texts, BLANKS, lower=True):
        lo, hi = words.rows
        row, many = words.row_of(), words.counts
        size = np.maximum(1, many)
        key = np.unique(words.h1 ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
        distinct = np.bincount(row[key], minlength=hi - lo)
        length = np.bincount(row, weights=words.ends - words.starts, minlength=hi - lo) / size
        again = np.flatnonzero((words.h1[1:] == words.h1[:-1]) & (row[1:] == row[:-1]))
        again = np.bincount(row[again], minlength=hi - lo) / size  # words that repeat their neighbour
        measures = [np.log2(size) / 16, again, distinct / size, length / 16, _repeated_lines(texts.slice(lo, hi - lo))]
        form = np.concatenate([_soft_bins(np.asarray(m)) for m in measures], axis=1) * (many > 0)[:, None]
        out[lo:hi, CLASSES**3 :] = 0.2 * form
    return out


def _repeated_lines(texts: pa.Array) -> list[float]:
    """Of each text's lines, the share that repeat an earlier one."""
    shares = []
    for text in texts.to_pylist():
        lines = (text or "").split("\n")
        shares.append(1 - len(set(lines)) / len(lines))
    return shares


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


class Model:
    """Weights, axes and the labelled sample's vectors; all of bounded size."""

    def __init__(self, x: np.ndarray, labels: np.ndarray):
        self.share = float(labels.mean()) if len(labels) else 0.5
        self.labels = labels.astype(np.float32)
        self.weight = (1 + np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0)))).astype(np.float32) if len(x) else np.ones(FEATURES, np.float32)
        weighted = x * self.weight
        size = np.linalg.norm(weighted, axis=1, keepdims=True)
        weighted = weighted / np.maximum(size, 1e-12)
        values, axes = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
        self.axes = axes[:, ::-1][:, :DIMENSIONS].astype(np.float32)
        self.known = _unit(weighted @ self.axes)

    @staticmethod
    def scores(parts: dict, x: np.ndarray) -> np.ndarray:
        """Exact cosines with every labelled vector, a block of documents at a time."""
        out = np.full(len(x), parts["share"])
        labels, known = parts["labels"], parts["known"]
        k = min(NEIGHBOURS, len(labels))
        if not k:
            return out
        z = _unit((x * parts["weight"]) @ parts["axes"])
        cosine = z @ known.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0) ** 8
        total = weight.sum(axis=1)
        ok = (np.abs(x).sum(axis=1) > 0) & (total > 0)
        out[ok] = (weight * labels[near]).sum(axis=1)[ok] / total[ok]
        return np.clip(out, 0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Learns from at most ``sample`` labelled documents outside the held-out fold."""
    bounded_batches(docs.sparkSession)
    known = labels.filter(F.col(label_col).isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
    known = id_and_text(docs).select("doc_id").distinct().join(known, "doc_id")
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))  # ``sample`` rows of two numbers
    rows = id_and_text(docs).join(chosen, "doc_id").dropDuplicates(["doc_id"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "label", "x"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches), pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("x", pa.binary())])).sort_by("doc_id")
        x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(-1, FEATURES)
        model = vars(Model(x, got["label"].to_numpy()))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # the sample is of bounded size, and so is the task that has all of it; the driver gets the model alone
    measured = rows.select("doc_id", "text", "label").mapInArrow(measure, "doc_id long, label int, x binary")
    got = measured.repartition(1).mapInArrow(learn, "model binary").collect()
    model = Model.__new__(Model)
    vars(model).update(pickle.loads(got[0]["model"]) if got else vars(Model(np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int32))))
    return model


def _score_batches(model: dict, batch: pa.RecordBatch, text_col: str) -> np.ndarray:
    parts = [Model.scores(model, features(batch[text_col].slice(lo, ROWS))) for lo in range(0, batch.num_rows, ROWS)]
    return np.concatenate([np.zeros(0), *parts])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(vars(model))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(_score_batches(held.value, batch, "text").astype(np.float64))], ["doc_id", "score"])

    scored = id_and_text(docs).mapInArrow(judge, "doc_id long, score double")
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The documents that aren't rejected, with all their columns."""
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(vars(model))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_score_batches(held.value, batch, "text") >= cut))

    return docs.mapInArrow(keep, docs.schema)
