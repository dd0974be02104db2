"""Operator 13: hard negatives by angular triangle filtering.

The index holds windows of rows that are near each other: rows are sorted by
label, nearest reference direction, angle to it and id, and cut every
``WINDOW`` rows.  A window stores, for each reference direction, the least and
greatest angle of its rows, and their least and greatest norm.  With an
anchor's own angles the triangle inequality bounds the angle between the anchor
and every row of a window; cosines times norms, widened by more than what
floating point can lose, bound the integer inner products.  Only windows whose
bounds overlap what is wanted are scored, exactly, in integers.

``mine`` runs twice over the index for a block of anchors: once for the best
rows of the anchor's label (its positives), then, with their scores known, for
the rows of other labels whose scores lie in a band below each positive's.
Anchors come in blocks of about ``ANCHORS`` that are sent to the tasks; the
index stays in place.  A task gives k rows per anchor and positive at most.

Cases: rows with a null id, label or vector, or a null, NaN or infinite
component take no part; shorter vectors are filled up with zeros; rows repeated
in full count once, and rows that share an id but not the rest are rows of
their own; no row is a positive or negative of an anchor with its own id;
anchors without positives, and positives with an empty band (all of a negative
score), give no rows; ties go to the smaller id; an empty table gives an empty
one; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.common import arrow_batches
from lodestone.session import fresh_dir, materialise

WINDOW = 256
ANCHORS = 1024  # about so many in a block
LABEL_DIRECTIONS, FIXED_DIRECTIONS = 16, 8
ANGLE_SLACK = 1e-6  # arc cosines of rounded cosines are off by 2e-8 at most
PENDING = 1 << 20

INDEX = "n int, ids binary, labels binary, q binary, low_angle array<double>, high_angle array<double>, low_norm double, high_norm double"
ROWS = "id long, label int, q array<long>"
HITS = "slot long, anchor_id long, positive_id long, positive_score long, id long, score long"


def mining_rows(vectors: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, label, q: array of floor(scale * x)) of the rows that take part."""
    x = F.transform(vector_col, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("int").alias("label"), x.alias("x"))
    rows = rows.filter(fine & F.col("id").isNotNull() & F.col("label").isNotNull())
    return rows.select("id", "label", F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("q"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    many = np.array([len(x) for x in column], np.int64)
    values = column.flatten().to_numpy().astype(np.int64)
    if (many == dims).all():
        return values.reshape(len(many), dims)
    out = np.zeros((len(many), dims), np.int64)
    out[np.repeat(np.arange(len(many)), many), np.arange(len(values)) - np.repeat(np.cumsum(many) - many, many)] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T: in doubles while every sum is below 2^53, else in integers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def norms(q: np.ndarray) -> np.ndarray:
    return np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))


def angles(q: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Of every row to every direction, in radians; a zero vector has any angle, here a right one."""
    size = norms(q)[:, None] * norms(directions)[None, :]
    cosine = np.divide(products(q, directions), size, out=np.zeros((len(q), len(directions))), where=size > 0)
    return np.arccos(np.clip(cosine, -1, 1))


def score_bounds(angle: np.ndarray, norm: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) integer bounds of the scores of anchors (their angles and norms) and rows of windows."""
    near = np.zeros((len(angle), len(low)))
    far = np.full((len(angle), len(low)), math.pi)
    for r in range(angle.shape[1]):  # one direction at a time, so that only anchors x windows are held
        a = angle[:, r, None]
        np.maximum(near, np.maximum(a - high[:, r], low[:, r] - a), out=near)
        np.minimum(far, np.minimum(a + high[:, r], 2 * math.pi - (a + low[:, r])), out=far)
    top, bottom = np.cos(np.clip(near - ANGLE_SLACK, 0, math.pi)), np.cos(np.clip(far + ANGLE_SLACK, 0, math.pi))
    upper = norm[:, None] * np.where(top > 0, most, least) * top
    lower = norm[:, None] * np.where(bottom < 0, most, least) * bottom
    slack = 1 + 1e-9 * norm[:, None] * most
    return np.floor(lower - slack), np.ceil(upper + slack)


def reference_directions(rows: DataFrame, dims: int) -> np.ndarray:
    """Sums of the rows of the most frequent labels, and fixed sign vectors; which ones they are changes no result."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            q, labels = matrix(batch["q"], dims), batch["label"].to_numpy()
            for label in np.unique(labels).tolist():
                mine = q[labels == label]
                held[label] = held.get(label, np.zeros(dims + 1)) + np.concatenate([mine.sum(axis=0, dtype=np.float64), [len(mine)]])
            if len(held) > 10_000 // max(1, dims // 64):
                yield out(held)
                held = {}
        yield out(held)

    def out(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tolist() for v in held.values()], pa.list_(pa.float64()))], ["label", "sums"])

    parts = rows.select("label", "q").mapInArrow(add, "label int, sums array<double>")
    total = F.array(*[F.sum(F.col("sums")[i]) for i in range(dims + 1)])
    best = parts.groupBy("label").agg(total.alias("sums")).orderBy(F.col("sums")[dims].desc(), "label").limit(LABEL_DIRECTIONS).collect()
    signs = np.random.default_rng(13).integers(0, 2, (FIXED_DIRECTIONS, dims)) * 2 - 1
    means = np.array([np.array(r["sums"][:dims]) / max(1.0, r["sums"][dims]) for r in best]).reshape(len(best), dims)
    # whole numbers, so that every task finds the same angle for the same row
    return np.concatenate([np.rint(np.clip(means, -1e6, 1e6) * 16).astype(np.int64), signs])


def build_windows(rows: DataFrame, path: str) -> tuple[int, np.ndarray]:
    """Writes the index of (id, label, q) rows; returns the number of components and the reference directions."""
    spark = rows.sparkSession
    dims = rows.agg(F.max(F.size("q")).alias("d")).first()["d"] or 0
    directions = reference_directions(rows, dims)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angle = angles(matrix(batch["q"], dims), directions)
            ref = angle.argmin(axis=1).astype(np.int32) if angle.size else np.zeros(batch.num_rows, np.int32)
            own = angle[np.arange(len(ref)), ref] if angle.size else np.zeros(len(ref))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], batch["q"], pa.array(ref), pa.array(own)], ["id", "label", "q", "ref", "angle"])

    def window(ids: np.ndarray, labels: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
        angle, norm = angles(q, directions), norms(q)
        values = [[len(ids)], [ids.tobytes()], [labels.tobytes()], [q.tobytes()], [angle.min(axis=0).tolist()], [angle.max(axis=0).tolist()], [norm.min()], [norm.max()]]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["n", "ids", "labels", "q", "low_angle", "high_angle", "low_norm", "high_norm"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, q = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros((0, dims), np.int64)
        for batch in batches:
            ids, labels, q = np.concatenate([ids, batch["id"].to_numpy()]), np.concatenate([labels, batch["label"].to_numpy()]), np.concatenate([q, matrix(batch["q"], dims)])
            new = np.ones(len(ids), bool)  # rows repeated in full are neighbours
            new[1:] = (ids[1:] != ids[:-1]) | (labels[1:] != labels[:-1]) | (q[1:] != q[:-1]).any(axis=1)
            ids, labels, q = ids[new], labels[new], q[new]
            while len(ids) > WINDOW:  # the last row stays, to be held against the next batch
                yield window(ids[:WINDOW], labels[:WINDOW], q[:WINDOW])
                ids, labels, q = ids[WINDOW:], labels[WINDOW:], q[WINDOW:]
        if len(ids):
            yield window(ids, labels, q)

    order = ["label", "ref", "angle", "id"]
    placed = rows.mapInArrow(place, ROWS + ", ref int, angle double").repartitionByRange(*order).sortWithinPartitions(*order, "q")
    with arrow_batches(spark, 4096, 8 << 20):
        placed.select("id", "label", "q").mapInArrow(cut, INDEX).write.parquet(path)
    return dims, directions


class Best:
    """The k best (score, id) of numbered slots, ties to the smaller id; ``bar`` is the k-th best score, once there are k."""

    def __init__(self, slots: int, k: int):
        self.k, self.bar, self.held, self.pending = k, np.full(slots, np.iinfo(np.int64).min), [], 0

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.held.append((slot, score, ids))
        self.pending += len(slot)
        if self.pending > PENDING:
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, score, ids = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*self.held) if self.held else ([], [], [])))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
        kth = place == self.k - 1
        self.bar[slot[kth]] = score[kth]
        some = place < self.k
        self.held, self.pending = [(slot[some], score[some], ids[some])], 0
        return self.held[0]


def _windows(batches: Iterator[pa.RecordBatch], dims: int, angle: np.ndarray, norm: np.ndarray) -> Iterator[tuple]:
    """(ids, labels, q, lower bounds, upper bounds of every anchor) of each window."""
    for batch in batches:
        low, high = (np.array(batch[c].to_pylist(), np.float64).reshape(batch.num_rows, angle.shape[1]) for c in ("low_angle", "high_angle"))
        lower, upper = score_bounds(angle, norm, low, high, batch["low_norm"].to_numpy(), batch["high_norm"].to_numpy())
        for w in range(batch.num_rows):
            ids, labels, q = (np.frombuffer(batch[c][w].as_buffer(), t) for c, t in (("ids", np.int64), ("labels", np.int32), ("q", np.int64)))
            yield ids, labels, q.reshape(len(ids), dims), lower[:, w], upper[:, w]


def mine(spark: SparkSession, path: str, dims: int, directions: np.ndarray, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score over the index at ``path``.

    ``low`` and ``high`` are per cent of the positive's score, both included.
    Runs jobs: two per block of anchors.
    """
    anchors = anchors.select("id", "label", "q").distinct()
    blocks, paths = -(-anchors.count() // ANCHORS), []
    index = spark.read.schema(INDEX).parquet(path)
    for block in range(blocks):
        got = anchors.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()  # about ANCHORS rows of dims numbers
        if not got.num_rows:
            continue
        own_ids, own_labels, q = got["id"].to_numpy(), got["label"].to_numpy(), matrix(got["q"].combine_chunks(), dims)
        sent = spark.sparkContext.broadcast((own_ids, own_labels, q, angles(q, directions), norms(q)))

        def nearest(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own_ids, own_labels, own_q, angle, norm = sent.value
            best = Best(len(own_ids), positives)
            for ids, labels, q, _, upper in _windows(batches, dims, angle, norm):
                need = np.flatnonzero((own_labels >= labels.min()) & (own_labels <= labels.max()) & (upper >= best.bar))
                score = products(own_q[need], q)
                row, at = np.nonzero((labels == own_labels[need, None]) & (ids != own_ids[need, None]) & (score >= best.bar[need, None]))
                best.add(need[row], score[row, at], ids[at])
            slot, score, ids = best.settle()
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(ids), pa.array(score)], ["slot", "id", "score"])

        with arrow_batches(spark, 64, 16 << 20):
            order = W.partitionBy("slot").orderBy(F.desc("score"), "id")
            found = index.mapInArrow(nearest, "slot long, id long, score long")
            found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= positives).toArrow()  # k per anchor of the block
        wanted = np.zeros((2, len(own_ids), positives), np.int64)
        wanted[0] = -1  # no band
        at = found["slot"].to_numpy(), found["rank"].to_numpy() - 1
        wanted[0][at], wanted[1][at] = found["score"].to_numpy(), found["id"].to_numpy()
        bands = spark.sparkContext.broadcast(wanted)

        def banded(batches: Iterator[pa.RecordBatch], sent=sent, bands=bands, block=block) -> Iterator[pa.RecordBatch]:
            own_ids, own_labels, own_q, angle, norm = sent.value
            goal, goal_ids = bands.value
            best = Best(goal.size, negatives)
            for ids, labels, q, lower, upper in _windows(batches, dims, angle, norm):
                bar = best.bar.reshape(goal.shape)
                mixed = (labels != own_labels[:, None]).any(axis=1) if labels.min() != labels.max() else own_labels != labels[0]
                open_ = mixed[:, None] & (goal >= 0) & (100 * upper[:, None] >= low * goal) & (100 * lower[:, None] <= high * goal) & (upper[:, None] >= bar)
                need = np.flatnonzero(open_.any(axis=1))
                if not len(need):
                    continue
                score = products(own_q[need], q)
                other = (labels != own_labels[need, None]) & (ids != own_ids[need, None])
                for p in range(positives):
                    of = goal[need, p][:, None]
                    row, at = np.nonzero(other & open_[need, p][:, None] & (100 * score >= low * of) & (100 * score <= high * of) & (score >= bar[need, p][:, None]))
                    best.add(need[row] * positives + p, score[row, at], ids[at])
            slot, score, ids = best.settle()
            columns = [slot + block * (1 << 32), own_ids[slot // positives], goal_ids.reshape(-1)[slot], goal.reshape(-1)[slot], ids, score]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["slot", "anchor_id", "positive_id", "positive_score", "id", "score"])

        with arrow_batches(spark, 64, 16 << 20):
            paths.append(fresh_dir(spark, "negatives"))
            index.mapInArrow(banded, HITS).write.parquet(paths[-1])
        sent.destroy()
        bands.destroy()
    hits = spark.read.schema(HITS).parquet(*paths) if paths else spark.createDataFrame([], HITS)
    order = W.partitionBy("slot").orderBy(F.desc("score"), "id")
    best = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return best.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Index the (id, label, q) rows, then mine for those that ``is_anchor`` (over ``id``) picks."""
    spark = rows.sparkSession
    path = fresh_dir(spark, "triangle-windows")
    rows = materialise(rows, "triangle-rows")
    dims, directions = build_windows(rows, path)
    return mine(spark, path, dims, directions, rows.filter(is_anchor), positives, negatives, low, high)
