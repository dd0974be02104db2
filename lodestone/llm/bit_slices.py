"""Operator 6: exact top-k by inner product over a bit-sliced index.

The index holds blocks of rows.  A block has, for each component, the bits of
the quantised values as bitmaps over its rows, most significant last.  A query
adds the slices of the components, each shifted by the bits of the query's own
component (complemented where that is negative), with carry-save adders on
bitmaps, which gives the score's slices.  The best rows are then picked from
the most significant slice downward; rows that are equal to the last slice are
the boundary, and the smallest ids of them are taken.

Every row is indexed.  Queries come in blocks of bounded size, each sent to the
tasks and run over the index in place; a task gives k rows per query and block.

Cases: null vectors and vectors with a null, NaN or infinite component take no
part, nor do rows without an id; shorter vectors are filled up with zeros; a
query isn't matched with rows of its own id; query rows of one id with different
vectors are queries of their own, numbered in the order of their vectors
(query_no, from 1), and equal ones are one query; ties go to the smaller id, and
rows repeated with the same id can each be a result; fewer rows than k give all;
an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.common import BATCH_BYTES, arrow_batches
from lodestone.session import fresh_dir, materialise

BLOCK_ROWS = 1 << 16
QUERY_BLOCK = 4096
INDEX = "n int, ids binary, slices binary"
FOUND = "query_id long, query_no int, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(id, q: array of floor(scale * x)) of the rows that take part."""
    x = F.transform(vector_col, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).filter(fine & F.col("id").isNotNull())
    return rows.select("id", F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("q"))


def build_index(rows: DataFrame, path: str) -> dict[str, int]:
    """Writes the index of (id, q) rows; returns its shape: components, least value, bits per value."""
    spark = rows.sparkSession
    shape = rows.agg(F.max(F.size("q")).alias("d"), F.min(F.array_min("q")).alias("lo"), F.max(F.array_max("q")).alias("hi")).first()
    dims, low = shape["d"] or 0, min(shape["lo"] or 0, 0)
    bits = max(1, int(max(shape["hi"] or 0, 0) - low).bit_length())

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate([b["id"].to_numpy() for b in held])
            values = np.concatenate([matrix(b["q"], dims) for b in held]) - low
            words = -(-len(ids) // 64)
            out = np.zeros((dims, bits, words * 8), np.uint8)
            for b in range(bits):
                out[:, b, : -(-len(ids) // 8)] = np.packbits(((values >> b) & 1).astype(bool).T, axis=1, bitorder="little")
            return pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([out.tobytes()], pa.binary())], ["n", "ids", "slices"])

        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                held.append(batch.slice(lo, BLOCK_ROWS))
                size += held[-1].num_rows
                if size >= BLOCK_ROWS:
                    yield block()
                    held, size = [], 0
        if size:
            yield block()

    rows.mapInArrow(index, INDEX).write.parquet(path)
    return {"dims": dims, "low": low, "bits": bits}


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims), np.int64)
    many = np.array([len(x) for x in column], np.int64)
    if len(many) and (many == dims).all():
        return column.flatten().to_numpy().reshape(-1, dims).astype(np.int64)
    for i, x in enumerate(column):
        out[i, : many[i]] = x.values.to_numpy() if many[i] else 0
    return out


def add_slices(slices: np.ndarray, query: np.ndarray, low: int) -> tuple[np.ndarray, int]:
    """(slices of sum(query * value), what to add to it) with bitmaps (components, bits, words) of value - low.

    A negative component counts the complement: -q * u = q * (top - u) - q * top.
    """
    bits = slices.shape[1]
    top = (1 << bits) - 1
    size, negative = np.abs(query), query < 0
    levels: dict[int, list[np.ndarray]] = {}
    for j in range(int(size.max()).bit_length() if len(size) else 0):
        use = (size >> j) & 1 == 1
        for some, flip in ((use & ~negative, False), (use & negative, True)):
            if some.any():
                part = ~slices[some] if flip else slices[some]
                for b in range(bits):
                    levels.setdefault(j + b, []).append(part[:, b])
    out, level = [], 0
    while level <= max(levels, default=-1):
        stack = np.concatenate(levels.get(level) or [np.zeros((1, slices.shape[2]), np.uint64)])
        while len(stack) > 1:
            if len(stack) == 2:
                carry, stack = (stack[:1] & stack[1:]), stack[:1] ^ stack[1:]
            else:
                third = len(stack) // 3
                a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
                half = a ^ b
                carry, stack = (a & b) | (half & c), np.concatenate([half ^ c, stack[3 * third :]])
            levels.setdefault(level + 1, []).append(carry)
        out.append(stack[0])
        level += 1
    total = np.array(out) if out else np.zeros((1, slices.shape[2]), np.uint64)
    return total, int((query * low).sum()) - int((size * top)[negative].sum())


def best_rows(total: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of rows surely among the best k, and of the boundary: equal rows of which some are."""
    sure, open_rows = np.zeros_like(valid), valid
    count = lambda x: int(np.bitwise_count(x).sum())
    for level in total[::-1]:
        high = open_rows & level
        n = count(sure) + count(high)
        if n > k:
            open_rows = high
        else:
            sure, open_rows = sure | high, open_rows & ~level
            if n == k:
                break
    return sure, open_rows


def positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def search(spark: SparkSession, path: str, shape: dict[str, int], queries: DataFrame, k: int) -> DataFrame:
    """query_id, query_no, rank, vec_id, score: the k best rows of the index for every distinct (id, q) query.

    A block's finds are written before the next block is sent, so that one block is with the tasks at a time.
    """
    queries = queries.distinct().withColumn("no", F.row_number().over(W.partitionBy("id").orderBy("q")))
    queries = materialise(queries, "bit-slice-queries")
    parts = -(-queries.count() // QUERY_BLOCK)
    dims, low, bits = shape["dims"], shape["low"], shape["bits"]
    found = None
    for part in range(parts):
        some = queries if parts == 1 else queries.filter(F.pmod(F.xxhash64("id", "no"), F.lit(parts)) == part)
        got = some.toArrow()  # about QUERY_BLOCK rows of dims numbers
        block = spark.sparkContext.broadcast((got["id"].to_numpy(), got["no"].to_numpy(), matrix(got["q"].combine_chunks(), dims)))

        def look(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            query_ids, query_nos, queries_q = block.value
            for batch in batches:
                for row in range(batch.num_rows):
                    n = batch["n"][row].as_py()
                    ids = np.frombuffer(batch["ids"][row].as_buffer(), np.int64)
                    slices = np.frombuffer(batch["slices"][row].as_buffer(), np.uint64).reshape(dims, bits, -1)
                    valid = np.packbits(np.arange(slices.shape[2] * 64) < n, bitorder="little").view(np.uint64)
                    by_id = np.argsort(ids, kind="stable")
                    out = [[], [], [], []]
                    for query_id, no, q in zip(query_ids, query_nos, queries_q):
                        own = by_id[np.searchsorted(ids[by_id], query_id, "left") : np.searchsorted(ids[by_id], query_id, "right")]
                        rows = valid
                        if len(own):
                            rows = valid.copy()
                            for r in own.tolist():
                                rows[r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
                        total, shift = add_slices(slices, q, low)
                        sure, equal = best_rows(total, rows, k)
                        taken = positions(sure)
                        if len(taken) < k:
                            rest = positions(equal)
                            taken = np.concatenate([taken, rest[np.argsort(ids[rest], kind="stable")[: k - len(taken)]]])
                        values = ((total[:, taken >> 6] >> (taken & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
                        score = (values << np.arange(len(total))[:, None]).sum(axis=0) + shift
                        out[0].append(np.full(len(taken), query_id))
                        out[1].append(np.full(len(taken), no))
                        out[2].append(ids[taken])
                        out[3].append(score)
                    if len(query_ids):
                        kinds = (np.int64, np.int32, np.int64, np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(t)) for x, t in zip(out, kinds)], ["query_id", "query_no", "vec_id", "score"])

        with arrow_batches(spark, 4, BATCH_BYTES):  # a row is a block of the index
            best = materialise(spark.read.schema(INDEX).parquet(path).mapInArrow(look, FOUND), "bit-slice-finds")
        block.unpersist()
        found = best if found is None else found.unionByName(best)
    found = spark.createDataFrame([], FOUND) if found is None else found
    order = W.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "query_no", "rank", "vec_id", "score")


def topk(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Index, then search with the rows that ``is_query`` (over ``id``) picks."""
    spark = vectors.sparkSession
    path = fresh_dir(spark, "bit-slices")
    rows = quantised(vectors, id_col, vector_col)
    with arrow_batches(spark, 4096, BATCH_BYTES):
        shape = build_index(rows, path)
    return search(spark, path, shape, rows.filter(is_query), k)
