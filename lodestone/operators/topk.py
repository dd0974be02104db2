"""Exact top-k of items per query.

Scoring every (query, item) pair as rows would shuffle |queries| x |items|
rows.  Here a task scores an Arrow batch of items against a block of queries
and keeps a running k best per query, so it only ever emits k rows per query.

* ``topk_scan``: the query block is small (checked) and travels to every task;
  the items are read once, in place, without a shuffle.
* ``topk_blocks``: any number of queries, in blocks of that size.  Each block is
  one scan of the items in place, and its k best rows per query are written
  before the next, so neither items nor pairs are ever shuffled.
* ``topk_tiled``: queries restricted to items with equal ``keys``.  Both sides
  are cut into tiles of bounded size and tiles meet in a cogroup; a hot key just
  gets more tiles.
* ``topk``: picks between the first two by the size of the query side.

Scores are rounded to 6 digits before ranking and ties go to the smaller id,
so the answer does not depend on partitioning or summation order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.session import fresh_dir, materialise

SCORE_DIGITS = 6
MAX_BLOCK_QUERIES = 4096  # queries sent to every task; more go through tiles
MAX_BLOCK_BYTES = 64 << 20
WIDE = 4  # times as many where a scorer's scores don't all lie in memory at once: fewer scans, of which each reads all items
TILE_ITEMS = 50_000
TILE_QUERIES = 2048
CELLS_PER_STEP = 4 << 20  # scores held at once in a task
ROWS_AT_ONCE, QUERIES_AT_ONCE = 1024, 256  # a single-precision product that stays in a core's cache


class Scorer(Protocol):
    query_ids: Sequence

    def score(self, items: pa.RecordBatch) -> np.ndarray:
        """(rows, queries) scores; -inf where the item is no candidate.

        A scorer may also have ``hold``, which takes a batch and gives its rows in single precision,
        ``blocks``, (first query, what these rows are multiplied with) for some queries at a time,
        ``slack``, how far off such products can be, and ``exact``, the scores of given (row, query)
        cells of the batch; then only cells near the k best are scored exactly.
        """


MakeScorer = Callable[[pa.Table], Scorer]


def cells_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the set cells; few are set, so eight cells are looked at as one number."""
    flat = np.ascontiguousarray(mask).reshape(-1)
    whole = len(flat) // 8 * 8
    eights = np.flatnonzero(flat[:whole].view(np.uint64))
    at = np.flatnonzero(flat[:whole].reshape(-1, 8)[eights])
    set_cells = np.concatenate([eights[at >> 3] * 8 + (at & 7), whole + np.flatnonzero(flat[whole:])])
    return np.divmod(set_cells, mask.shape[1])


class _Best:
    """The k best rows per query seen so far."""

    def __init__(self, queries: int, ids: Sequence[str], k: int):
        self.k, self.ids = k, list(ids)
        self.bar = np.full(queries, -np.inf)  # score of the k-th best
        self.kept: list[pd.DataFrame] = []
        self.pending = 0
        self.products = np.empty(ROWS_AT_ONCE * QUERIES_AT_ONCE, "float32")
        self.high = np.empty(len(self.products), bool)

    def offer(self, scores: np.ndarray, ids: pd.DataFrame) -> None:
        bar = self.bar
        if len(scores) > self.k:
            bar = np.maximum(bar, np.partition(scores, -self.k, axis=0)[-self.k])
        row, query = cells_of((scores >= bar) & (scores > -np.inf))
        if len(row):
            self.kept.append(ids.iloc[row].assign(_q=query, _score=scores[row, query]))
            self.pending += len(row)
        if self.pending > 4 * self.k * len(self.bar) + 100_000:
            self.compact()

    def near(self, rows: np.ndarray, scorer: Scorer) -> tuple[np.ndarray, np.ndarray]:
        """The cells that may be among the k best; the first rows set the bars."""
        found = []
        for first, columns in scorer.blocks:
            many = columns.shape[1]
            rough = np.matmul(rows, columns, out=self.products[: len(rows) * many].reshape(len(rows), many))
            bar = self.bar[first : first + many] - scorer.slack
            if len(rows) > self.k and np.isneginf(bar).any():
                bar = np.maximum(bar, np.partition(rough, -self.k, axis=0)[-self.k] - 2 * scorer.slack)
            row, query = cells_of(np.greater_equal(rough, bar.astype(rough.dtype), out=self.high[: rough.size].reshape(rough.shape)))
            found.append((row, query + first))
        return tuple(np.concatenate(x) for x in zip(*found))

    def take(self, row: np.ndarray, query: np.ndarray, scores: np.ndarray, ids: pd.DataFrame) -> None:
        """Exact scores of single cells."""
        good = scores >= self.bar[query]
        if good.any():
            self.kept.append(ids.iloc[row[good]].assign(_q=query[good], _score=scores[good]))
            self.pending += int(good.sum())
        if self.pending > 2 * self.k * len(self.bar) + 50_000 or (np.isneginf(self.bar).any() and self.pending > self.k * len(self.bar)):
            self.compact()

    def compact(self) -> pd.DataFrame:
        if not self.kept:
            return pd.DataFrame({c: [] for c in [*self.ids, "_q", "_score"]})
        rows = pd.concat(self.kept, ignore_index=True)
        rows = rows.sort_values(["_q", "_score", *self.ids], ascending=[True, False, *[True] * len(self.ids)])
        best = rows.groupby("_q", sort=False).head(self.k)
        groups = best.groupby("_q")["_score"].agg(["size", "min"])
        full = groups[groups["size"] == self.k]
        self.bar[full.index.to_numpy()] = full["min"].to_numpy()
        self.kept, self.pending = [best], 0
        return best


def _best_of(batches: Iterable[pa.RecordBatch], scorer: Scorer, ids: Sequence[str], k: int) -> _Best:
    best = _Best(len(scorer.query_ids), ids, k)
    step = max(1, CELLS_PER_STEP // max(1, len(scorer.query_ids)))
    for batch in batches:
        if hasattr(scorer, "hold"):
            rows, names = scorer.hold(batch), batch.select(list(ids)).to_pandas()
            step = max(1, min(ROWS_AT_ONCE, CELLS_PER_STEP // QUERIES_AT_ONCE))
            for lo in range(0, batch.num_rows, step):
                row, query = best.near(rows[lo : lo + step], scorer)
                if len(row):
                    best.take(row + lo, query, np.round(scorer.exact(row + lo, query), SCORE_DIGITS), names)
            continue
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            scores = np.round(scorer.score(part), SCORE_DIGITS)
            best.offer(scores, part.select(list(ids)).to_pandas())
    return best


def _emit(best: _Best, scorer: Scorer, schema: pa.Schema) -> pa.Table:
    rows = best.compact()
    where = rows["_q"].to_numpy(dtype="int64")
    query_ids = pa.array(list(scorer.query_ids), type=schema.field(0).type).take(pa.array(where))
    columns = [query_ids]
    columns += [pa.array(rows[c], type=schema.field(c).type, from_pandas=True) for c in best.ids]
    columns.append(pa.array(rows["_score"].to_numpy(dtype="float64"), type=pa.float64()))
    return pa.Table.from_arrays(columns, schema=schema)


def _schemas(items: DataFrame, queries: DataFrame, ids: Sequence[str]) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    spark_schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            *[T.StructField(c, items.schema[c].dataType) for c in ids],
            T.StructField("score", T.DoubleType()),
        ]
    )
    return spark_schema, to_arrow_schema(spark_schema)


def rank_rows(scored: DataFrame, ids: Sequence[str], k: int | None, score: str = "score") -> DataFrame:
    """Rank from 1 per query; with k, Spark drops the rest map-side (WindowGroupLimit)."""
    order = W.partitionBy("query_id").orderBy(F.desc(score), *ids)
    ranked = scored.withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.filter(F.col("rank") <= k)


def small_block(queries: DataFrame, wide: int = 1) -> pa.Table | None:
    """The query rows if they are few and light, else None.  Runs a bounded job."""
    block = queries.limit(wide * MAX_BLOCK_QUERIES + 1).toArrow()
    if block.num_rows > wide * MAX_BLOCK_QUERIES or block.nbytes > MAX_BLOCK_BYTES:
        return None
    return block


def topk_scan(items: DataFrame, block: pa.Table, make: MakeScorer, ids: Sequence[str], k: int,
              queries: DataFrame) -> DataFrame:
    spark_schema, arrow_schema = _schemas(items, queries, ids)
    shared = items.sparkSession.sparkContext.broadcast(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = make(shared.value)
        if len(scorer.query_ids):
            yield from _emit(_best_of(batches, scorer, ids, k), scorer, arrow_schema).to_batches()

    return rank_rows(items.mapInArrow(scan, spark_schema), ids, k)


def topk_tiled(items: DataFrame, queries: DataFrame, make: MakeScorer, ids: Sequence[str], k: int,
               keys: Sequence[str] = ()) -> DataFrame:
    """Exact for any sizes: each (item tile, query tile) pair is one bounded task group.

    Runs a job that counts both sides per key.
    """
    everything = not keys
    if everything:
        keys = ["_all"]
        items, queries = items.withColumn("_all", F.lit(0)), queries.withColumn("_all", F.lit(0))
    keys = list(keys)
    spark_schema, arrow_schema = _schemas(items, queries, ids)
    # Written once: the queries are counted and then spread.
    queries = materialise(queries, "queries")

    def tiles(df: DataFrame, per_tile: int, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.ceil(F.count("*") / per_tile).cast("int").alias(name))

    # One row per key.  Read from a file its size is known when the joins are planned.
    layout = materialise(tiles(items, TILE_ITEMS, "_its").join(tiles(queries, TILE_QUERIES, "_qts"), keys), "layout")
    if everything:
        layout = F.broadcast(layout)  # a single row

    def spread(df: DataFrame, own: str, other: str, own_ids: Sequence[str]) -> DataFrame:
        own_tile = f"_{own}"
        out = df.join(layout, keys).withColumn(own_tile, F.pmod(F.xxhash64(*own_ids), F.col(f"_{own}s")).cast("int"))
        out = out.withColumn(f"_{other}", F.explode(F.sequence(F.lit(0), F.col(f"_{other}s") - 1)))
        return out.drop("_its", "_qts")

    tile = [*keys, "_it", "_qt"]
    left = spread(items, "it", "qt", ids).groupBy(*tile)
    right = spread(queries, "qt", "it", ["query_id"]).groupBy(*tile)

    def meet(item_tile: pa.Table, query_tile: pa.Table) -> pa.Table:
        if not item_tile.num_rows or not query_tile.num_rows:
            return arrow_schema.empty_table()
        scorer = make(query_tile)
        return _emit(_best_of(item_tile.combine_chunks().to_batches(), scorer, ids, k), scorer, arrow_schema)

    return rank_rows(left.cogroup(right).applyInArrow(meet, spark_schema), ids, k)


def query_blocks(queries: DataFrame, wide: int = 1) -> Iterator[pa.Table]:
    """All queries, in blocks that may be sent to every task; there is at least one.

    Runs a job per block.  Of many queries, blocks are folders of a written table, so each reads its own rows only.
    """
    block = small_block(queries, wide)
    if block is not None:
        yield block
        return
    most = wide * MAX_BLOCK_QUERIES
    spark = queries.sparkSession
    queries = materialise(queries, "queries")
    head = queries.limit(MAX_BLOCK_QUERIES).toArrow()
    fit = min(most, MAX_BLOCK_BYTES * MAX_BLOCK_QUERIES // max(1, head.nbytes))
    blocks = -(-queries.count() * 9 // (8 * max(1, fit))) + 1  # hashed blocks vary in size
    path = fresh_dir(spark, "query-blocks")
    queries.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).repartition("_block").write.partitionBy("_block").parquet(path)
    stored = spark.read.parquet(path)
    for number in range(blocks):
        block = stored.filter(F.col("_block") == number).drop("_block").toArrow()
        if block.num_rows:
            yield block


def topk_blocks(items: DataFrame, queries: DataFrame, make: MakeScorer, ids: Sequence[str], k: int, wide: int = 1) -> DataFrame:
    """Exact for any number of queries: a scan of the items, in place, per block of queries.  Runs these scans."""
    found = [materialise(topk_scan(items, block, make, ids, k, queries), "block-hits") for block in query_blocks(queries, wide)]
    return reduce(DataFrame.unionByName, found)


def topk(items: DataFrame, queries: DataFrame, make: MakeScorer, ids: Sequence[str], k: int, wide: int = 1) -> DataFrame:
    """``wide``: how many times ``MAX_BLOCK_QUERIES`` a block may have."""
    block = small_block(queries, wide)
    if block is not None:
        return topk_scan(items, block, make, ids, k, queries)
    return topk_blocks(items, queries, make, ids, k, wide)
