"""A stored cell index: cosine search that reads a few partitions of a table.

The index is a table partitioned by cell, a row's cell being its nearest centre.
How many cells there are follows from the row count (its square root, up to
``MAX_CELLS``).  Centres are fitted on all rows, and every row is indexed.

A search looks at the ``nprobe`` nearest centres of each query, reads only the
partitions some query of the block wants, in place, and scores a cell's rows
with just the queries that probe it.  Within the probed cells it is exact.

Cases: null vectors and vectors with a null, NaN or infinite component are left
out, of queries as well; a zero vector has cosine 0 with all; equal ids are
rows of their own; ties go to the smaller id; ``nprobe`` beyond the number of
cells probes all, which makes the search exact; an empty table gives an index
that finds nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.unions import union_all
from lodestone.operators import topk
from lodestone.operators.vector_search import CosineScorer, _matrix, _unit, probe_cells, vector_topk
from lodestone.session import fresh_dir, materialise

MAX_CELLS = 4096
CENTRES = "cell int, centre array<double>"


def _fine(vector: str) -> Column:
    x = F.col(vector)
    return x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf")))


def cell_count(rows: int) -> int:
    return max(1, min(MAX_CELLS, round(rows**0.5)))


def build_cells(items: DataFrame, path: str, ids: Sequence[str], vector: str = "embedding", cells: int | None = None, seed: int = 42) -> str:
    """Writes ``<path>/centres`` and ``<path>/items``, the latter partitioned by cell.  Returns the path."""
    spark = items.sparkSession
    rows = items.select(*ids, vector).filter(_fine(vector))
    n = rows.count()
    cells = cells or cell_count(n)
    turned = Normalizer(inputCol="raw", outputCol="features").transform(rows.withColumn("raw", array_to_vector(F.col(vector)))).drop("raw")
    if n == 0:
        spark.createDataFrame([], CENTRES).write.parquet(f"{path}/centres")
        rows.withColumn("cell", F.lit(0)).write.parquet(f"{path}/items")
        return path
    model = KMeans(k=cells, seed=seed, maxIter=10).fit(turned.select("features"))
    centres = [(k, [float(x) for x in c]) for k, c in enumerate(model.clusterCenters())]  # at most MAX_CELLS
    spark.createDataFrame(centres, CENTRES).coalesce(1).write.parquet(f"{path}/centres")
    placed = model.setPredictionCol("cell").transform(turned).select(*ids, vector, "cell")
    # by ranges, with the ids' hash behind the cell, so that a cell with a third of all rows is several tasks' work
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed.repartitionByRange(parts, "cell", F.xxhash64(*ids)).write.partitionBy("cell").parquet(f"{path}/items")
    return path


class _Centres:
    def __init__(self, rows: list):
        self.rows = rows

    def clusterCenters(self) -> list[list[float]]:  # noqa: N802, as probe_cells asks for it
        return [r["centre"] for r in self.rows]


def _read_centres(spark: SparkSession, path: str) -> list:
    return sorted(spark.read.schema(CENTRES).parquet(f"{path}/centres").collect(), key=lambda r: r["cell"])  # at most MAX_CELLS rows


def probes(spark: SparkSession, path: str, queries: DataFrame, nprobe: int) -> DataFrame:
    """(query_id, query_vector, cells): the cells each query looks at."""
    centres = _read_centres(spark, path)
    good = queries.select("query_id", "query_vector").filter(_fine("query_vector"))
    if not centres:
        return good.withColumn("cells", F.array().cast("array<int>")).limit(0)
    length = F.sqrt(F.aggregate("query_vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    unit = F.transform("query_vector", lambda x: F.when(length > 0, x.cast("double") / length).otherwise(F.lit(0.0)))
    numbered = good.select(F.monotonically_increasing_id().alias("_row"), "query_id", F.col("query_vector").alias("_given"), unit.alias("query_vector"))
    pairs = probe_cells(numbered, _Centres(centres), nprobe)
    per_query = pairs.groupBy("_row").agg(F.first("query_id").alias("query_id"), F.first("_given").alias("query_vector"), F.collect_set("cell").alias("cells"))
    return per_query.drop("_row")  # a list of at most nprobe numbers


def read_cells(spark: SparkSession, path: str, cells: Sequence[int]) -> DataFrame:
    """The rows of some cells; Spark lists the others' partitions but doesn't read them."""
    return spark.read.parquet(f"{path}/items").filter(F.col("cell").isin([int(c) for c in cells]))


def search_cells(spark: SparkSession, path: str, queries: DataFrame, ids: Sequence[str], k: int, nprobe: int, vector: str = "embedding") -> DataFrame:
    """(query_id, *ids, similarity, rank); queries carry a unique query_id and query_vector.

    Queries come in blocks of bounded size; a block's finds, k rows per query and task, are written before the next is sent.
    """
    asked = materialise(probes(spark, path, queries, nprobe), "cell-probes")
    size = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("query_vector") * 8 + F.size("cells") * 4), F.lit(0)).alias("b")).first()
    parts = max(-(-size["n"] // topk.MAX_BLOCK_QUERIES), -(-size["b"] // topk.MAX_BLOCK_BYTES))
    stored = spark.read.parquet(f"{path}/items")
    spark_schema, arrow_schema = topk._schemas(stored, queries, ids)
    found = [spark.createDataFrame([], spark_schema)]
    if parts > 1:  # folders of a table, so that each block reads its own rows only
        blocks = fresh_dir(spark, "cell-probes")
        asked.withColumn("_part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")).repartition("_part").write.partitionBy("_part").parquet(blocks)
        asked = spark.read.parquet(blocks)
    for part in range(parts):
        some = asked if parts == 1 else asked.filter(F.col("_part") == part).drop("_part")
        block = some.toArrow()
        if not block.num_rows:
            continue
        shared = spark.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            scorer = CosineScorer(shared.value, vector)
            best = topk._Best(len(scorer.query_ids), ids, k)
            wanted = _queries_by_cell(shared.value)
            for batch in batches:
                _offer(best, scorer, wanted, batch, ids)
            yield from topk._emit(best, scorer, arrow_schema).to_batches()

        cells = np.unique(block["cells"].combine_chunks().flatten().to_numpy())
        found.append(materialise(read_cells(spark, path, cells).mapInArrow(scan, spark_schema), "cell-finds"))
        shared.unpersist()
    return topk.rank_rows(union_all(*found), ids, k).withColumnRenamed("score", "similarity")


def exact_finds(spark: SparkSession, path: str, queries: DataFrame, ids: Sequence[str], k: int, vector: str = "embedding") -> DataFrame:
    """(query_id, *ids, cell, similarity, rank): the k best of all rows of the index, each with its cell."""
    good = queries.select("query_id", "query_vector").filter(_fine("query_vector"))
    return vector_topk(spark.read.parquet(f"{path}/items"), good, [*ids, "cell"], k, vector)


def probes_needed(spark: SparkSession, path: str, queries: DataFrame, ids: Sequence[str], k: int, target: float = 0.95, vector: str = "embedding", exact: DataFrame | None = None) -> int:
    """The least number of probes that finds ``target`` of the k best of the queries, all of them.

    All cells are searched (or ``exact`` has what ``exact_finds`` gives); it is then seen how far down a query's list of cells
    each answer lies.  Of queries with one query_id, the one that looks at the answer's cell first counts.
    """
    if exact is None:
        exact = exact_finds(spark, path, queries, ids, k, vector)
    centres = np.array([r["centre"] for r in _read_centres(spark, path)])
    good = queries.select("query_id", "query_vector").filter(_fine("query_vector"))
    found = exact.groupBy(F.col("query_id").alias("_found")).agg(F.array_sort(F.collect_list("cell")).alias("cells"))  # k cells a query_id
    asked = good.join(found, F.col("query_id").eqNullSafe(F.col("_found"))).select("query_id", "query_vector", "cells")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, topk.CELLS_PER_STEP // max(1, len(centres)))
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                yield pa.RecordBatch.from_arrays([part["query_id"], pa.array(_ranks(part, centres), pa.list_(pa.int32()))], ["query_id", "needed"])

    schema = T.StructType([queries.schema["query_id"], T.StructField("needed", T.ArrayType(T.IntegerType()))])
    each = asked.mapInArrow(rank, schema).select("query_id", F.posexplode("needed").alias("place", "needed"))
    needed = each.groupBy("query_id", "place").agg(F.min("needed").alias("needed")).groupBy("needed").count().orderBy("needed").collect()  # at most MAX_CELLS rows
    if not needed:
        return 1
    upto = np.cumsum([r["count"] for r in needed])
    return int(needed[int(np.searchsorted(upto, min(upto[-1], max(1, int(np.ceil(target * upto[-1]))))))]["needed"])


def _ranks(block: pa.RecordBatch, centres: np.ndarray) -> list[list[int]]:
    """For each query, the places of its ``cells`` in its list of cells, from 1."""
    points = _unit(_matrix(block["query_vector"]))
    gaps = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]
    place = np.empty(gaps.shape, np.int32)
    np.put_along_axis(place, np.argsort(gaps, axis=1, kind="stable"), np.arange(1, len(centres) + 1, dtype=np.int32)[None, :], axis=1)
    return [place[row, cells].tolist() for row, cells in enumerate(block["cells"].to_pylist())]


def _queries_by_cell(block: pa.Table) -> dict[int, np.ndarray]:
    lists = block["cells"].combine_chunks()
    query = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
    cell = lists.flatten().to_numpy()
    order = np.argsort(cell, kind="stable")
    names, first = np.unique(cell[order], return_index=True)
    return dict(zip(names.tolist(), np.split(query[order], first[1:])))


def _offer(best, scorer: CosineScorer, wanted: dict[int, np.ndarray], batch: pa.RecordBatch, ids: Sequence[str]) -> None:
    """A batch's rows, cell by cell, to the queries that probe the cell."""
    cells = batch["cell"].to_numpy(zero_copy_only=False)
    for cell in np.unique(cells).tolist():
        asking = wanted.get(cell)
        if asking is None:
            continue
        rows = np.flatnonzero(cells == cell)
        step = max(1, topk.CELLS_PER_STEP // len(asking))
        for lo in range(0, len(rows), step):
            part = batch.take(pa.array(rows[lo : lo + step]))
            scores = np.round(scorer.score_some(part, asking), topk.SCORE_DIGITS)
            bar = best.bar[asking]
            if len(scores) > best.k:
                bar = np.maximum(bar, np.partition(scores, -best.k, axis=0)[-best.k])
            row, query = topk.cells_of(scores >= bar)
            if len(row):
                best.take(row, asking[query], scores[row, query], part.select(list(ids)).to_pandas())
