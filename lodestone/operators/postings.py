"""A stored inverted index of chunks, and BM25 over it with block-max pruning.

The index is one table, partitioned by ``bucket``, a hash of the term.  Chunks
are indexed in shards of bounded size, numbered in id order within a shard.  A
row is a block of up to ``BLOCK`` postings of one term and shard, in chunk order:
chunk numbers, term frequencies, chunk lengths, and the greatest frequency and
least length of the block, which bound what any of its postings can score.
Bucket -1 holds a row per chunk with its ids and, as n, its length.

A search reads the buckets of the query's terms and no text.  Document
frequencies are sums over the blocks' sizes.  A shard's blocks meet in one task,
where every chunk of the shard is complete, so a shard gives k rows per query.
There terms are taken by what they can still add; once all terms that are left
can't lift a new chunk to the k-th best score so far, only blocks that hold a
candidate are opened, and before that, blocks whose bound is too low are skipped.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.text import tokens
from lodestone.operators import topk
from lodestone.operators.lexical import B, K1, query_terms
from lodestone.session import materialise

BUCKETS = 64
BLOCK = 128
SHARD_CHUNKS = 1 << 16
SHARD_POSTINGS = 2 << 20
SLACK = 1e-5  # scores are rounded to 6 digits before they are ranked

BLOCKS = "shard long, term string, n int, first_doc int, last_doc int, max_tf int, min_len int, docs array<int>, tfs array<int>, lens array<int>, doc_no int"
LISTS = ["docs", "tfs", "lens"]


def bucket_of(term: str, buckets: int) -> int:
    return zlib.crc32(term.encode()) % buckets


def saturation(tf, length, mean_len: float, k1: float, b: float):
    """What a term frequency counts in a chunk of some length, before the term's weight."""
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean_len))


class _Shard:
    """Postings of the chunks seen since the last flush."""

    def __init__(self, number: int):
        self.number, self.chunks, self.postings = number, 0, 0
        self.terms: dict[str, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.lengths: list[np.ndarray] = []
        self.ids: list[pa.RecordBatch] = []

    def add(self, ids: pa.RecordBatch, tokens: pa.Array) -> None:
        lengths = np.asarray(tokens.value_lengths().fill_null(0), dtype="int64")
        coded = tokens.flatten().cast(pa.string()).dictionary_encode()
        own = np.array([self.terms.setdefault(t, len(self.terms)) for t in coded.dictionary.to_pylist()], dtype="int64")
        doc = np.repeat(np.arange(len(lengths)), lengths)
        cell, tf = np.unique(doc * max(1, len(own)) + coded.indices.to_numpy(), return_counts=True)
        self.parts.append((own[cell % max(1, len(own))] if len(cell) else cell, cell // max(1, len(own)) + self.chunks, tf))
        self.lengths.append(lengths)
        self.ids.append(ids)
        self.chunks += len(lengths)
        self.postings += len(cell)

    def rows(self, buckets: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        term, doc, tf = (np.concatenate(x) for x in zip(*self.parts))
        lengths = np.concatenate(self.lengths)
        order = np.lexsort((doc, term))
        term, doc, tf = term[order], doc[order].astype("int32"), tf[order].astype("int32")
        length = lengths[doc].astype("int32")
        first = np.searchsorted(term, np.arange(len(self.terms)))
        at = np.flatnonzero((np.arange(len(term)) - first[term]) % BLOCK == 0)  # a block begins
        n = np.diff(np.append(at, len(term)))
        names = list(self.terms)
        bucket_by_term = np.array([bucket_of(t, buckets) for t in names], dtype="int32")
        ends = pa.array(np.append(at, len(term)), pa.int32())
        columns = {
            "bucket": bucket_by_term[term[at]], "shard": np.full(len(at), self.number), "term": pa.array(names, pa.string()).take(pa.array(term[at])),
            "n": n.astype("int32"), "first_doc": doc[at], "last_doc": doc[at + n - 1],
            "max_tf": np.maximum.reduceat(tf, at) if len(at) else tf, "min_len": np.minimum.reduceat(length, at) if len(at) else length,
            **{name: pa.ListArray.from_arrays(ends, pa.array(values)) for name, values in zip(LISTS, (doc, tf, length))},
        }
        yield from _filled(columns, len(at), schema).to_batches(max_chunksize=10_000)
        ids = pa.Table.from_batches(self.ids)
        columns = {"bucket": np.full(self.chunks, -1), "shard": np.full(self.chunks, self.number), "doc_no": np.arange(self.chunks), "n": lengths, **{c: ids[c] for c in ids.column_names}}
        yield from _filled(columns, self.chunks, schema).to_batches(max_chunksize=10_000)


def _filled(columns: dict, rows: int, schema: pa.Schema) -> pa.Table:
    """A table of the schema; columns that aren't given are null."""
    values = [columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in schema]
    cast = [v.cast(f.type) if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, f.type) for v, f in zip(values, schema)]
    return pa.Table.from_arrays(cast, schema=schema)


def build_postings(chunks: DataFrame, path: str, ids: Sequence[str], text: str = "chunk_text", buckets: int = BUCKETS) -> str:
    """Writes the index of the chunks and returns its path; ids must be unique.

    Each task sorts its chunks by id, so a retried task numbers them alike.  Blocks are gathered by bucket in partitions
    of even size, however common a term is.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = chunks.sparkSession
    fields = [T.StructField("bucket", T.IntegerType()), *T.StructType.fromDDL(BLOCKS).fields]
    schema = T.StructType([*fields, *[T.StructField(c, chunks.schema[c].dataType) for c in ids]])
    arrow = to_arrow_schema(schema)
    own = list(ids)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(TaskContext.get().partitionId() << 32)
        for batch in batches:
            shard.add(batch.select(own), batch["tokens"])
            if shard.chunks >= SHARD_CHUNKS or shard.postings >= SHARD_POSTINGS:
                yield from shard.rows(buckets, arrow)
                shard = _Shard(shard.number + 1)
        if shard.chunks:
            yield from shard.rows(buckets, arrow)

    tokenised = chunks.filter(F.col(text).isNotNull()).select(*ids, tokens(text).alias("tokens")).sortWithinPartitions(*ids)
    tokenised.mapInArrow(index, schema).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{path}/postings")
    chunk_rows = spark.read.schema(schema).parquet(f"{path}/postings").filter("bucket = -1")
    totals = chunk_rows.agg(
        F.count("*").alias("chunks"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.lit(buckets).alias("buckets"), F.lit(schema.json()).alias("schema")
    )
    totals.write.parquet(f"{path}/totals")
    return path


def _totals(spark: SparkSession, path: str) -> Row:
    """chunks, tokens, buckets and the schema of the blocks: one row."""
    return spark.read.schema("chunks long, tokens long, buckets int, schema string").parquet(f"{path}/totals").first()


def _entries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType.fromJson(json.loads(_totals(spark, path)["schema"]))).parquet(f"{path}/postings")


def query_postings(spark: SparkSession, path: str, terms: DataFrame) -> DataFrame:
    """The blocks of the terms (a table with ``term``): only the folders of their buckets are read."""
    buckets = _totals(spark, path)["buckets"]
    vocabulary = materialise(terms.select("term").distinct(), "vocabulary")
    wanted = vocabulary.select((F.crc32(F.col("term")) % buckets).cast("int").alias("b")).distinct().collect()  # as many as buckets
    return _entries(spark, path).filter(F.col("bucket").isin([r["b"] for r in wanted])).join(vocabulary, "term")


class ShardSearch:
    """The best chunks of one shard for each query; ``opened`` and ``skipped`` count blocks."""

    def __init__(self, blocks: pa.Table, mean_len: float, k1: float, b: float):
        blocks = blocks.sort_by([("term", "ascending"), ("first_doc", "ascending")]).combine_chunks()
        terms = blocks["term"].to_pylist()
        self.first = {}
        for i, term in enumerate(terms):
            self.first.setdefault(term, i)
        self.last = {term: i + 1 for i, term in enumerate(terms)}
        self.low, self.high = blocks["first_doc"].to_numpy(), blocks["last_doc"].to_numpy()
        self.bound = saturation(blocks["max_tf"].to_numpy(), blocks["min_len"].to_numpy(), mean_len, k1, b)
        lists = [blocks[c].combine_chunks() if isinstance(blocks[c], pa.ChunkedArray) else blocks[c] for c in LISTS]
        self.at = np.concatenate([[0], np.cumsum(np.asarray(lists[0].value_lengths(), dtype="int64"))])
        self.docs, tfs, lens = (np.asarray(x.flatten()) for x in lists)
        self.tfs, self.lens, self.shape = tfs, lens, (mean_len, k1, b)
        self.scores = np.zeros(int(self.high.max()) + 1 if len(self.high) else 0)
        self.opened = self.skipped = 0

    def _open(self, blocks: np.ndarray, weight: float) -> np.ndarray:
        """Adds the postings of the blocks; returns their chunks."""
        lengths = self.at[blocks + 1] - self.at[blocks]
        ends = np.cumsum(lengths)
        where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.at[blocks] - (ends - lengths), lengths)
        docs = self.docs[where]
        self.scores[docs] += weight * saturation(self.tfs[where], self.lens[where], *self.shape)
        self.opened += len(blocks)
        return docs

    def best(self, terms: Sequence[str], weights: Sequence[float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(chunk numbers, rounded scores) of the k best; ties to the smaller number."""
        use = [(w * self.bound[self.first[t] : self.last[t]].max(), w, t) for t, w in zip(terms, weights) if t in self.first and w > 0]
        use.sort(key=lambda x: (-x[0], x[2]))
        left = np.append(np.cumsum([x[0] for x in use][::-1])[::-1], 0.0)
        seen, bar = np.zeros(0, np.int64), -np.inf
        for i, (_, weight, term) in enumerate(use):
            blocks = np.arange(self.first[term], self.last[term])
            if left[i] < bar - SLACK:  # no chunk outside those seen can get there
                seen = seen[self.scores[seen] + left[i] >= bar - SLACK]
                block = np.searchsorted(self.low[blocks], seen, side="right") - 1
                inside = (block >= 0) & (seen <= self.high[blocks[np.maximum(block, 0)]])
                some = blocks[np.unique(block[inside])]
                touched = self._open(some, weight)
                self.dirty.append(touched)
            else:
                if bar > -np.inf and len(blocks) > 1:
                    there = np.array([self.scores[a : b + 1].max() for a, b in zip(self.low[blocks], self.high[blocks])])
                    some = blocks[weight * self.bound[blocks] + left[i + 1] + there >= bar - SLACK]
                else:
                    some = blocks
                touched = self._open(some, weight)
                self.dirty.append(touched)
                seen = np.union1d(seen, touched)
            self.skipped += len(blocks) - len(some)
            if len(seen) >= k:
                bar = max(bar, float(np.partition(self.scores[seen], -k)[-k]))
        score = np.round(self.scores[seen], topk.SCORE_DIGITS)
        some = np.lexsort((seen, -score))[:k]
        return seen[some], score[some]

    def each(self, queries: pa.Table, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for number, (terms, weights) in enumerate(zip(queries["terms"].to_pylist(), queries["weights"].to_pylist())):
            self.dirty: list[np.ndarray] = []
            docs, scores = self.best(terms, weights, k)
            yield number, docs, scores
            for touched in self.dirty:
                self.scores[touched] = 0


def weighted_terms(spark: SparkSession, path: str, terms: DataFrame, blocks: DataFrame) -> tuple[DataFrame, float]:
    """(query_id, terms, weights: qtf * idf) and the mean chunk length, from the index alone."""
    totals = _totals(spark, path)
    chunks = float(totals["chunks"])
    df = blocks.groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.log(1 + (F.lit(chunks) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = terms.join(materialise(df, "frequencies"), "term").withColumn("weight", F.col("qtf") * idf)
    pairs = weighted.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("tw"))
    return pairs.select("query_id", F.col("tw.term").alias("terms"), F.col("tw.weight").alias("weights")), (totals["tokens"] / chunks if chunks else 1.0) or 1.0


def search_postings(spark: SparkSession, path: str, queries: DataFrame, ids: Sequence[str], k: int, query: str = "query", k1: float = K1, b: float = B) -> DataFrame:
    """(query_id, *ids, bm25, rank) as ``lexical.bm25_topk``, over a stored index.  Runs jobs over the terms' blocks."""
    terms = materialise(query_terms(queries, query), "query-terms")
    blocks = query_postings(spark, path, terms)
    weighted, mean_len = weighted_terms(spark, path, terms, blocks)
    needed = blocks.select("shard", "term", "first_doc", "last_doc", "max_tf", "min_len", *LISTS)
    docs = _entries(spark, path).filter("bucket = -1").select("shard", "doc_no", *ids)
    schema = T.StructType([weighted.schema["query_id"], *T.StructType.fromDDL("shard long, doc_no int, score double").fields])

    def searcher(shared):
        def search(group: pa.Table) -> pa.Table:
            asked = shared.value
            hits = list(ShardSearch(group, mean_len, k1, b).each(asked, k))
            rows = np.repeat(np.array([h[0] for h in hits], "int64"), [len(h[1]) for h in hits])
            joined = lambda i, kind: np.concatenate([np.zeros(0, kind), *[h[i] for h in hits]]).astype(kind)
            own = asked["query_id"].combine_chunks().take(pa.array(rows))
            number = np.full(len(rows), group["shard"][0].as_py())
            return pa.Table.from_arrays([own, pa.array(number), pa.array(joined(1, "int32")), pa.array(joined(2, "float64"))], ["query_id", "shard", "doc_no", "score"])

        return search

    by_shard = needed.groupBy("shard")
    found = [materialise(by_shard.applyInArrow(searcher(spark.sparkContext.broadcast(block)), schema), "shard-hits") for block in topk.query_blocks(weighted)]
    hits = reduce(DataFrame.unionByName, found)
    ranked = topk.rank_rows(hits.join(docs, ["shard", "doc_no"]).select("query_id", *ids, "score"), ids, k)
    return ranked.withColumnRenamed("score", "bm25")
