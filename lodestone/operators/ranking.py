"""Global ranks and running totals without a single-task window.

A window without (or with a hot) partition key puts all rows in one task.
These helpers cut the order into ranges first: totals per range are few, their
running sum is the offset of a range, and only rows of one range share a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.session import materialise


def seeded_hash(key: Column, seed: int) -> Column:
    """Uniform hex digest of a key; the same in any engine with md5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_share(key: Column, seed: int) -> Column:
    """The digest as a number in [0, 1)."""
    head = F.conv(F.substr(seeded_hash(key, seed), F.lit(1), F.lit(8)), 16, 10).cast("double")
    return head / F.lit(4294967296.0)


def hash_rank(distinct_keys: DataFrame, key: str, seed: int, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``hash_rank``, 1..n in order of the seeded hash (within ``by``).  Keys must be distinct."""
    by = list(by)
    digest = seeded_hash(F.col(key), seed)
    ranged = distinct_keys.withColumns({"_h": digest, "_range": F.substr(digest, F.lit(1), F.lit(4))})
    counts = ranged.groupBy(*by, "_range").agg(F.count("*").alias("_n"))  # at most 65,536 per ``by``
    before = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = W.partitionBy(*by, "_range").orderBy("_h", key)
    return (
        ranged.withColumn("_in", F.row_number().over(inside))
        .join(offsets, [*by, "_range"])
        .withColumn("hash_rank", F.col("_before") + F.col("_in"))
        .drop("_h", "_range", "_in", "_before")
    )


def hash_cuts(distinct_keys: DataFrame, key: str, seed: int, **ranks: Column) -> Column:
    """A scalar struct with, per name, the digest of the key at that rank (null below rank 1).

    Rows can then be told apart by comparing digests, without a join or a
    shuffle of the rows themselves; only the keys are ranked.
    """
    ranked = hash_rank(distinct_keys.select(key), key, seed)
    digest = seeded_hash(F.col(key), seed)
    cuts = [F.max(F.when(F.col("hash_rank") <= rank, digest)).alias(name) for name, rank in ranks.items()]
    return ranked.agg(F.struct(*cuts).alias("cuts")).scalar()


def running_totals(distinct: DataFrame, by: Sequence[str], order: str, sums: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Adds ``cum_<s>``: sum of ``s`` over this and all larger values of ``order`` (within ``by``).

    Rows must be distinct in (by, order), so a value that a third of the data
    shares is one row here.  Spark's range partitioning then deals them out
    evenly whatever their distribution; the dealt rows are written once, so
    totals and rows agree on the ranges.
    """
    by = list(by)
    keys = [F.col(c) for c in [*by, order]]
    dealt = distinct.repartitionByRange(ranges, *keys) if ranges else distinct.repartitionByRange(*keys)
    ranged = materialise(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    above = W.partitionBy(*by).orderBy(F.desc("_range")).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_range", *[F.coalesce(F.sum(f"_t_{s}").over(above), F.lit(0)).alias(f"_o_{s}") for s in sums]
    )
    inside = W.partitionBy(*by, "_range").orderBy(F.desc(order)).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = ranged.join(offsets, [*by, "_range"])
    out = out.withColumns({f"cum_{s}": F.sum(s).over(inside) + F.col(f"_o_{s}") for s in sums})
    return out.drop("_range", *[f"_o_{s}" for s in sums])
