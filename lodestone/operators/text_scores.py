"""Condition scores from texts: averaged log odds of hashed words, fitted and applied in Spark.

A word (letters A to Z, in lower case) falls into one of ``BUCKETS``; a bucket's weight for a condition is the log odds
of the share of positive against negative texts that have it, in whole ten-thousandths, so sums don't depend on their
order.  The model has that fixed size at any corpus and travels as one array per condition.  A text's score is the
logistic of ``SHARPNESS`` times the mean weight of its buckets; without words it is 0.5.  Repeated rows count each
time; rows without a label are scored but not learned from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, UNIT, SHARPNESS = 4096, 10_000.0, 16.0


def text_buckets(text: Column) -> Column:
    """The distinct buckets of a text's words; the same in any engine with md5."""
    words = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("([A-Za-z]+)")), F.lower))
    return F.array_distinct(F.transform(words, lambda w: (F.conv(F.substr(F.md5(w), F.lit(1), F.lit(8)), 16, 10).cast("long") % BUCKETS).cast("int")))


def fit_weights(bucketed: DataFrame, conditions: Sequence[str]) -> DataFrame:
    """One row, an array of BUCKETS whole weights per condition, from (buckets, condition columns of 0, 1 or null)."""
    seen = bucketed.select(*conditions, F.explode("buckets").alias("bucket"))
    per_bucket = seen.groupBy("bucket").agg(*[F.count_if(F.col(c) == v).alias(f"{c}_{v}") for c in conditions for v in (0, 1)])
    totals = bucketed.agg(*[F.count_if(F.col(c) == v).alias(f"{c}_{v}") for c in conditions for v in (0, 1)])

    def share(c: str, v: int) -> Column:
        return (F.col(f"{c}_{v}") + 1) / (totals.select(f"{c}_{v}").scalar() + 2)

    weights = per_bucket.select("bucket", *[F.round(F.log(share(c, 1) / share(c, 0)) * UNIT).cast("long").alias(c) for c in conditions])
    maps = weights.agg(*[F.map_from_entries(F.collect_list(F.struct("bucket", c))).alias(c) for c in conditions])  # at most BUCKETS rows

    def flat(c: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.coalesce(F.try_element_at(F.col(c), b), F.lit(0)))

    return maps.select(*[flat(c).alias(c) for c in conditions])


def score_texts(bucketed: DataFrame, weights: DataFrame, conditions: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep, condition, score, label): a row per text and condition; label is the condition's own column."""
    names = F.array(*[F.struct(F.lit(c).alias("condition"), weights.select(c).scalar().alias("weights"), F.col(c).alias("label")) for c in conditions])
    each = bucketed.select(*keep, "buckets", F.explode(names).alias("_c"))
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda a, b: a + F.get(F.col("_c.weights"), b))
    mean = F.when(F.size("buckets") > 0, total / (UNIT * F.size("buckets"))).otherwise(F.lit(0.0))
    return each.select(*keep, "_c.condition", F.round(1 / (1 + F.exp(-SHARPNESS * mean)), 4).alias("score"), "_c.label")
