"""Appending tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*parts: DataFrame) -> DataFrame:
    """UNION ALL by column name.

    Spark 4.1 lets a union of equally partitioned children keep that
    partitioning, and then adaptive execution may coalesce the children
    differently: a following group-by, distinct or window sees a key twice.
    The setting is switched off for the session, which costs at most a shuffle.
    """
    parts[0].sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
