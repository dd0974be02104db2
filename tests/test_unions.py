from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions.unions import union_all


def test_distinct_over_equally_partitioned_parts(spark, rows):
    """Parts that come out of the same kind of window must not keep keys apart."""

    def ranked(n, m):
        df = spark.range(n).select((F.col("id") % 40).alias("q"), (F.col("id") % m).alias("d"))
        return df.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy("d"))).filter("r <= 20").select("q", "d")

    a, b = ranked(20_000, 500), ranked(300, 700)
    both = union_all(a, b)
    assert spark.conf.get("spark.sql.unionOutputPartitioning") == "false"
    assert rows(both.distinct()) == sorted({tuple(r) for r in a.collect()} | {tuple(r) for r in b.collect()}, key=repr)
    assert both.groupBy("q").count().count() == 40


def test_missing_columns_become_null(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    assert rows(union_all(a, a.select("k"))) == [(1, "x"), (1, None)]
