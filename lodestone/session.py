"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Cluster managers set memory, parallelism and spark.checkpoint.dir themselves;
# these are only the settings the operators rely on.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.unionOutputPartitioning": "false",  # see functions/unions.py
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "lodestone", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the session names; a local one only if it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="lodestone-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def materialise(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """The rows, written once to the shared folder and read back, for tables that are read several times.

    Unlike cached blocks the files outlive lost executors.  Without a codec the session's is used.
    """
    path = fresh_dir(df.sparkSession, label)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{checkpoint_root(spark)}/lodestone-{label}-{uuid.uuid4().hex}"
