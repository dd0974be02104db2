"""Bytes of files, read by the task that needs them.

A listing holds paths and lengths only, so choosing, joining and sampling files moves no bytes.  ``with_content`` comes
last: rows are dealt out by the bytes they stand for, and a task reads its files a bounded number of bytes at a time.
A file that is gone by then fails the task, which is tried again like any other; a null path has null content.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BYTES_AT_ONCE = 64 << 20
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}  # as tasks' readers call them


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of all files below a folder; their bytes aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")


def known_scheme(spark: SparkSession, folder: str) -> bool:
    """Whether tasks can open the folder's files by themselves."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() in SCHEMES


def with_content(files: DataFrame, path: str = "path", length: str = "length") -> DataFrame:
    """Adds ``content``, the bytes of each row's file; in place of a column of that name, if there is one."""
    files = files.drop("content")
    spark = files.sparkSession
    per_task = int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("bB"))
    size = files.agg(F.sum(length)).first()[0] or 0
    # By number, as adaptive execution would put the few bytes of the paths into one task.
    dealt = files.repartition(max(-(-size // per_task), min(spark.sparkContext.defaultParallelism, 1 + size // (1 << 20))), path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        opened = {}

        def content(name: str | None) -> bytes | None:
            if name is None:
                return None
            scheme, _, rest = name.partition(":")
            if scheme not in SCHEMES:
                raise ValueError(f"no reader for {name}")
            if scheme == "file":
                place, inside = "", "/" + rest.lstrip("/")
            else:
                place, _, inside = rest[2:].partition("/")
                inside = f"{place}/{inside}" if SCHEMES[scheme] in ("s3", "gs") else f"/{inside}"
            if (scheme, place) not in opened:
                opened[scheme, place] = fs.LocalFileSystem() if scheme == "file" else fs.FileSystem.from_uri(f"{SCHEMES[scheme]}://{place}/")[0]
            with opened[scheme, place].open_input_stream(inside) as stream:
                return stream.read()

        for batch in batches:
            names, lo, held, bodies = batch.column(path).to_pylist(), 0, 0, []
            for i, name in enumerate(names):
                bodies.append(content(name))
                held += len(bodies[-1] or b"")
                if held >= BYTES_AT_ONCE or i + 1 == len(names):
                    part = batch.slice(lo, len(bodies))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bodies, pa.binary())], names=[*part.schema.names, "content"])
                    lo, held, bodies = i + 1, 0, []

    return dealt.mapInArrow(read, T.StructType([*files.schema, T.StructField("content", T.BinaryType())]))
