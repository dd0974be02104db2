"""Parquet tables of unique keys into which several writers insert at a time.

Rows lie in a folder per batch and bucket of the key's hash.  A numbered commit file lists the folders that belong to
the table; writing the next number is the only step that changes it, and only one writer can.  Who comes second checks
its rows against the batches committed in between, in the buckets it touches, and tries the next number.

Readers hold the folders of one commit and see neither half a batch nor later ones.  A writer that dies leaves folders
that no commit names; the same batch inserted again adds what is missing.  Commits are as atomic as the file system's
rename without overwriting: on HDFS it is one step, on a local disk a check and a rename.  A null key is an error and
isn't inserted; an empty batch commits nothing; columns a batch lacks are null and those the table lacks are dropped.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.operators.dedup import keep_first

BATCH, BUCKET = "_batch", "_bucket"  # partition columns
BUCKETS = 16  # more make small batches read less of a large table; they don't bound the tasks that write


@dataclass(frozen=True)
class Snapshot:
    """The table after its ``version``-th commit."""

    version: int
    key: list[str]
    buckets: int
    schema: T.StructType | None
    batches: list[str] = field(default_factory=list)


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, key: Sequence[str] = (), buckets: int = BUCKETS):
        """``key`` and ``buckets`` count for a new table; afterwards those of its first commit do."""
        self.spark, self.path, self.new = spark, path.rstrip("/"), Snapshot(0, list(key), buckets, None)
        jvm = spark.sparkContext._jvm
        self._path, self._conf = jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(self._conf)
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        self._renames = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)

    def _names(self, folder: str) -> list[str]:
        at = self._path(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def snapshot(self) -> Snapshot:
        commits = [n for n in self._names("_commits") if n.endswith(".json") and not n.startswith((".", "_"))]
        if not commits:
            return self.new
        said = json.loads(self.spark.read.text(f"{self.path}/_commits/{commits[-1]}", wholetext=True).first()[0])
        return Snapshot(int(commits[-1][:-5]), said["key"], said["buckets"], T.StructType.fromJson(said["schema"]), said["batches"])

    def commit(self, seen: Snapshot, schema: T.StructType, batches: list[str]) -> bool:
        """Whether the table is now ``seen`` with these batches; not, if someone else committed since."""
        held = {"key": seen.key, "buckets": seen.buckets, "schema": json.loads((seen.schema or schema).json()), "batches": batches}
        draft = self._path(f"{self.path}/_commits/_draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(held).encode()))
        out.close()
        try:
            self._files.rename(draft, self._path(f"{self.path}/_commits/{seen.version + 1:020d}.json"), self._renames)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            self._files.delete(draft, False)
            return False
        return True

    def read(self, at: Snapshot | None = None, batches: Sequence[str] | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of a commit, the last if none is named; of some of its batches or buckets only, if those are."""
        at = at or self.snapshot()
        batches = at.batches if batches is None else batches
        if at.schema is None:
            raise ValueError(f"{self.path} has no commit")
        if not batches:
            return self.spark.createDataFrame([], at.schema)
        return self._rows(at.schema, batches, buckets)

    def _rows(self, schema: T.StructType, batches: Sequence[str], buckets: Sequence[int] | None = None) -> DataFrame:
        placed = T.StructType([*schema, T.StructField(BATCH, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        base = f"{self.path}/rows"
        rows = self.spark.read.schema(placed).option("basePath", base).parquet(*[f"{base}/{BATCH}={b}" for b in batches])
        return (rows if buckets is None else rows.filter(F.col(BUCKET).isin(list(buckets)))).drop(BATCH, BUCKET)

    def _drop(self, name: str) -> None:
        """Removes a batch of our own that no commit names."""
        self._fs.delete(self._path(f"{self.path}/rows/{BATCH}={name}"), True)

    def write(self, rows: DataFrame, at: Snapshot) -> tuple[str, int]:
        """(name, rows) of a new batch; it belongs to the table only once it is committed.

        The bucket is the remainder of the hash that Spark itself deals keys out by, so rows that come from a shuffle by
        key lie in few files of each bucket as they are.
        """
        name, wrote = f"b{uuid.uuid4().hex}", Observation()
        bucket = F.pmod(F.hash(*at.key), F.lit(at.buckets)).cast("int")
        counted = rows.withColumn(BUCKET, bucket).observe(wrote, F.count(F.lit(1)).alias("rows"))
        counted.write.partitionBy(BUCKET).parquet(f"{self.path}/rows/{BATCH}={name}")
        return name, wrote.get["rows"]

    def prepare(self, batch: DataFrame, order: Sequence[str], unwritten: Sequence[str] = ()) -> Insert:
        """An insert of the rows whose key the table doesn't hold; the first by ``order`` of a key in the batch stays.

        Without an order the batch must have each key once, and isn't shuffled.
        """
        return Insert(self, batch, list(order), list(unwritten))

    def insert(self, batch: DataFrame, order: Sequence[str], unwritten: Sequence[str] = ()) -> dict[str, int]:
        return self.prepare(batch, order, unwritten).commit()

    def replace(self, change: Callable[[DataFrame], DataFrame], empty: DataFrame) -> int:
        """Puts ``change`` of all rows in their place and returns how many there are; made anew if someone else commits.

        For small tables, such as a registry, whose rows are updated.  ``empty`` gives the columns of a new table.
        """
        while True:
            at = self.snapshot()
            rows = change(self.read(at) if at.schema else empty)
            name, n = self.write(rows.select(*(at.schema or empty.schema).names), at)
            if self.commit(at, empty.schema, [name]):
                return n
            self._drop(name)

    def compact(self) -> int:
        """Writes the table's batches as one, for fewer and larger files; batches committed meanwhile stay beside it."""
        at = self.snapshot()
        if len(at.batches) < 2:
            return at.version
        # Few files per bucket: a task holds whole buckets, a large bucket is split over several.
        bucket = F.pmod(F.hash(*at.key), F.lit(at.buckets))
        name, _ = self.write(self.read(at).withColumn(BUCKET, bucket).hint("rebalance", BUCKET).drop(BUCKET), at)
        merged, now = set(at.batches), at
        while not self.commit(now, now.schema, [name, *[b for b in now.batches if b not in merged]]):
            now = self.snapshot()
            if not merged <= set(now.batches):  # another call was first
                self._drop(name)
                return now.version
        return now.version + 1


class Insert:
    """Rows checked against the table as it was; ``commit`` makes them part of it."""

    def __init__(self, table: KeyedTable, batch: DataFrame, order: list[str], unwritten: list[str]):
        self.table, self.at = table, table.snapshot()
        if not self.at.key:
            raise ValueError("a new table needs a key")
        if not self.at.schema and {BATCH, BUCKET} & set(batch.columns):
            raise ValueError(f"{BATCH} and {BUCKET} are the table's own columns")
        bad = F.lit(False)
        for c in self.at.key:
            bad = bad | F.col(c).isNull()
        read = Observation()
        keyed = batch.observe(read, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad")).filter(~bad)
        firsts = (keep_first(keyed, self.at.key, order) if order else keyed).drop(*unwritten)
        if self.at.schema:
            known = {c: t for c, t in firsts.dtypes}
            firsts = firsts.select(*[(F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.at.schema])
        # Written first: the batch is computed once, and its folders are the buckets it touches.
        self.name, self.n = table.write(firsts, self.at)
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in firsts.schema])
        self.rows, self.errors = read.get["rows"], read.get["bad"]
        self.touched = [int(n.split("=")[1]) for n in table._names(f"rows/{BATCH}={self.name}") if n.startswith(BUCKET)]
        self._check(self.at, self.at.batches)

    def _check(self, at: Snapshot, batches: Sequence[str]) -> None:
        """Leaves out the rows whose key is in these batches; only the key columns of touched buckets are read.

        The rows are written again only if there are such.
        """
        if not self.n or not batches:
            return
        own, stored = self.table._rows(self.schema, [self.name]), self.table.read(at, batches, self.touched).select(*at.key)
        if own.select(*at.key).join(stored, at.key, "left_semi").isEmpty():
            return
        before = self.name
        self.name, self.n = self.table.write(own.join(stored, at.key, "left_anti").select(*own.columns), at)
        self.table._drop(before)

    def commit(self) -> dict[str, int]:
        """inserted, skipped and errors."""
        while self.n and not self.table.commit(self.at, self.schema, [*self.at.batches, self.name]):
            now = self.table.snapshot()
            if (now.key, now.buckets) != (self.at.key, self.at.buckets):
                raise ValueError(f"{self.table.path} was made with the key {now.key} and {now.buckets} buckets meanwhile")
            self._check(now, [b for b in now.batches if b not in self.at.batches])
            self.at = now
        return {"inserted": self.n, "skipped": self.rows - self.errors - self.n, "errors": self.errors}
