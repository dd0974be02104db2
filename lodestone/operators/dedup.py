"""Duplicates, inserts of unseen rows, and running unique counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions.unions import union_all
from lodestone.session import materialise

BITMAPS_SENT = 1 << 13  # bitmaps of 4 KB that are sent to the tasks at a time


def keep_first(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by ``order`` (which must be unique per key).

    A minimum is combined before the shuffle, so a key that a third of all rows
    share sends one row per task, not all of them.
    """
    key = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.min(F.struct(*order, *rest)).alias("_row")
    fields = [c for c in [*order, *rest] if c not in key]
    kept = df.groupBy(*key).agg(packed).select(*key, *[F.col(f"_row.{c}").alias(c) for c in fields])
    return kept.select(*df.columns)


def dedup_chunks(chunks: DataFrame) -> DataFrame:
    """The first chunk by (doc_id, chunk_index) of each distinct content hash."""
    return keep_first(chunks, "content_hash", ["doc_id", "chunk_index"])


def dedup_stored(chunks: DataFrame) -> DataFrame:
    """``dedup_chunks`` of Parquet files as they lie: what is shuffled doesn't grow with the texts.

    The first pass reads hashes and positions only and marks the survivors in bitmaps, one per file and 32,768 rows.
    The second reads the rows in place and keeps the marked ones.  Bitmaps go to the tasks in groups of neighbouring
    files, a bounded number at a time, so a large table is a union over ranges of its files.

    ``chunks`` must be a scan of Parquet files that stay as they are.  Of rows equal in hash, document and index one stays.
    """
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index") + 1
    places = chunks.select("content_hash", "doc_id", "chunk_index", F.xxhash64(path).alias("_file"), row.alias("_row"))
    first = F.min(F.struct("doc_id", "chunk_index", "_file", "_row")).alias("_first")
    kept = places.groupBy("content_hash").agg(first).select("_first._file", "_first._row")
    marks = kept.groupBy("_file", F.bitmap_bucket_number("_row").alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_row")).alias("_bits")
    )
    files = chunks.select(path.alias("_path"), F.xxhash64(path).alias("_file")).distinct()
    bitmaps = materialise(marks.join(files, "_file"), "dedup-bitmaps")
    groups = _file_groups(files, bitmaps)
    if not groups:
        return chunks.limit(0)
    return union_all(*[_marked(chunks, bitmaps, *group, alone=len(groups) == 1) for group in groups])


def _file_groups(files: DataFrame, bitmaps: DataFrame) -> list[tuple[str, str, int]]:
    """(first path, last path, bitmaps) of neighbouring files; a row per file comes here, as for Spark's own listing."""
    per_file = bitmaps.groupBy("_path").agg(F.count("*").alias("n"))
    groups, seen = [], set()
    for r in files.join(per_file, "_path", "left").fillna(0, ["n"]).orderBy("_path").collect():
        if r["_file"] in seen:
            raise RuntimeError(f"two files share a hash, one of them is {r['_path']}")
        seen.add(r["_file"])
        if groups and groups[-1][2] + r["n"] <= BITMAPS_SENT:
            groups[-1] = (groups[-1][0], r["_path"], groups[-1][2] + r["n"])
        else:
            groups.append((r["_path"], r["_path"], r["n"]))
    return groups


def _marked(chunks: DataFrame, bitmaps: DataFrame, lo: str, hi: str, n: int, alone: bool) -> DataFrame:
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index") + 1
    some, bits = (chunks, bitmaps) if alone else (chunks.filter(path.between(lo, hi)), bitmaps.filter(F.col("_path").between(lo, hi)))
    bits = bits.select(F.col("_file").alias("_f"), F.col("_part").alias("_p"), "_bits")
    if n <= BITMAPS_SENT:  # more are one file's, far beyond what a file should hold
        bits = F.broadcast(bits)
    rows = some.select(F.struct(*chunks.columns).alias("_chunk"), F.xxhash64(path).alias("_file"), row.alias("_row"))
    found = rows.join(bits, (F.col("_file") == F.col("_f")) & (F.bitmap_bucket_number("_row") == F.col("_p")))
    # Bit i of a bitmap is bit i % 8 of its byte i / 8.
    place = F.bitmap_bit_position("_row").cast("int")
    byte = F.conv(F.hex(F.substr("_bits", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return found.filter(F.getbit(byte, place % 8) == 1).select("_chunk.*")


def first_by_term(docs: DataFrame, doc_id: str = "id", order: Sequence[str] = ("term_pos", "pos")) -> DataFrame:
    """A document several searches found belongs to the first of them."""
    return keep_first(docs, doc_id, list(order))


def running_unique(docs: DataFrame, doc_id: str = "id", term_pos: str = "term_pos", pos: str = "pos") -> DataFrame:
    """(term_pos, new_docs, running_total); terms that add nothing are listed with 0."""
    slim = docs.select(doc_id, term_pos, pos)
    firsts = first_by_term(slim, doc_id, [term_pos, pos])
    per_term = (
        union_all(slim.select(term_pos, F.lit(0).alias("n")).distinct(), firsts.select(term_pos, F.lit(1).alias("n")))
        .groupBy(term_pos)
        .agg(F.sum("n").alias("new_docs"))
    )
    # One row per search term is left here, so one ordered window is cheap.
    so_far = W.orderBy(term_pos).rowsBetween(W.unboundedPreceding, W.currentRow)
    return per_term.withColumn("running_total", F.sum("new_docs").over(so_far))


def unseen(batch: DataFrame, stored: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """Rows of the batch to insert: the first per key whose key is not stored."""
    key = [key] if isinstance(key, str) else list(key)
    # Duplicates go first, combined map-side, so a key that fills a third of the
    # batch is one row when the join meets it; the join reuses the partitioning.
    firsts = keep_first(batch, key, order)
    return firsts.join(stored.select(*key), key, "left_anti").select(*batch.columns)


def insert_counts(batch: DataFrame, stored: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """(inserted, skipped, errors) of inserting the batch; a null key is an error."""
    key = [key] if isinstance(key, str) else list(key)
    bad = F.lit(False)
    for c in key:
        bad = bad | F.col(c).isNull()
    per_key = batch.groupBy(*key).agg(F.count("*").alias("n"), F.first(bad).alias("bad"))
    known = stored.select(*key).distinct().withColumn("stored", F.lit(True))
    new = ~F.col("bad") & F.col("stored").isNull()
    return per_key.join(known, key, "left").agg(
        F.count_if(new).alias("inserted"),
        F.coalesce(F.sum(F.when(~F.col("bad"), F.col("n") - new.cast("int"))), F.lit(0)).alias("skipped"),
        F.coalesce(F.sum(F.when(F.col("bad"), F.col("n"))), F.lit(0)).alias("errors"),
    )
