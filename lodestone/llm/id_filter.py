"""Rows that may have an id, told from those that can't without a shuffle of the rows.

A bit filter of fixed size is made from the ids and sent to the tasks as a
table of 4 KB chunks.  At any number of ids it only lets through too much, so
a join with the ids themselves follows for what it lets through; the other
rows, whole texts in most cases, stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import materialise

FILTER_BITS = 25  # of the filter's size; 4 MB
CHUNK, BITS = "_chunk of ids", "_bits of ids"


def _place(of: Column) -> Column:
    """A bit's number, from 1 on; null for a null id."""
    return F.when(of.isNotNull(), F.pmod(F.xxhash64(of.cast("long")), F.lit(1 << FILTER_BITS)) + 1)


def id_filter(ids: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """The filter's chunks; combined before the shuffle and written once."""
    place = _place(F.col(id_col))
    chunks = ids.select(place.alias("place")).filter("place IS NOT NULL").groupBy(F.bitmap_bucket_number("place").alias(CHUNK))
    return materialise(chunks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias(BITS)), label)


def split_rows(rows: DataFrame, chunks: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows that may have one of the filter's ids, rows that have none), with the columns of ``rows``; neither is shuffled."""
    place = _place(F.col(id_col))
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substr(F.col(BITS), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    at = rows[id_col]
    looked = rows.join(F.broadcast(chunks), F.bitmap_bucket_number(_place(at)) == chunks[CHUNK], "left")
    may = F.coalesce(F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))
    return looked.filter(may).select(*rows.columns), looked.filter(~may).select(*rows.columns)
