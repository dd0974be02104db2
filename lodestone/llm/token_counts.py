"""Operator 8: token counts of fields or sections, from one encoding of each whole document.

A document is its parts (fields, lines, sections) joined by a separator; a part
owns the separator behind it.  The whole document is encoded once, every token
knows the characters it covers, and the spans are joined with the parts'
intervals.  A token that covers characters of several parts goes to the part
with most of them, the earliest of equals; ``n_crossing`` says how many tokens of a
part were given by that rule.  So the parts' counts add up to the document's.

Cases: a null part is empty; null or no parts give one empty part without
tokens; a null or repeated doc_id is kept; an empty table gives an empty one;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import bounded_batches
from lodestone.llm.hf_bpe import encoder

ROWS_AT_ONCE = 500
COUNTS = "doc_id long, part int, begin long, n_chars long, n_tokens long, n_crossing long"


def token_counts(docs: DataFrame, parts: Column, separator: str, vocabulary: str, pattern: str, id_col: str = "doc_id",
                 encode_special_tokens: bool = True) -> DataFrame:
    """Per document and part: its place in the whole text in characters, and its tokens.  encode_special_tokens: see ``hf_bpe.encoder``."""
    bounded_batches(docs.sparkSession)
    whole = F.when(F.size(parts) > 0, F.transform(parts, lambda p: F.coalesce(p, F.lit(""))))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(whole, F.array(F.lit(""))).alias("parts"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, pattern, offsets=True, encode_special_tokens=encode_special_tokens)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(lo, ROWS_AT_ONCE)
                yield _counts(part["doc_id"], part["parts"], separator, coder)

    return rows.mapInArrow(count, COUNTS)


def _counts(doc_id: pa.Array, parts: pa.Array, separator: str, coder) -> pa.RecordBatch:
    many = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    size = pc.utf8_length(parts.flatten()).to_numpy(zero_copy_only=False).astype(np.int64) + len(separator)
    last = np.cumsum(many) - 1
    size[last] -= len(separator)  # nothing behind the last part
    row = np.repeat(np.arange(len(many)), many)
    end = np.cumsum(size)  # all documents in one line of characters
    start = end - size
    doc_start = start[last - many + 1]

    offsets = np.concatenate([[0], np.cumsum(many)]).astype(np.int32)
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), parts.flatten()), separator)
    _, tokens, begin, stop = coder.rows(whole)
    shift = np.repeat(doc_start, tokens)
    begin, stop = begin.astype(np.int64) + shift, stop.astype(np.int64) + shift
    full = np.flatnonzero(size)  # an empty part holds no character
    owner = full[np.searchsorted(start[full], begin, side="right") - 1] if len(full) else begin
    crossing = np.flatnonzero(stop > end[owner]) if len(begin) else owner
    for t in crossing:
        first = int(owner[t])
        over = range(first, int(np.searchsorted(start, stop[t])))
        shared = [min(int(end[p]), int(stop[t])) - max(int(start[p]), int(begin[t])) for p in over]
        owner[t] = first + int(np.argmax(shared))
    columns = [
        doc_id.take(pa.array(row)),
        pa.array((np.arange(len(row)) - np.repeat(last - many + 1, many)).astype(np.int32)),
        pa.array(start - doc_start[row]),
        pa.array(size),
        pa.array(np.bincount(owner, minlength=len(row)).astype(np.int64)),
        pa.array(np.bincount(owner[crossing], minlength=len(row)).astype(np.int64)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "begin", "n_chars", "n_tokens", "n_crossing"])
