"""Operator 9: near-duplicates by an inverted join on signature coordinates.

Texts with equal shingle sets are one class, and its smallest document stands
for it.  A signature has 224 minimum hashes; the first 96 are three to a coordinate.  A document is
posted under each coordinate-value pair of a prefix; documents that share at
least MATCHES of the coordinates must meet in the prefix, so the lists of the
other coordinates are skipped and only looked up for pairs that have met.
Pairs go on with enough matching coordinates and minimum hashes, and are
confirmed on the full shingle sets.

A list never gives all its pairs.  In a round each list that still holds several
components has a leader, the member with the smallest id under the round's
mask, so that the lists of one group mostly have the same; a member of another
component is held against the best of its leaders.  That joins most of a group,
however large it is, with a few pairs per document.  Only lists that hold several
components even after the last round are compared within, in tiles, and only
across components.  A tile pair gives no pairs but a forest that joins what can be
similar; the groups these forests make are compared on full shingle sets, in tiles
again, and give back only links that join components.  A link that this leaves
out joins what is already joined.

At a similarity of exactly 0.8 a coordinate matches with probability 0.512; a
pair then has fewer than MATCHES of 32 with a chance under 1e-6, and fewer than
BASE_MATCHES of the 224 minimum hashes with one of about 3e-6.

Cases: a text without words has no shingles, no links, and is kept; a text with
fewer words than a shingle is one shingle; a null doc_id takes no part and is
kept; rows with equal doc_ids are taken to be repeated rows of one document; an
empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.unions import union_all
from lodestone.llm.common import bounded_batches, id_and_text
from lodestone.llm.components import contract, relabel
from lodestone.llm.id_filter import id_filter, split_rows
from lodestone.llm.link_groups import links_in_groups
from lodestone.llm.words import BLANKS, Words, each_slice, mix, rolling
from lodestone.session import materialise

COORDINATES, PER_COORDINATE = 32, 3
MORE = 128  # minimum hashes beside those of the coordinates
MATCHES = 4  # of the coordinates
BASE_MATCHES = 151  # of all 224 minimum hashes
PREFIX = COORDINATES - MATCHES + 1
SIMILAR = 80  # per cent
TILE = 2_000
MASKS = [0, *np.random.default_rng(0x1EAD).integers(0, 1 << 62, 3).tolist()]  # a round each; the first picks the smallest id

SKETCH = "doc_id long, n_shingles long, e1 long, e2 long, base binary"
ODD = np.random.default_rng(0x5EED).integers(0, 1 << 63, COORDINATES * PER_COORDINATE + MORE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ascending distinct shingle hashes of all rows, how many each row has)."""
    h, sets = rolling(words.h1, width), []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= width:
            sets.append(np.unique(h[a : b - width + 1]))
        elif b > a:
            sets.append(mix(rolling(words.h1[a:b], b - a) ^ np.uint64(b - a)))
        else:
            sets.append(h[:0])
    return np.concatenate([h[:0], *sets]), np.array([len(s) for s in sets], np.int64)


def _coordinates(base: np.ndarray) -> np.ndarray:
    """Rows of minimum hashes to rows of coordinate values."""
    parts = base[:, : COORDINATES * PER_COORDINATE].reshape(len(base), COORDINATES, PER_COORDINATE).astype(np.uint64)
    out = np.zeros(parts.shape[:2], np.uint64)
    for k in range(PER_COORDINATE):
        out = mix(out ^ (parts[:, :, k] + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))
    return out


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """Per document its number of shingles, a digest of their set, and its minimum hashes."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in each_slice(batch["text"], BLANKS, lower=True):
                lo, hi = words.rows
                values, many = _shingle_sets(words, width)
                full = many > 0
                at = (np.cumsum(many) - many)[full]
                base = np.zeros((len(many), len(ODD)), np.uint32)
                sums = np.zeros((2, len(many)), np.uint64)
                if len(values):
                    spread = mix(values)
                    for k, odd in enumerate(ODD):
                        base[full, k] = np.minimum.reduceat(spread * odd, at) >> np.uint64(32)
                    for k in range(2):
                        sums[k, full] = np.add.reduceat(mix(values ^ np.uint64(0xA5A5 + k)), at)
                raw = base.tobytes()
                step = base.itemsize * len(ODD)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo), pa.array(many), *(pa.array(s.view(np.int64)) for s in sums), pa.array([raw[i * step : (i + 1) * step] for i in range(len(many))], pa.binary())],
                    ["doc_id", "n_shingles", "e1", "e2", "base"],
                )

    return docs.mapInArrow(sketch, SKETCH)


def _base(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), len(ODD))


def _postings(reps: DataFrame) -> DataFrame:
    """(key, doc_id): a coordinate and its value, in the prefix."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, PREFIX + 1, dtype=np.uint64))
        for batch in batches:
            keys = mix(_coordinates(_base(batch["base"]))[:, :PREFIX] ^ salt)
            ids = np.repeat(batch["doc_id"].to_numpy(), PREFIX)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids)], ["key", "doc_id"])

    return reps.select("doc_id", "base").mapInArrow(post, "key long, doc_id long")


def _promising(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether pairs can be similar."""
    same = a == b
    matches = same.sum(axis=1)
    coordinates = same[:, : COORDINATES * PER_COORDINATE].reshape(len(a), COORDINATES, PER_COORDINATE).all(axis=2).sum(axis=1)
    size = 100 * np.minimum(na, nb) >= SIMILAR * np.maximum(na, nb)
    return size & (coordinates >= MATCHES) & (matches >= BASE_MATCHES)


def _labelled(shared: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(key, doc_id, label) of the lists that hold several components."""
    rows = shared.withColumn("label", F.col("doc_id"))
    if labels is None:
        return rows
    rows = materialise(relabel(rows, "label", labels), "near-labelled")
    mixed = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    return materialise(rows.join(materialise(mixed.select("key"), "near-mixed"), "key"), "near-labelled")


def _leader_pairs(rows: DataFrame, mask: int, reps: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(a, b): each document and the leader it meets most often, of another component, if they can be similar."""
    masked = F.col("doc_id").bitwiseXOR(F.lit(mask))
    leaders = materialise(rows.groupBy("key").agg(F.min(masked).alias("masked")).select("key", F.col("masked").bitwiseXOR(F.lit(mask)).alias("b")), "near-leaders")
    pairs = rows.join(leaders, "key").filter("doc_id <> b").groupBy(F.col("doc_id").alias("a"), "b", F.col("label").alias("la")).agg(F.count("*").alias("n"))
    if labels is not None:
        pairs = relabel(pairs.withColumn("lb", F.col("b")), "lb", labels).filter("la <> lb").drop("lb")
    # the leader of most of a document's lists
    rank = F.col("n") * (1 << 40) + F.pmod(F.xxhash64("b"), F.lit(1 << 40))
    pairs = materialise(pairs.select("a", "b", rank.alias("rank")), "near-met")
    pairs = pairs.join(pairs.groupBy("a").agg(F.max("rank").alias("rank")), ["a", "rank"]).drop("rank")
    for c in ("a", "b"):
        pairs = pairs.join(reps.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("base").alias(f"base_{c}")), c)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            good = _promising(_base(x["base_a"]), _base(x["base_b"]), x["na"].to_numpy(), x["nb"].to_numpy())
            yield pa.RecordBatch.from_arrays([x["a"], x["b"]], ["a", "b"]).filter(pa.array(good))

    return pairs.mapInArrow(match, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    for c in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("doc_id").alias(c), F.col("shingles").alias(f"set_{c}")), c)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            good = []
            for p, q in zip(x["set_a"], x["set_b"]):
                p, q = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                both = len(p) + len(q) - len(np.union1d(p, q))
                good.append(100 * both >= SIMILAR * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([x["a"], x["b"]], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.mapInArrow(confirm, "a long, b long")


def _sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The full shingle sets of the wanted documents, in ascending order."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in each_slice(batch["text"], BLANKS, lower=True):
                lo, hi = words.rows
                values, many = _shingle_sets(words, width)
                raw, ends = values.tobytes(), np.cumsum(many) * 8
                sets = [raw[e - 8 * n : e] for e, n in zip(ends.tolist(), many.tolist())]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

    return texts.join(wanted, "doc_id").mapInArrow(collect, "doc_id long, shingles binary").dropDuplicates(["doc_id"])


def _across(shared: DataFrame, reps: DataFrame, labels: DataFrame | None) -> DataFrame:
    """What joins the documents that can be similar, of lists that hold several components, across components: a forest per tile pair."""
    rows = _labelled(shared, labels)
    tiles = rows.groupBy("key").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    rows = rows.join(materialise(tiles, "near-tiles"), "key")
    rows = rows.join(reps.select("doc_id", "n_shingles", "base"), "doc_id")
    own = F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int")
    # Each pair of a list's tiles is a group; a tile is in as many groups as the list has tiles.
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.withColumns({"t1": F.least("own", "other"), "t2": F.greatest("own", "other")}).drop("tiles", "other")

    def compare(group: pa.Table) -> pa.Table:
        base, label, own = _base(group["base"].combine_chunks()), group["label"].to_numpy(), group["own"].to_numpy()
        ids, n = group["doc_id"].to_numpy(), group["n_shingles"].to_numpy()
        first, second = group["t1"][0].as_py(), group["t2"][0].as_py()
        key = np.uint64(group["key"][0].as_py() & 0xFFFFFFFFFFFFFFFF)
        salt = mix(np.arange(1, PREFIX + 1, dtype=np.uint64))
        keys = mix(_coordinates(base)[:, :PREFIX] ^ salt)
        left, right = np.flatnonzero(own == first), np.flatnonzero(own == second)
        out, piece = [[], []], np.arange(len(ids))  # piece: which rows the pairs so far join
        for i in left.tolist():
            j = right[(label[right] != label[i]) & ((first != second) | (right > i))]
            if not len(j):
                continue
            # a pair is this list's if no earlier coordinate of the prefix has it
            j = j[keys[i][np.argmax(keys[j] == keys[i], axis=1)] == key]
            j = j[_promising(np.broadcast_to(base[i], (len(j), base.shape[1])), base[j], np.full(len(j), n[i]), n[j])]
            _, new = np.unique(piece[j], return_index=True)
            j = j[new][piece[j[new]] != piece[i]]
            piece[np.isin(piece, piece[j])] = piece[i]
            out[0].append(np.full(len(j), ids[i]))
            out[1].append(ids[j])
        a, b = (np.concatenate([ids[:0], *x]) for x in out)
        return pa.table({"a": a, "b": b})

    return rows.groupBy("key", "t1", "t2").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """Per document: doc_id, n_shingles, class_id (equal shingle sets), component_id (its smallest document), kept."""
    bounded_batches(docs.sparkSession)
    texts = id_and_text(docs)
    all_rows = materialise(sketches(texts, width), "near-sketches")
    sketched = all_rows.filter("doc_id IS NOT NULL AND n_shingles > 0").dropDuplicates(["doc_id"])
    classes = sketched.groupBy("n_shingles", "e1", "e2").agg(F.min("doc_id").alias("class_id"))
    members = materialise(sketched.join(classes, ["n_shingles", "e1", "e2"]).select("doc_id", "class_id"), "near-classes")
    reps = materialise(sketched.join(members.filter("doc_id = class_id").select("doc_id"), "doc_id").select("doc_id", "n_shingles", "base"), "near-reps")

    postings = _postings(reps)
    lists = materialise(postings.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "near-lists")
    shared = materialise(postings.join(lists, "key"), "near-shared")
    sets = materialise(_sets(texts, shared.select("doc_id").distinct(), width), "near-sets")

    labels = None
    for mask in MASKS:
        pairs = _leader_pairs(_labelled(shared, labels), mask, reps, labels)
        labels = contract(_confirmed(pairs, sets), labels)
    # the last links lie within groups of documents that can be similar; groups are compared on full sets
    groups = contract(_across(shared, reps, labels))
    if groups is not None:
        nodes = groups.select("node", F.col("node").alias("label"))
        nodes = nodes if labels is None else materialise(relabel(nodes, "label", labels), "near-open")
        full = sets.select(F.col("doc_id").alias("node"), F.expr("length(shingles) div 8").alias("n"), F.col("shingles").alias("keys"))
        labels = contract(links_in_groups(nodes, groups, full, SIMILAR), labels)

    found = members if labels is None else relabel(members.withColumn("component_id", F.col("class_id")), "component_id", labels)
    found = found.withColumn("component_id", F.col("class_id")) if labels is None else found
    rows = all_rows.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    return rows.select(
        "doc_id",
        "n_shingles",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with all columns."""
    drop = materialise(near_duplicates(docs, width).filter("NOT kept").select(F.col("doc_id").alias("_id")), "near-drop")
    some, others = split_rows(docs, id_filter(drop, "near-drop-ids", "_id"))
    return union_all(some.join(drop, some["doc_id"].cast("long") == drop["_id"], "left_anti"), others)
