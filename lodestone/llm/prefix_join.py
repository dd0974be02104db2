"""Operator 12: Jaccard join of word n-grams by adaptive multi-match prefixes.

A set's shingles are put in one global order, by the number of sets that have
them and then by hash.  Two sets that are similar share at least l shingles
within the first n - ceil(0.8 n) + l of each, for every l; if one has chosen l
and the other m, they share at least min(l, m) within the prefixes chosen.
Every set chooses its own l: a longer prefix meets more lists, but asks for more
shared shingles before a pair is verified, and the choice is the least of
estimated list and verification costs.

Counts come from one exchange: a task cuts the sets it makes into cells by hash
range, packs the cells of some texts into a row, and the task of a range counts
each shingle's sets and sends on only shingles that several sets have.  Sets for
which these are fewer than 0.8 n have no partner and are gone here, which in
most corpora leaves few.  Shingles of one set never match and aren't posted,
though they take up the prefix.

What is asked for is components, so lists don't give all their pairs.  In a
round each list that holds several components has a leader; a set is held
against the leader it shares most lists with, if they share enough.  Sets that
still share a list with another component, and whose sizes and shared shingles
leave a link possible, fall into groups; a group is cut into tiles of bounded
size, every two tiles meet once with their whole sets, and give back links that
join components, at most one per component joined.  Nothing is left out.

Cases: a text without words has no shingles and no links; a text with fewer
words than a shingle is one shingle; texts with equal sets are one set; every
row is judged by its own text, also rows that share a doc_id; a row without a
doc_id takes no part; an empty table gives an empty one; other columns are
ignored.  Equality of 64-bit hashes of words and sets, and of at least 48 bits
of hashes of shingles within a pair, counts as equality.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import arrow_batches, id_and_text, ranges
from lodestone.llm.components import contract, relabel
from lodestone.llm.link_groups import links_in_groups, runs as _runs
from lodestone.llm.near_dups import _shingle_sets as shingle_sets
from lodestone.llm.words import BLANKS, each_slice, mix
from lodestone.session import materialise

SIMILAR = 80  # per cent
MOST_MATCHES = 8  # the longest prefixes asked for
VERIFY = 0.1  # cost of verifying a shingle against that of a list entry
CELL_TEXT = 32 << 20  # bytes of text whose shingles one range gets, on average
CELL_SLICE = 2 << 20  # bytes of text whose cells of a range are a row
ROUNDS = 3

MEMBERS = "doc_id long, n_shingles long, set_id long"
CELLS = "bucket int, sets binary, sizes binary, lengths binary, keys binary"
SHARED = "part int, bucket int, sets binary, sizes binary, lengths binary, keys binary, counts binary"
SETS = "set_id long, n long, shared long, matches long, keys binary, posted array<long>"


def least_overlap(n):
    """Shingles that a set of n and any similar set share at least."""
    return (SIMILAR * n + 99) // 100


def _set_ids(values: np.ndarray, many: np.ndarray) -> np.ndarray:
    out = np.zeros(len(many), np.uint64)
    full = many > 0
    if len(values):
        out[full] = np.add.reduceat(mix(values ^ np.uint64(0xA5A5)), (np.cumsum(many) - many)[full])
    return mix(out + many.astype(np.uint64)).view(np.int64)


def members(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_id) of every row; equal sets have equal ids."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in each_slice(batch["text"], BLANKS, lower=True):
                lo, hi = words.rows
                values, many = shingle_sets(words, width)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), pa.array(many), pa.array(_set_ids(values, many))], ["doc_id", "n_shingles", "set_id"])

    return docs.mapInArrow(digest, MEMBERS)


def _packed(array: np.ndarray, item: int) -> bytes:
    """The low ``item`` bytes of each number."""
    return np.ascontiguousarray(array.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :item]).tobytes()


def _unpacked(raw: bytes, item: int) -> np.ndarray:
    out = np.zeros((len(raw) // item, 8), np.uint8)
    out[:, :item] = np.frombuffer(raw, np.uint8).reshape(-1, item)
    return out.view("<u8").reshape(-1)


def _small(array: np.ndarray) -> bytes:
    """Numbers in as few bytes as the largest needs, which the first byte says; cells grow in number with the data."""
    array = array.astype(np.min_scalar_type(int(array.max(initial=0))))
    return bytes([array.itemsize]) + array.tobytes()


def _large(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def cells(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """The distinct sets' shingles, packed by the top ``bits`` of their hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in each_slice(batch["text"], BLANKS, lower=True, size=CELL_SLICE):
                values, many = shingle_sets(words, width)
                ids = _set_ids(values, many)
                _, first = np.unique(ids, return_index=True)
                first = first[many[first] > 0]
                if not len(first):
                    continue
                values = values[ranges((np.cumsum(many) - many)[first], many[first])]
                row = np.repeat(np.arange(len(first)), many[first])
                bucket = (values >> np.uint64(64 - bits)).astype(np.uint16)
                order = np.argsort(bucket, kind="stable")
                values, row, bucket = values[order], row[order], bucket[order]
                at = _runs(bucket, row)  # cells
                length = np.diff(np.append(at, len(row)))
                heads = _runs(bucket[at])
                ends = np.append(heads[1:], len(at))
                out = [[], [], [], [], []]
                for a, b in zip(heads.tolist(), ends.tolist()):
                    some = values[at[a] : at[b - 1] + length[b - 1]]
                    for column, value in zip(out, (int(bucket[at[a]]), ids[first[row[at[a:b]]]].tobytes(), _small(many[first[row[at[a:b]]]]), _small(length[a:b]), _packed((some << np.uint64(bits)) >> np.uint64(16), 6))):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(c, pa.binary()) for c in out[1:])], ["bucket", "sets", "sizes", "lengths", "keys"])

    return docs.mapInArrow(cut, CELLS)


def _cells_of(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    small = lambda c: np.concatenate([_large(x) for x in group[c].to_pylist()])
    return np.frombuffer(b"".join(group["sets"].to_pylist()), np.int64), small("sizes"), small("lengths"), [x for x in group["keys"].to_pylist()]


def shared_shingles(packed: DataFrame, parts: int) -> DataFrame:
    """Of each hash range, the shingles that several sets have, with how many do, packed by sets."""

    def count(group: pa.Table) -> pa.Table:
        sets, sizes, lengths, raw = _cells_of(group)
        bucket = group["bucket"][0].as_py()
        keys = _unpacked(b"".join(raw), 6)
        _, first = np.unique(sets, return_index=True)  # copies in other batches have equal cells
        keys = keys[ranges((np.cumsum(lengths) - lengths)[first], lengths[first])]
        row = np.repeat(np.arange(len(first), dtype=np.int32), lengths[first])
        order = np.argsort(keys, kind="stable")
        keys, row = keys[order], row[order]
        at = _runs(keys)
        many = np.diff(np.append(at, len(keys)))
        df = np.repeat(many, many)
        some = df > 1
        keys, row, df = keys[some], row[some], df[some]
        part = ((sets[first][row].view(np.uint64) >> np.uint64(8)) % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((row, part))
        keys, row, df, part = keys[order], row[order], df[order], part[order]
        at = _runs(row)
        length = np.diff(np.append(at, len(row)))
        heads = _runs(part[at])
        ends = np.append(heads[1:], len(at))
        out = [[], [], [], [], [], [], []]
        for a, b in zip(heads.tolist(), ends.tolist()):
            where = first[row[at[a:b]]]
            lo, hi = at[a], at[b - 1] + length[b - 1]
            for column, value in zip(out, (int(part[lo]), bucket, sets[where].tobytes(), _small(sizes[where]), _small(length[a:b]), _packed(keys[lo:hi], 6), _small(df[lo:hi]))):
                column.append(value)
        return pa.table([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), *(pa.array(c, pa.binary()) for c in out[2:])], ["part", "bucket", "sets", "sizes", "lengths", "keys", "counts"])

    return packed.groupBy("bucket").applyInArrow(count, SHARED)


def choose_matches(n: int, df: np.ndarray) -> int:
    """How many shared prefix shingles to ask for.  df: ascending numbers of sets of the shingles that are not unique."""
    unique, most = n - len(df), least_overlap(n)
    asks = np.arange(1, min(MOST_MATCHES, most) + 1)
    posted = np.minimum(n - most + asks - unique, len(df))
    met = np.concatenate([[0], np.cumsum(df - 1.0)])[posted]
    return int(asks[np.argmin(met + VERIFY * n * met / asks)])


def possible_sets(shared: DataFrame) -> DataFrame:
    """The sets that may have a partner, with their prefixes."""

    def choose(group: pa.Table) -> pa.Table:
        sets, sizes, lengths, raw = _cells_of(group)
        top = np.repeat(group["bucket"].to_numpy().astype(np.uint64) << np.uint64(48), [len(x) // 6 for x in raw])
        keys, df = _unpacked(b"".join(raw), 6) | top, np.concatenate([_large(x) for x in group["counts"].to_pylist()])
        ids, own = np.unique(sets, return_inverse=True)
        n = np.zeros(len(ids), np.int64)
        n[own] = sizes
        some = np.bincount(own, lengths, len(ids)) >= least_overlap(n)
        row = np.repeat(own, lengths)
        alive = some[row]
        keys, df, row = keys[alive], df[alive], row[alive]
        order = np.lexsort((keys, df, row))
        keys, df, row = keys[order], df[order], row[order]
        at = _runs(row)
        out = [[], [], [], [], [], []]
        for a, b in zip(at.tolist(), np.append(at[1:], len(row)).tolist()):
            size = int(n[row[a]])
            matches = choose_matches(size, df[a:b])
            posted = size - least_overlap(size) + matches - (size - (b - a))
            for column, value in zip(out, (int(ids[row[a]]), size, b - a, matches, np.sort(keys[a:b]).tobytes(), keys[a : min(b, a + posted)].view(np.int64))):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        return pa.table([pa.array(c, k) for c, k in zip(out, kinds)], ["set_id", "n", "shared", "matches", "keys", "posted"])

    return shared.groupBy("part").applyInArrow(choose, SETS)


# ---- links ---------------------------------------------------------------------------------------------------------

# Of sets of n_a and n_b shingles, of which s_a and s_b aren't unique, at most min(s_a, s_b) are shared.
FITS = f"{100 + SIMILAR} * least(s_a, s_b) >= {SIMILAR} * (n_a + n_b)"


def _labelled(posts: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The entries of lists that hold several components."""
    rows = posts.withColumn("label", F.col("set_id"))
    if labels is None:
        return rows
    rows = materialise(relabel(rows, "label", labels), "join-labelled")
    mixed = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("key")
    return rows.join(materialise(mixed, "join-mixed"), "key")


def _leader_pairs(rows: DataFrame, round_: int) -> DataFrame:
    """(a, b): each set and the leader it shares most lists with, of another component, if they share enough."""
    by = F.xxhash64("set_id", F.lit(round_))
    by = F.struct((F.col("shared") / F.col("n")).alias("whole"), by.alias("by")) if not round_ else F.struct(by.alias("by"))
    lead = rows.groupBy("key").agg(F.max_by(F.struct("set_id", "n", "shared", "matches", "label"), by).alias("b"))
    met = rows.join(materialise(lead, "join-leaders"), "key")
    met = met.select(F.col("set_id").alias("a"), "b.set_id", F.col("n").alias("n_a"), F.col("b.n").alias("n_b"), F.col("shared").alias("s_a"), F.col("b.shared").alias("s_b"), F.least("matches", "b.matches").alias("ask"), F.col("label").alias("l_a"), F.col("b.label").alias("l_b"))
    met = met.filter("l_a <> l_b").filter(FITS).groupBy("a", F.col("set_id").alias("b"), "ask").agg(F.count("*").alias("met")).filter("met >= ask")
    return met.groupBy("a").agg(F.max_by("b", F.struct("met", "b")).alias("b"))


def similar(p: np.ndarray, q: np.ndarray, n_p: int, n_q: int) -> bool:
    """Whether two ascending arrays of shingles share enough, of sets of n_p and n_q."""
    both = len(p) + len(q) - len(np.union1d(p, q))
    return 100 * both >= SIMILAR * (n_p + n_q - both)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    for c in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("set_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("keys").alias(f"keys_{c}")), c)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            good = [
                similar(np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64), n_p.as_py(), n_q.as_py())
                for p, q, n_p, n_q in zip(x["keys_a"], x["keys_b"], x["n_a"], x["n_b"])
            ]
            yield pa.RecordBatch.from_arrays([x["a"], x["b"]], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.mapInArrow(verify, "a long, b long")


def _open_sets(rows: DataFrame) -> DataFrame:
    """(key, set_id) of lists that still may hide a link: what the sizes of the others of a list allow.

    ``low`` to ``high`` are the sizes a partner may have.  The list's least and greatest sizes of other
    components would need more than one value each, so the two least and greatest of distinct components are kept.
    """
    rows = rows.withColumns({"low": F.ceil(F.col("n") * SIMILAR / 100), "high": F.floor(F.col("shared") * (100 + SIMILAR) / SIMILAR - F.col("n") + 1e-6)})
    per = rows.groupBy("key", "label").agg(F.min("n").alias("least"), F.max("high").alias("reach"))
    # another component's smallest set, and the farthest reach of another component
    best = per.groupBy("key").agg(F.min_by("label", "least").alias("l1"), F.min("least").alias("m1"), F.max_by("label", "reach").alias("r1"), F.max("reach").alias("x1"))
    best = materialise(best, "join-sizes")
    second = per.join(best, "key").groupBy("key").agg(F.min(F.when(F.col("label") != F.col("l1"), F.col("least"))).alias("m2"), F.max(F.when(F.col("label") != F.col("r1"), F.col("reach"))).alias("x2"))
    bounds = materialise(best.join(second, "key"), "join-bounds")
    smallest = F.when(F.col("label") == F.col("l1"), F.col("m2")).otherwise(F.col("m1"))
    farthest = F.when(F.col("label") == F.col("r1"), F.col("x2")).otherwise(F.col("x1"))
    return rows.join(bounds, "key").filter((smallest <= F.col("high")) & (farthest >= F.col("n"))).select("key", "set_id", "label")


def _links_in_groups(open_: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Links across components among sets that still share lists."""
    nodes = open_.groupBy(F.col("set_id").alias("node")).agg(F.first("label").alias("label"))
    star = open_.join(materialise(open_.groupBy("key").agg(F.min("set_id").alias("b")), "join-stars"), "key").select(F.col("set_id").alias("a"), "b")
    return links_in_groups(nodes, contract(star), sets.select(F.col("set_id").alias("node"), "n", "keys"), SIMILAR)


def jaccard_components(docs: DataFrame, width: int = 5) -> DataFrame:
    """Per row: doc_id, n_shingles, class_id (smallest doc_id with an equal set), component_id (smallest doc_id reachable). Runs jobs."""
    spark = docs.sparkSession
    texts = id_and_text(docs)
    size = texts.filter("doc_id IS NOT NULL").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(16, max(3, int(-(-size // CELL_TEXT)).bit_length()))
    with arrow_batches(spark, 2_000, 16 << 20):
        all_rows = materialise(members(texts, width), "join-members")
        shared = shared_shingles(cells(texts.filter("doc_id IS NOT NULL"), width, bits), 1 << bits)
        sets = materialise(possible_sets(shared), "join-sets")
        posts = sets.select("set_id", "n", "shared", "matches", F.explode("posted").alias("key"))
        lists = materialise(posts.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key"), "join-lists")
        posts = materialise(posts.join(lists, "key"), "join-posts")
        labels = None
        for round_ in range(ROUNDS):
            labels = contract(_verified(_leader_pairs(_labelled(posts, labels), round_), sets), labels)
        open_ = materialise(_open_sets(_labelled(posts, labels)), "join-open-lists")
        links = _links_in_groups(open_, sets)
        labels = labels if links is None else contract(links, labels)

    classes = all_rows.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("rows"))
    classes = materialise(classes, "join-classes")
    found = classes.withColumn("label", F.col("set_id"))
    found = found if labels is None else materialise(relabel(found, "label", labels), "join-found")
    lowest = materialise(found.groupBy("label").agg(F.min("class_id").alias("component_id")), "join-components")
    named = materialise(found.join(lowest, "label").filter("rows > 1 OR component_id <> class_id").select("set_id", "class_id", "component_id"), "join-named")
    own = all_rows.withColumn("set_id", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("set_id")))
    return own.join(named, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id")
    )
