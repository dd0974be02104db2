"""Operator 5: scoring texts by online logistic context mixing (bit_mixing.py).

Texts are cut into units (blanks and a word, or blanks and the end), and a
task's documents are reduced to their distinct units and the order they come in.
Counts of units and words over all training texts come from one aggregation each,
so a word in every text is one row per task and batch.  The bit predictor counts every
training occurrence and learns from each distinct unit how to spell it without them; its
counts, weights and refinement are sums of what the tasks make of the units, of fixed
size, and go to the driver and back to the tasks.

A unit's probability is its share of all training units, or, with the share of
units seen once as the chance of something new, its spelling.  Behind the unit
before it, the training units that followed that one count against a weight of
this probability.  Over a document it is refined as the document goes on: what
it has held so far counts like training units against a weight of the prior.
Weights of fixed grids are averaged.  All of it is a distribution over texts.
Every distinct unit is spelled once; its score returns to the batches that hold it.

Pairs of neighbours are counted in every training text, by 48 bits of a hash.  A
batch sends its distinct pairs as packed lists, one per range of the hash; the number
of ranges follows the number of tokens, so a range's lists fit a task at any size.

Cases: a null text is empty and has the end as its one token; a null doc_id is
neither held out nor learned from; repeated rows are learned from each time; an
empty table gives an empty one; without training texts every count is zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm import bit_mixing as M
from lodestone.llm.common import bounded_batches, buffers, ranges, spans
from lodestone.llm.words import BASES, BLANKS, each_slice, hash_spans, mix
from lodestone.session import materialise

FOLDS, HELD_OUT = 5, 1
WORD_END, TEXT_END = 0xFF, 0xFE  # bytes that no text has
CHUNK = 1 << 16  # slots in a row of counts
MERGE = 32  # tables added up in one task
PRIORS = tuple(30.0 * 4.0**k for k in range(7))  # weights of the corpus against the document so far, in units
BEHIND = (4.0, 60.0, 900.0)  # weights of a unit's own probability against what followed the unit before, in units
RANGE_TOKENS = 2 << 20  # whose pairs meet in one task
TOKENS_AT_ONCE = 1 << 18
KEY_BITS = 48
START = np.uint64(0x5851F42D4C957F2D)  # stands for the unit before the first

GATHERED = "batch long, place int, unit binary, blanks int, times long, doc_ids array<bigint>, folds array<int>, n_tokens array<int>, use_unit binary, hashes binary"
PAIRS = "range int, batch long, high binary, low binary, times binary"
FOLLOWED = "own long, range int, counts binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def fold(id_col: Column) -> Column:
    return F.coalesce((F.crc32(id_col.cast("string").cast("binary")) % FOLDS).cast("int"), F.lit(-1))


def _units(texts: pa.Array):
    """Per slice of rows: (rows, bytes with marks, unit starts, unit ends, bytes of blanks, row of each unit)."""
    for words in each_slice(texts, BLANKS, lower=True):
        lo, hi = words.rows
        _, at = buffers(texts.slice(lo, hi - lo))
        # a text's units end with its words; one more takes what is left
        stops = np.insert(words.ends, words.first[1:], at[1:])
        word = np.insert(words.starts, words.first[1:], at[1:])
        row = np.repeat(np.arange(hi - lo), words.counts + 1)
        starts = np.concatenate([[0], stops[:-1]]) if len(stops) else stops
        sizes = stops - starts
        last = np.zeros(len(row), bool)
        last[np.cumsum(words.counts + 1) - 1] = True
        marked = np.append(words.data, np.uint8(0))[ranges(starts, sizes + 1)]
        ends = np.cumsum(sizes + 1)
        marked[ends - 1] = np.where(last, TEXT_END, WORD_END)
        yield (lo, hi), marked, ends - sizes - 1, ends, word - starts, row


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers from 0, their bytes of one rank side by side, which compresses well."""
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    ranks = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + len(x).to_bytes(8, "little") + pa.compress(ranks.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    width, n = raw[0], int.from_bytes(raw[1:9], "little")
    out = np.zeros((n, 4 if width <= 4 else 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.decompress(raw[9:], n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u4" if width <= 4 else "<u8")


def _gather(docs: DataFrame) -> DataFrame:
    """A row per batch and distinct unit with its training occurrences, and a row per batch of documents."""
    names = [c.split()[0] for c in GATHERED.split(", ")]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        batch_id = TaskContext.get().partitionId() << 32
        for batch in batches:
            folds = batch["fold"].to_numpy()
            trained = (folds != HELD_OUT) & (folds >= 0)
            hashes, units, blanks, use_unit = [], [], [], []
            known = 0
            n_tokens = np.zeros(batch.num_rows, np.int64)
            for (lo, hi), data, starts, ends, skip, row in _units(batch["text"]):
                n_tokens[lo:hi] = np.bincount(row, minlength=hi - lo)
                h, first, which = np.unique(hash_spans(data, starts, ends)[0], return_index=True, return_inverse=True)
                hashes.append(h)
                sizes = (ends - starts)[first]
                at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                units.append(pa.Array.from_buffers(pa.binary(), len(h), [None, pa.py_buffer(at), pa.py_buffer(data[ranges(starts[first], sizes)])]))
                blanks.append(skip[first])
                use_unit.append((which + known).astype(np.uint32))
                known += len(h)
            if not known:
                continue
            hashes, first, which = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
            units = pa.concat_arrays(units).take(pa.array(first))
            order = pc.sort_indices(units).to_numpy()  # neighbours in order are alike, which packs well
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            use_unit = place[which][np.concatenate(use_unit)]
            n = len(units)
            columns = {
                "batch": pa.array(np.full(n, batch_id)), "place": pa.array(np.arange(n, dtype=np.int32)), "unit": units.take(pa.array(order)),
                "blanks": pa.array(np.concatenate(blanks)[first][order].astype(np.int32)),
                "times": pa.array(np.bincount(use_unit, weights=np.repeat(trained, n_tokens), minlength=n).astype(np.int64)),
            }
            yield pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, t)) for c, t in zip(names, types)], names)
            documents = {
                "batch": pa.array([batch_id]), "doc_ids": pa.array([batch["doc_id"].to_pylist()], types[5]), "folds": pa.array([folds.tolist()], types[6]),
                "n_tokens": pa.array([n_tokens.tolist()], types[7]),
                "use_unit": pa.array([_packed(use_unit)], pa.binary()), "hashes": pa.array([_packed(hashes[order] >> np.uint64(64 - KEY_BITS))], pa.binary()),
            }
            yield pa.RecordBatch.from_arrays([documents.get(c, pa.nulls(1, t)) for c, t in zip(names, types)], names)
            batch_id += 1
            del hashes, units, blanks, use_unit, columns, documents
            pa.default_memory_pool().release_unused()

    types = [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.binary()] * 2]
    return docs.mapInArrow(gather, GATHERED)


def _flat(units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, lengths) of a binary column."""
    lengths = np.array([len(u) for u in units.to_pylist()], np.int64)
    return np.frombuffer(b"".join(units.to_pylist()), np.uint8), np.cumsum(lengths) - lengths, lengths


def _walks(batches: Iterator[pa.RecordBatch]):
    """(walk, times) of the units of batches and their training occurrences."""
    for batch in batches:
        for lo in range(0, batch.num_rows, M.UNITS_AT_ONCE):
            part = batch.slice(lo, M.UNITS_AT_ONCE)
            yield M.Walk(*_flat(part["unit"])), part["times"].to_numpy()


def _added(tables: DataFrame, parts: int) -> DataFrame:
    """Sums packed rows (part, chunk, packed) over the parts, some at a time."""

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.float64) for x in group["packed"])
        return pa.table({"part": group["part"][:1], "chunk": group["chunk"][:1], "packed": pa.array([total.tobytes()], pa.binary())})

    while parts > 1:
        parts = -(-parts // MERGE)
        tables = tables.withColumn("part", F.pmod("part", F.lit(parts)).cast("int")).groupBy("part", "chunk").applyInArrow(add, "part int, chunk int, packed binary")
        tables = materialise(tables, "mixing-tables")
    return tables


def _collected(trained: DataFrame, make) -> np.ndarray:
    """What tasks make of their units, an array of fixed size each, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = make(batches)
        if made is not None:
            for chunk, lo in enumerate(range(0, len(made), CHUNK)):
                columns = [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([chunk], pa.int32()), pa.array([made[lo : lo + CHUNK].astype(np.float64).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "chunk", "packed"])

    tables = materialise(trained.mapInArrow(run, "part int, chunk int, packed binary"), "mixing-parts")
    parts = (tables.agg(F.max("part")).first()[0] or 0) + 1
    rows = _added(tables, max(parts, 2)).orderBy("chunk").toLocalIterator()
    return np.concatenate([np.zeros(0), *(np.frombuffer(r["packed"]) for r in rows)])


def _fit(trained: DataFrame) -> dict:
    """Counts of all contexts; then weights, averaged over the tasks by their occurrences, and outcomes."""
    context = trained.sparkSession.sparkContext

    def count(batches):
        counts, seen = np.zeros(2 * M.SLOTS, np.int64), 0
        for walk, times in _walks(batches):
            M.count(counts, walk, times)
            seen += len(times)
        return counts if seen else None

    counts = _collected(trained, count)
    counts = counts.astype(np.float32) if len(counts) else np.zeros(2 * M.SLOTS, np.float32)
    held = context.broadcast(counts)

    def learn(batches):
        weights, outcomes, seen = M.start_weights(), np.zeros(2 * 256 * M.BUCKETS), 0.0
        for step, (walk, times) in enumerate(_walks(batches)):
            M.learn(held.value, weights, outcomes, walk, times, slower=(1 + step / 4) ** 0.5)
            seen += float(times.sum())
        return np.concatenate([[seen], weights.ravel() * seen, outcomes]) if seen else None

    # in no order: what is learned last must be like what came before
    learned = _collected(trained.sortWithinPartitions(F.xxhash64("unit"), "unit"), learn)
    if not len(learned):
        return {"counts": counts, "weights": M.start_weights(), "refined": M.refinement(np.zeros(2 * 256 * M.BUCKETS))}
    cut = 1 + M.GATES * M.INPUTS
    weights = (learned[1:cut] / learned[0]).reshape(M.INPUTS, M.GATES).astype(np.float32)
    return {"counts": counts, "weights": weights, "refined": M.refinement(learned[cut:])}


def _keys(use_unit: np.ndarray, n_tokens: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key of each token and the unit before it, key of the unit before alone)."""
    before = np.concatenate([[START], hashes[use_unit[:-1]]])
    before[(np.cumsum(n_tokens) - n_tokens)[n_tokens > 0]] = START
    cut = np.uint64(64 - KEY_BITS)
    alone = mix(before ^ np.uint64(BASES[1]))
    return mix(alone * np.uint64(BASES[0]) + hashes[use_unit]) >> cut, alone >> cut


def _pairs(documents: DataFrame, ranges: int) -> DataFrame:
    """A row per batch and range of keys: the distinct keys of its pairs and of their first units, in order, with their training occurrences."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own = {c: batch[c][row].as_py() for c in batch.schema.names}
                n_tokens, folds = np.array(own["n_tokens"], np.int64), np.array(own["folds"])
                keys, times = _distinct(_keys(_unpacked(own["use_unit"]), n_tokens, _unpacked(own["hashes"])), np.repeat((folds != HELD_OUT) & (folds >= 0), n_tokens))
                cuts = np.searchsorted(keys, _bounds(ranges))
                for part, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
                    high = keys[lo:hi] >> np.uint64(16)
                    packed = [_packed(np.diff(high, prepend=np.uint64(0))), _packed(keys[lo:hi] & np.uint64(0xFFFF)), _packed(times[lo:hi])]
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([own["own"]], pa.int64()), *(pa.array([x], pa.binary()) for x in packed)], [c.split()[0] for c in PAIRS.split(", ")])

    return documents.select("own", "folds", "n_tokens", "use_unit", "hashes").mapInArrow(pairs, PAIRS)


def _bounds(ranges: int) -> np.ndarray:
    return np.array([((k << KEY_BITS) + ranges - 1) // ranges for k in range(ranges + 1)], np.uint64)


def _distinct(keys: tuple[np.ndarray, np.ndarray], trained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a batch in order, and the training tokens that have each."""
    both = np.sort(np.concatenate(keys))
    found = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
    del both
    learned = np.sort(np.concatenate([k[trained] for k in keys]))
    return found, np.searchsorted(learned, found, "right") - np.searchsorted(learned, found, "left")


def _followed(pairs: DataFrame) -> DataFrame:
    """Training occurrences, over all batches, of the keys of each batch."""

    def add(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        lists = [(np.cumsum(_unpacked(h).astype(np.uint64), dtype=np.uint64) << np.uint64(16)) | _unpacked(low).astype(np.uint64) for h, low in zip(group["high"].to_pylist(), group["low"].to_pylist())]
        _, which = np.unique(np.concatenate(lists), return_inverse=True)
        counts = np.bincount(which, weights=np.concatenate([_unpacked(x) for x in group["times"].to_pylist()])).astype(np.int64)
        ends = np.cumsum([len(x) for x in lists])
        packed = [_packed(counts[which[end - len(x) : end]]) for x, end in zip(lists, ends)]
        return pa.table({"own": group["batch"], "range": group["range"], "counts": pa.array(packed, pa.binary())})

    return pairs.groupBy("range").applyInArrow(add, FOLLOWED)


def _refined(log_p: np.ndarray, unit: np.ndarray, n: np.ndarray, pair: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Log probability of each document; log_p, unit, and the training occurrences ``pair`` of a token behind the one before, of
    ``alone`` behind that one, are of the tokens in order, ``n`` a document.

    A token has q = (weight * p + pair) / (weight + alone), and seen k times among the i before it (prior * q + k) / (prior + i);
    averaged over BEHIND and PRIORS.
    """
    doc = np.repeat(np.arange(len(n)), n)
    own = doc.astype(np.int64) << 32 | unit
    order = np.argsort(own, kind="stable")
    new = np.concatenate([[True], own[order][1:] != own[order][:-1]]) if len(own) else np.zeros(0, bool)
    k = np.empty(len(own), np.int64)
    k[order] = np.arange(len(own)) - np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
    again, known = np.flatnonzero(k), np.flatnonzero(pair)
    seen, where = k[again], doc[again]
    fresh = np.bincount(doc[k == 0], minlength=len(n))
    below = [np.concatenate([[0], np.cumsum(np.log(prior + np.arange(int(n.max(initial=0)))))])[n] for prior in PRIORS]
    out = []
    for weight in BEHIND:
        log_q = np.log(weight) + log_p
        log_q[known] = np.log(weight * np.exp(log_p[known]) + pair[known])
        log_q -= np.log(weight + alone)
        first = np.bincount(doc, weights=np.where(k == 0, log_q, 0), minlength=len(n))
        q = np.exp(log_q[again])
        for prior, taken in zip(PRIORS, below):
            out.append(first + fresh * np.log(prior) + np.bincount(where, weights=np.log(prior * q + seen), minlength=len(n)) - taken)
    return np.logaddexp.reduce(out, axis=0) - np.log(len(out))


def _returned(held_units: DataFrame, rated: DataFrame) -> DataFrame:
    """The scores of each batch's units.  Place and log_p share a number, as a field more is 8 bytes of every row shuffled."""
    placed = F.shiftleft(F.col("place").cast("long"), 32).bitwiseOR(F.col("log_p_bits").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    return held_units.select("batch", "place", "unit").join(rated, "unit").select("batch", placed.alias("placed"), "c")


def _in_place(rates: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(c, log_p) of a batch's units, in the order of their places."""
    placed, c = rates["placed"].to_numpy(), rates["c"].to_numpy()
    order = np.argsort(placed)
    return c[order], (placed[order] & 0xFFFFFFFF).astype(np.uint32).view(np.float32)


def mixing_scores(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability of the text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8000")  # larger batches repeat fewer units
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold(F.col("doc_id")).alias("fold"), F.coalesce("text", F.lit("")).alias("text"))
    gathered = materialise(_gather(texts), "mixing-gathered", "zstd")
    held_units = gathered.filter("unit IS NOT NULL").select("batch", "place", "unit", "blanks", "times")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "65536")
    units = materialise(held_units.groupBy("unit").agg(F.max("blanks").alias("blanks"), F.sum("times").alias("times")).select("unit", F.expr("substring(unit, blanks + 1)").alias("word"), "times"), "mixing-units")
    words = materialise(units.filter("times > 0").groupBy("word").agg(F.sum("times").alias("c")), "mixing-words")
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = int(total["n"]), int(total["v"])
    new = min(max(units.filter("times = 1").count() / max(n, 1), 1e-4), 1.0) if n else 1.0  # Good and Turing's estimate
    model = spark.sparkContext.broadcast(_fit(units.filter("times > 0").select("unit", "times")))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = M.Scorer(**model.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, M.UNITS_AT_ONCE):
                part = batch.slice(lo, M.UNITS_AT_ONCE)
                c, times = part["c"].to_numpy(), part["times"].to_numpy()
                spelled = np.log(new) + scorer.log10(*_flat(part["unit"])) * np.log(10)
                with np.errstate(divide="ignore"):
                    share = np.log((1 - new) * times / max(n, 1))
                yield pa.RecordBatch.from_arrays([part["unit"], pa.array(c), pa.array(np.logaddexp(share, spelled).astype(np.float32).view(np.int32))], ["unit", "c", "log_p_bits"])

    rated = units.join(words, "word", "left").select("unit", "times", F.coalesce("c", F.lit(0)).cast("long").alias("c"))
    rated = materialise(rated.mapInArrow(rate, "unit binary, c long, log_p_bits int"), "mixing-rated")
    back = _returned(held_units, rated)
    documents = gathered.filter("unit IS NULL").select(F.col("batch").alias("own"), "doc_ids", "folds", "n_tokens", "use_unit", "hashes")
    tokens = documents.agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    followed = _followed(_pairs(documents, -(-tokens // RANGE_TOKENS) or 1))
    columns = [c.split()[0] for c in SCORES.split(", ")]

    def add_up(own: pa.Table, rates: pa.Table) -> pa.Table:
        row = own.filter(pc.is_valid(own["use_unit"])).to_pylist()[0]
        counts = own.filter(pc.is_valid(own["counts"])).sort_by("range")["counts"].to_pylist()
        counts = np.concatenate([_unpacked(x) for x in counts])
        c, log_p = _in_place(rates)
        unit, n_tokens = _unpacked(row["use_unit"]), np.array(row["n_tokens"], np.int64)
        keys = _keys(unit, n_tokens, _unpacked(row["hashes"]))
        found, _ = _distinct(keys, np.zeros(len(unit), bool))
        at = np.concatenate([[0], np.cumsum(n_tokens)])
        known, base, score = np.zeros(len(n_tokens), np.int64), np.zeros(len(n_tokens)), np.zeros(len(n_tokens))
        word = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        for lo, hi in spans(at, TOKENS_AT_ONCE):
            own_units, some = unit[at[lo] : at[hi]], n_tokens[lo:hi]
            doc = np.repeat(np.arange(hi - lo), some)
            known[lo:hi] = np.bincount(doc, weights=(c > 0)[own_units], minlength=hi - lo)
            base[lo:hi] = np.bincount(doc, weights=word[own_units], minlength=hi - lo)
            pair, alone = (counts[np.searchsorted(found, k[at[lo] : at[hi]])].astype(np.float64) for k in keys)
            score[lo:hi] = _refined(log_p.astype(np.float64)[own_units], own_units.astype(np.int64), some, pair, alone) / np.log(10)
        values = [
            pa.array(row["doc_ids"], pa.int64()), pa.array([f == HELD_OUT for f in row["folds"]], pa.bool_()), pa.array(row["n_tokens"], pa.int64()),
            pa.array(known), pa.array(np.full(len(n_tokens), n)), pa.array(base), pa.array(score),
        ]
        return pa.table(dict(zip(columns, values)))

    whole = documents.unionByName(followed, allowMissingColumns=True)
    return whole.groupBy("own").cogroup(back.groupBy("batch")).applyInArrow(add_up, SCORES)
