"""Operator 5 learns from every training occurrence and its order (F5)."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from lodestone.llm import mixing_lm
from lodestone.llm.bit_mixing import SLOTS, count
from lodestone.llm.mixing_lm import BEHIND, PRIORS, mixing_scores


def ids(held, many):
    return [i for i in range(10 * many) if (zlib.crc32(str(i).encode()) % 5 == 1) == held][:many]


def corpus(spark):
    trained, held = ids(False, 40), ids(True, 3)
    texts = [(i, "the red fox ran home and slept") for i in trained] + list(zip(held, ["the red fox ran home and slept", "the fox ran red home and slept", "the"])) + [(None, "the red fox"), (trained[0], None)]
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(5), held


def scores(df):
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in df.collect()), key=str)


def test_order_of_words_counts(spark):
    docs, held = corpus(spark)
    got = {r.doc_id: r for r in mixing_scores(docs).collect() if r.held_out}
    learned, shuffled = got[held[0]], got[held[1]]
    assert learned.base_score == shuffled.base_score and learned.n_known == shuffled.n_known
    assert learned.score > shuffled.score + 1


def test_pairs_meet_in_ranges(spark, monkeypatch):
    docs, _ = corpus(spark)
    want = scores(mixing_scores(docs))
    monkeypatch.setattr(mixing_lm, "RANGE_TOKENS", 7)
    monkeypatch.setattr(mixing_lm, "TOKENS_AT_ONCE", 3)
    for a, b in zip(scores(mixing_scores(docs)), want, strict=True):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:])


def test_counts_of_pairs_are_those_of_all_training_texts(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), " ".join(rng.choice(["a", "b", "c", "dd"], rng.integers(0, 9)))) for i in range(60)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).selectExpr("doc_id", "cast(crc32(cast(doc_id as string)) % 5 as int) fold", "text")
    gathered = mixing_lm._gather(texts).filter("unit IS NULL").withColumnRenamed("batch", "own").select("own", "doc_ids", "folds", "n_tokens", "use_unit", "hashes").localCheckpoint()
    counts = {}
    for r in mixing_lm._followed(mixing_lm._pairs(gathered, 3)).collect():
        counts.setdefault(r.own, {})[r.range] = mixing_lm._unpacked(r.counts)
    units = lambda t: [*((" " if k else "") + w for k, w in enumerate(t.split())), None]
    want, alone, by_id = Counter(), Counter(), dict(rows)
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            want.update(zip([0, *units(t)], units(t)))
            alone.update([0, *units(t)][:-1])
    seen = 0
    for r in gathered.collect():
        n = np.array(r.n_tokens)
        keys = mixing_lm._keys(mixing_lm._unpacked(r.use_unit), n, mixing_lm._unpacked(r.hashes))
        found, _ = mixing_lm._distinct(keys, np.zeros(n.sum(), bool))
        have = np.concatenate([x for _, x in sorted(counts[r.own].items())])
        ours = [(v, u) for i in r.doc_ids for v, u in zip([0, *units(by_id[i])], units(by_id[i]))]
        assert have[np.searchsorted(found, keys[0])].tolist() == [want[p] for p in ours]
        assert have[np.searchsorted(found, keys[1])].tolist() == [alone[v] for v, _ in ours]
        seen += len(ours)
    assert seen == sum(len(units(t)) for _, t in rows)


def test_sum_over_documents_against_a_plain_one():
    rng = np.random.default_rng(3)
    n = np.array([5, 0, 1, 12])
    unit = rng.integers(0, 4, n.sum())
    log_p = np.log(rng.dirichlet(np.ones(4)))[unit]
    alone = rng.integers(0, 50, n.sum()).astype(float)
    pair = np.floor(alone * rng.random(n.sum()) * (rng.random(n.sum()) < 0.6))
    got = mixing_lm._refined(log_p, unit, n, pair, alone)
    at = 0
    for d, many in enumerate(n):
        ways = []
        for weight in BEHIND:
            for prior in PRIORS:
                seen, total = Counter(), 0.0
                for i in range(at, at + many):
                    q = (weight * math.exp(log_p[i]) + pair[i]) / (weight + alone[i])
                    total += math.log((prior * q + seen[unit[i]]) / (prior + i - at))
                    seen[unit[i]] += 1
                ways.append(total)
        assert math.isclose(got[d], np.logaddexp.reduce(ways) - math.log(len(ways)), rel_tol=1e-9, abs_tol=1e-9)
        at += many


def test_the_bit_predictor_counts_every_occurrence():
    def counted(units, times):
        counts = np.zeros(2 * SLOTS, np.int64)
        for walk, many in mixing_lm._walks([pa.RecordBatch.from_pydict({"unit": pa.array(units, pa.binary()), "times": pa.array(times, pa.int64())})]):
            count(counts, walk, many)
        return counts

    assert np.array_equal(counted([b" fox\xff", b"the\xff"], [3, 1]), counted([b" fox\xff"] * 3 + [b"the\xff"], [1] * 4))
