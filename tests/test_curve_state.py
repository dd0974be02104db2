"""Metrics from one mergeable state, and scores of texts."""

import hashlib
import math
import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodestone.operators import classifier as cl
from lodestone.operators import curve_state as cs
from lodestone.operators.text_scores import BUCKETS, SHARPNESS, fit_weights, score_texts, text_buckets

SCHEMA = "condition string, score double, label int"


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    # a third of the rows share a score; one class has positives only
    data = [("a" if i % 2 else "b", 0.5 if i % 3 == 0 else round(rng.random(), 4), rng.randint(0, 1)) for i in range(4000)]
    return spark.createDataFrame(data + [("one", 0.2, 1), ("one", 1.0, 1), ("a", 0.0, 0), ("a", 1.0, 1)], SCHEMA).repartition(5)


def test_equal_to_the_metrics_over_items(scored, rows):
    state = cs.curve_state(scored)
    assert rows(cs.confusion(state)) == rows(cl.confusion(scored))
    assert rows(cs.confusion(state, 0.1234)) == rows(cl.confusion(scored, 0.1234))
    assert rows(cs.log_loss(state)) == rows(cl.log_loss(scored))
    assert rows(cs.threshold_curve(state)) == rows(cl.threshold_curve(scored))
    for read in (cl.roc_auc, cl.roc_points, cl.mean_roc):
        assert rows(read(cs.steps(state))) == rows(read(cl.roc_steps(scored)))
    assert state.agg(F.sum("rounded")).first()[0] == 0
    assert state.groupBy("condition").count().agg(F.max("count")).first()[0] <= 10_001
    report = {r.condition: r for r in cs.report(state).collect()}
    assert set(report) == {"a", "b", "one"} and report["one"].auc == 0 and report["one"].positives == 2


def test_states_of_parts_add_up(scored, rows):
    parts = [cs.curve_state(scored.filter(F.pmod(F.hash("score", "label"), F.lit(3)) == k)) for k in range(3)]
    assert rows(cs.add_states(*parts)) == rows(cs.curve_state(scored))
    assert rows(cs.add_states(parts[0], parts[0].limit(0))) == rows(parts[0])


def test_missing_rounded_and_wrong_scores(spark, rows):
    odd = spark.createDataFrame([("a", 0.12345678, 1), ("a", 0.5, 0), ("a", None, 1), ("a", 0.5, None)], SCHEMA)
    assert rows(cs.curve_state(odd)) == [("a", 0.1235, 1, 0, 1), ("a", 0.5, 0, 1, 0)]
    assert cs.report(cs.curve_state(odd.limit(0))).count() == 0
    with pytest.raises(PySparkException, match="not a probability"):
        cs.curve_state(spark.createDataFrame([("a", 1.5, 1)], SCHEMA))


def test_text_scores_follow_a_plain_version(spark):
    docs = [(1, "Good fine words", 1), (2, "bad bad words", 0), (3, None, 1), (4, "", 0), (5, "1234 --", None), (6, "good BAD", None), (7, "fine " * 3000, 1), (7, "fine " * 3000, 1)]
    bucketed = spark.createDataFrame(docs, "id int, text string, ok int").select("id", "ok", text_buckets(F.col("text")).alias("buckets"))
    got = sorted((r.id, r.condition, r.score, r.label) for r in score_texts(bucketed, fit_weights(bucketed, ["ok"]), ["ok"], ["id"]).collect())

    def of(text):
        return {int(hashlib.md5(w.lower().encode()).hexdigest()[:8], 16) % BUCKETS for w in re.findall("[A-Za-z]+", text or "")}

    def share(b, v):
        return (sum(l == v and b in of(t) for _, t, l in docs) + 1) / (sum(l == v for _, _, l in docs) + 2)

    want = []
    for i, t, l in docs:
        total = sum(round(math.log(share(b, 1) / share(b, 0)) * 10_000) for b in of(t))
        want.append((i, "ok", round(1 / (1 + math.exp(-SHARPNESS * (total / (10_000 * len(of(t))) if of(t) else 0))), 4), l))
    assert got == sorted(want, key=lambda r: r[:3])
    empty = bucketed.limit(0)
    assert score_texts(empty, fit_weights(empty, ["ok"]), ["ok"], ["id"]).count() == 0
