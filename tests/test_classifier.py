import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import classifier as cl
from lodestone.operators import ranking


def table(spark, classes):
    """{condition: [(label, score)]} as a long table."""
    data = [(i, c, y, float(s)) for c, pairs in classes.items() for i, (y, s) in enumerate(pairs)]
    return spark.createDataFrame(data, "item_id int, condition string, label int, score double")


@pytest.fixture(scope="module")
def random_classes():
    rng = random.Random(1)
    out = {}
    for c in ("a", "b", "c"):
        pairs = []
        for _ in range(700):
            y = int(rng.random() < 0.3)
            # a third of all scores are the same value
            s = 0.5 if rng.random() < 0.33 else round(min(1, max(0, rng.gauss(0.35 + 0.2 * y, 0.2))), 3)
            pairs.append((y, s))
        out[c] = pairs
    return out


def auc_brute(pairs):
    pos = [s for y, s in pairs if y]
    neg = [s for y, s in pairs if not y]
    if not pos or not neg:
        return 0.0
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)


def test_auc_of_plain_cases(spark):
    classes = {
        "perfect": [(1, 0.9), (1, 0.8), (0, 0.2)],
        "inverted": [(1, 0.1), (0, 0.9)],
        "tied": [(1, 0.5), (0, 0.5), (0, 0.5)],
        "single": [(1, 0.4), (1, 0.6)],
    }
    got = {r["condition"]: r["auc"] for r in cl.roc_auc(cl.roc_steps(table(spark, classes))).collect()}
    assert got == {"perfect": 1.0, "inverted": 0.0, "tied": 0.5, "single": 0.0}


def test_auc_against_pairs(spark, random_classes):
    got = {r["condition"]: r["auc"] for r in cl.roc_auc(cl.roc_steps(table(spark, random_classes))).collect()}
    assert got == pytest.approx({c: auc_brute(p) for c, p in random_classes.items()}, abs=2e-6)


def test_macro_leaves_out_zero_auc_only(spark):
    classes = {"good": [(1, 0.9), (0, 0.2)], "single": [(0, 0.4), (0, 0.6)]}
    t = table(spark, classes)
    row = cl.macro_metrics(cl.roc_auc(cl.roc_steps(t)), cl.precision_recall_f1(cl.confusion(t))).first()
    assert tuple(row) == (1.0, 0.5)


def test_mean_roc_against_interpolation(spark, random_classes):
    grid = np.linspace(0, 1, 100)
    curves = []
    for pairs in random_classes.values():
        p = sum(y for y, _ in pairs)
        n = len(pairs) - p
        xs, ys, tp, fp = [0.0], [0.0], 0, 0
        for s in sorted({s for _, s in pairs}, reverse=True):
            tp += sum(y for y, t in pairs if t == s)
            fp += sum(1 - y for y, t in pairs if t == s)
            xs.append(fp / n)
            ys.append(tp / p)
        curve = np.interp(grid, xs, ys)
        curve[0] = 0.0
        curves.append(curve)
    want = np.mean(curves, axis=0)
    want[-1] = 1.0
    got = cl.mean_roc(cl.roc_steps(table(spark, random_classes))).orderBy("grid").collect()
    assert [r["mean_tpr"] for r in got] == pytest.approx(want.tolist(), abs=2e-6)
    area = cl.mean_roc_area(cl.mean_roc(cl.roc_steps(table(spark, random_classes)))).first()[0]
    assert area == pytest.approx(np.trapezoid(want, grid), abs=1e-4)


def test_threshold_is_strict_for_metrics_and_not_for_detection(spark):
    t = table(spark, {"c": [(1, 0.5), (0, 0.5), (1, 0.51), (0, 0.49)]})
    row = cl.precision_recall_f1(cl.confusion(t)).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (2, 0, 1, 1)
    assert (row["precision"], row["recall"], row["accuracy"]) == (1.0, 0.5, 0.75)
    found = cl.apply_thresholds(t, None)
    assert found.filter("detected").count() == 3
    assert cl.apply_thresholds(t, None, op=">").filter("detected").count() == 1


def test_zero_division(spark):
    row = cl.precision_recall_f1(cl.confusion(table(spark, {"c": [(0, 0.1), (0, 0.2)]}))).first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_thresholds_match_both_spellings_and_default(spark):
    scores = spark.createDataFrame(
        [(1, "Pleural Thickening", 0.2), (1, "Mass", 0.2), (1, "Unlisted", 0.5)], "item_id int, condition string, score double"
    )
    limits = spark.createDataFrame([("Pleural_Thickening", 0.15), ("Mass", 0.3)], "condition string, threshold double")
    got = {r["condition"]: (r["detected"], r["threshold"]) for r in cl.apply_thresholds(scores, limits).collect()}
    assert got == {"Pleural Thickening": (True, 0.15), "Mass": (False, 0.3), "Unlisted": (True, 0.5)}


def test_review_flags(spark):
    rows = [
        (1, "A", 0.9, True), (1, "B", 0.1, False),
        (2, "A", 0.4, False), (2, "B", 0.3, False),
        (3, "A", 0.1, True), (3, "B", 0.1, False),
    ]
    p = spark.createDataFrame(rows, "item int, condition string, probability double, detected boolean")
    got = {r["item"]: (r["needs_review"], r["top_condition"]) for r in cl.review_flags(p, "item").collect()}
    assert got == {1: (False, "A"), 2: (True, None), 3: (True, "A")}
    assert cl.review_flags(p, "item", model_loaded=False).filter("needs_review").count() == 0


def f1_at(pairs, t):
    tp = sum(y and s >= t for y, s in pairs)
    fp = sum((not y) and s >= t for y, s in pairs)
    fn = sum(y and s < t for y, s in pairs)
    return 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0


def test_threshold_search_against_every_threshold(spark, random_classes):
    step = (0.95 - 0.05) / 99
    edge = {"edge": [(1, 0.05 + 7 * step), (0, 0.05 + 6 * step), (1, 0.0), (1, 1.0), (0, 0.95)]}
    classes = {**random_classes, **edge}
    curve = cl.threshold_curve(table(spark, classes))
    got = {(r["condition"], r["grid"]): r["f1"] for r in curve.collect()}
    want = {(c, i): f1_at(p, 0.05 + i * step) for c, p in classes.items() for i in range(100)}
    assert got == pytest.approx(want, abs=2e-6)
    for r in cl.best_thresholds(curve).collect():
        best = max(round(f, 6) for (c, _), f in want.items() if c == r["condition"])
        first = min(i for (c, i), f in want.items() if c == r["condition"] and round(f, 6) == best)
        assert r["threshold"] == pytest.approx(0.05 + first * step, abs=1e-6)


def test_log_loss_clips(spark):
    row = cl.log_loss(table(spark, {"c": [(1, 1.0), (0, 0.0), (1, 0.5)]})).first()
    assert row["log_loss"] == pytest.approx(np.log(2) / 3, abs=1e-6)


def test_multi_hot(spark):
    df = spark.createDataFrame(
        [("1", "Pleural_Thickening|Mass"), ("2", "No Finding"), ("3", "Pleural Thickening"), ("4", "Massive")], "item string, findings string"
    )
    conditions = ["Pleural Thickening", "Mass", "Hernia"]
    got = {r["item"]: tuple(r[c] for c in conditions) for r in cl.multi_hot(df, conditions).collect()}
    assert got == {"1": (1, 1, 0), "2": (0, 0, 0), "3": (1, 0, 0), "4": (0, 0, 0)}
    loose = {r["item"]: r["Mass"] for r in cl.multi_hot(df, conditions, substring=True).collect()}
    assert loose["4"] == 1
    dist = {r["condition"]: (r["positives"], r["pct"]) for r in cl.label_distribution(cl.multi_hot_long(df, "item", conditions)).collect()}
    assert dist == {"Pleural Thickening": (2, 50.0), "Mass": (1, 25.0), "Hernia": (0, 0.0)}


def digest(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


def test_downsampling_is_exact_and_repeatable(spark):
    df = spark.createDataFrame([(i, "Mass" if i < 30 else "No Finding") for i in range(200)], "item int, findings string")
    kept = {r["item"] for r in cl.downsample_majority(df, "item").collect()}
    negatives = sorted(range(30, 200), key=lambda i: digest(42, i))[:30]
    assert kept == set(range(30)) | set(negatives)
    assert {r["item"] for r in cl.downsample_majority(df.repartition(7), "item").collect()} == kept
    rare = spark.createDataFrame([(i, "Mass" if i < 30 else "No Finding") for i in range(35)], "item int, findings string")
    assert cl.downsample_majority(rare, "item").count() == 35


def test_splits_keep_groups_whole(spark):
    # one group holds a third of all rows
    rows = [(i, 0 if i % 3 == 0 else i % 10) for i in range(900)]
    df = spark.createDataFrame(rows, "item int, patient int")
    for split in (cl.split_by_hash(df, "patient"), cl.split_exact(df, "patient")):
        got = split.collect()
        assert len(got) == 900
        assert all(len({r["split"] for r in got if r["patient"] == p}) == 1 for p in range(10))
    exact = cl.split_exact(df, "patient").select("patient", "split").distinct().collect()
    assert sorted(r["split"] for r in exact) == ["test"] + ["train"] * 8 + ["val"]
    order = sorted(range(10), key=lambda p: digest(42, p))
    assert {r["patient"] for r in exact if r["split"] == "train"} == set(order[:8])


def test_hash_rank_within_groups(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(300)], "k int, g int")
    got = {(r["g"], r["k"]): r["hash_rank"] for r in ranking.hash_rank(df, "k", 9, ["g"]).collect()}
    for g in range(3):
        order = sorted((k for k in range(300) if k % 3 == g), key=lambda k: digest(9, k))
        assert all(got[g, k] == i for i, k in enumerate(order, 1))


@pytest.mark.parametrize("ranges", [2, 16, 256])
def test_running_totals(spark, ranges):
    rng = random.Random(ranges)
    values = {c: sorted({round(rng.random() ** 6, 5) for _ in range(400)}) for c in "ab"}
    data = [(c, v, rng.randint(0, 9)) for c, vs in values.items() for v in vs]
    df = spark.createDataFrame(data, "c string, v double, n int").repartition(5)
    got = {(r["c"], r["v"]): r["cum_n"] for r in ranking.running_totals(df, ["c"], "v", ["n"], ranges).collect()}
    assert got == {(c, v): sum(m for d, w, m in data if d == c and w >= v) for c, v, _ in data}


def test_best_epoch_and_comparison(spark):
    h = spark.createDataFrame([(1, 0.5, 70.0), (2, 0.3, 80.0), (3, 0.3, 80.0)], "epoch int, val_loss double, val_acc double")
    assert tuple(cl.best_epoch(h).first()) == (2, 0.3, 2, 80.0)
    r = spark.createDataFrame([("a", 0.9, 91.0), ("b", 0.8, 95.0)], "model string, recall double, acc double")
    got = {(x["model"], x["metric"]): (x["value_pct"], x["winner"]) for x in cl.compare_models(r, "model", ["recall", "acc"]).collect()}
    assert got == {("a", "recall"): (90.0, True), ("b", "recall"): (80.0, False), ("a", "acc"): (91.0, False), ("b", "acc"): (95.0, True)}


def test_class_matrix_and_bands(spark):
    df = spark.createDataFrame([("x", "x"), ("x", "y"), ("x", "x"), ("y", "y")], "actual string, predicted string")
    got = {(r["actual"], r["predicted"]): (r["n"], r["share"]) for r in cl.class_matrix(df).collect()}
    assert got == {("x", "x"): (2, 0.666667), ("x", "y"): (1, 0.333333), ("y", "y"): (1, 1.0)}
    bands = spark.createDataFrame([(0.8,), (0.7,), (0.69,)], "auc double").select(cl.auc_band(F.col("auc")))
    assert [r[0] for r in bands.collect()] == ["good", "fair", "weak"]


def test_unknown_findings_are_kept(spark):
    from lodestone.operators.classifier import downsample_majority, split_findings

    rows = spark.createDataFrame([(1, "Mass"), (2, None), (3, "No Finding"), (4, "No Finding"), (5, "No Finding")], "item_id long, findings string")
    positive, negative = split_findings(rows)
    assert ({r.item_id for r in positive.collect()}, negative.count()) == ({1, 2}, 3)
    assert downsample_majority(rows, "item_id").count() == 4
