"""Multi-label data preparation and metrics on long tables.

Predictions are (item_id, condition, label 0/1, score).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.constants import (
    AUC_FAIR,
    AUC_GOOD,
    CONDITIONS,
    DEFAULT_THRESHOLD,
    MIN_CONFIDENCE,
    NO_FINDING,
    SPLIT_SEED,
    SPLIT_SHARES,
    THRESHOLD_GRID,
)
from lodestone.functions.numbers import settled
from lodestone.functions.unions import union_all
from lodestone.operators.ranking import hash_cuts, hash_share, running_totals, seeded_hash
from lodestone.session import materialise

DIGITS = 6

# ---- data preparation ----


def has_condition(findings: Column, condition: str, substring: bool = False) -> Column:
    """Whether a ``A|B`` findings text names the condition, in either spelling."""
    spellings = sorted({condition, condition.replace("_", " "), condition.replace(" ", "_")})
    if substring:
        tests = [F.contains(findings, F.lit(s)) for s in spellings]
    else:
        parts = F.transform(F.split(findings, r"\|"), F.trim)
        tests = [F.array_contains(parts, s) for s in spellings]
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return F.coalesce(out, F.lit(False))


def multi_hot(df: DataFrame, conditions: Sequence[str] = CONDITIONS, findings: str = "findings", substring: bool = False) -> DataFrame:
    """One 0/1 column per condition."""
    return df.withColumns({c: has_condition(F.col(findings), c, substring).cast("int") for c in conditions})


def multi_hot_long(df: DataFrame, item_id: str, conditions: Sequence[str] = CONDITIONS, findings: str = "findings",
                   substring: bool = False) -> DataFrame:
    """(item_id, condition, label)."""
    pairs = [
        F.struct(F.lit(c).alias("condition"), has_condition(F.col(findings), c, substring).cast("int").alias("label"))
        for c in conditions
    ]
    return df.select(item_id, F.explode(F.array(*pairs)).alias("p")).select(item_id, "p.*")


def split_findings(df: DataFrame, findings: str = "findings") -> tuple[DataFrame, DataFrame]:
    """(rows with a finding, rows without)."""
    none = F.col(findings).eqNullSafe(NO_FINDING)  # an unknown finding isn't none
    return df.filter(~none), df.filter(none)


def downsample_majority(df: DataFrame, item_id: str, findings: str = "findings", seed: int = SPLIT_SEED) -> DataFrame:
    """All rows with a finding and as many of the rest, chosen by seeded hash."""
    positive, negative = split_findings(df, findings)
    wanted = positive.agg(F.count("*").alias("n")).scalar()
    cut = hash_cuts(negative, item_id, seed, last=wanted)["last"]
    return union_all(positive, negative.filter(seeded_hash(F.col(item_id), seed) <= cut))


def split_by_hash(df: DataFrame, group: str, shares: tuple[float, float] = SPLIT_SHARES, seed: int = SPLIT_SEED) -> DataFrame:
    """Adds ``split``; rows of a group stay together.  No shuffle; shares hold on average."""
    place = hash_share(F.col(group), seed)
    split = F.when(place < shares[0], "train").when(place < shares[0] + shares[1], "val").otherwise("test")
    return df.withColumn("split", split)


def split_exact(df: DataFrame, group: str, shares: tuple[float, float] = SPLIT_SHARES, seed: int = SPLIT_SEED) -> DataFrame:
    """As ``split_by_hash`` with exactly int(n * share) groups in train and val."""
    groups = materialise(df.select(group).distinct(), "groups")  # counted, then ranked
    n = groups.agg(F.count("*").alias("n")).scalar()
    train = F.floor(n * F.lit(shares[0]))
    val = train + F.floor(n * F.lit(shares[1]))
    cuts = hash_cuts(groups, group, seed, train=train, val=val)
    digest = seeded_hash(F.col(group), seed)
    split = F.when(digest <= cuts["train"], "train").when(digest <= cuts["val"], "val").otherwise("test")
    return df.withColumn("split", split)


def label_distribution(long_labels: DataFrame) -> DataFrame:
    """(condition, positives, pct) over long (item_id, condition, label)."""
    return long_labels.groupBy("condition").agg(
        F.sum("label").cast("long").alias("positives"), settled(100.0 * F.sum("label") / F.count("*"), 1).alias("pct")
    )


# ---- decisions ----


def apply_thresholds(scores: DataFrame, thresholds: DataFrame | None, default: float = DEFAULT_THRESHOLD, op: str = ">=") -> DataFrame:
    """Adds probability, threshold and detected.  Thresholds are one row per condition."""
    with_t = scores
    if thresholds is not None:
        renamed = thresholds.select(F.replace("condition", F.lit("_"), F.lit(" ")).alias("_name"), F.col("threshold").alias("_t"))
        name = F.replace("condition", F.lit("_"), F.lit(" "))
        with_t = scores.withColumn("_name", name).join(renamed, "_name", "left").drop("_name")
    else:
        with_t = scores.withColumn("_t", F.lit(None).cast("double"))
    t = F.coalesce("_t", F.lit(default))
    hit = F.col("score") >= t if op == ">=" else F.col("score") > t
    return with_t.withColumns(
        {"detected": hit, "probability": settled("score", 4), "threshold": F.round(t, 3)}
    ).drop("_t")


def review_flags(predictions: DataFrame, item_id: str, min_confidence: float = MIN_CONFIDENCE, model_loaded: bool = True) -> DataFrame:
    """Per item: needs_review (too unsure or nothing detected) and the top condition if it was detected."""
    first = F.min(F.struct((-F.col("probability")).alias("p"), "condition", "detected")).alias("_top")
    return (
        predictions.groupBy(item_id)
        .agg(F.max("probability").alias("max_probability"), F.bool_or("detected").alias("_any"), first)
        .select(
            item_id,
            "max_probability",
            (((F.col("max_probability") < min_confidence) | ~F.col("_any")) & F.lit(model_loaded)).alias("needs_review"),
            F.when(F.col("_top.detected"), F.col("_top.condition")).alias("top_condition"),
        )
    )


# ---- metrics ----


def confusion(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD, by: Sequence[str] = ("condition",)) -> DataFrame:
    """(condition, tn, fp, fn, tp); predicted positive strictly above the threshold."""
    hit, real = F.col("score") > threshold, F.col("label") == 1
    return scored.groupBy(*by).agg(
        F.count_if(~hit & ~real).alias("tn"),
        F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & real).alias("fn"),
        F.count_if(hit & real).alias("tp"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def precision_recall_f1(matrix: DataFrame) -> DataFrame:
    """Adds precision, recall, f1 (0 on division by zero) and accuracy."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return matrix.withColumns(
        {
            "precision": settled(_ratio(tp, tp + fp), DIGITS),
            "recall": settled(_ratio(tp, tp + fn), DIGITS),
            "f1": settled(_ratio(2 * tp, 2 * tp + fp + fn), DIGITS),
            "accuracy": settled(_ratio(tp + tn, tp + tn + fp + fn), DIGITS),
        }
    )


def class_matrix(labelled: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """(actual, predicted, n, share of the actual class) for single-label predictions."""
    cells = labelled.groupBy(actual, predicted).agg(F.count("*").alias("n"))
    return cells.withColumn("share", settled(F.col("n") / F.sum("n").over(W.partitionBy(actual)), DIGITS))


def roc_steps(scored: DataFrame, by: Sequence[str] = ("condition",)) -> DataFrame:
    """One row per distinct score: the step of the ROC curve it makes, from the highest score down.

    (pos, neg) at the score, and counts (tp0, fp0) -> (tp, fp) before and after it.
    Runs one pass that counts per distinct score; the steps are worked out from those counts.
    """
    by = list(by)
    real = (F.col("label") == 1).cast("long")
    per_score = scored.groupBy(*by, "score").agg(F.sum(real).alias("pos"), F.sum(1 - real).alias("neg"))
    per_score = materialise(per_score, "scores")
    totals = per_score.groupBy(*by).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    steps = running_totals(per_score, by, "score", ["pos", "neg"]).join(totals, by)
    return steps.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"}).withColumns(
        {"tp0": F.col("tp") - F.col("pos"), "fp0": F.col("fp") - F.col("neg")}
    )


def roc_points(steps: DataFrame, by: Sequence[str] = ("condition",)) -> DataFrame:
    """(condition, score, fpr, tpr) of classes that have both labels; each curve starts at (0, 0), without a score."""
    both = steps.filter("p > 0 AND n > 0")
    points = both.select(
        *by,
        "score",
        settled(F.col("fp") / F.col("n"), DIGITS).alias("fpr"),
        settled(F.col("tp") / F.col("p"), DIGITS).alias("tpr"),
    )
    origin = both.select(*by).distinct().select(*by, F.lit(None).cast("double").alias("score"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return union_all(points, origin)


def roc_auc(steps: DataFrame, by: Sequence[str] = ("condition",)) -> DataFrame:
    """Area under the steps, which is the rank-sum statistic with ties counted half; 0 for a one-label class."""
    area = F.sum(F.col("neg") * (F.col("tp0") + F.col("tp")))
    pairs = 2.0 * F.first("p") * F.first("n")
    return steps.groupBy(*by).agg(
        F.first("p").alias("positives"),
        F.first("n").alias("negatives"),
        settled(F.when(pairs > 0, area / pairs).otherwise(F.lit(0.0)), DIGITS).alias("auc"),
    )


def auc_band(auc: Column) -> Column:
    return F.when(auc >= AUC_GOOD, "good").when(auc >= AUC_FAIR, "fair").otherwise("weak")


def macro_metrics(aucs: DataFrame, f1s: DataFrame) -> DataFrame:
    """Mean AUC over classes whose AUC is not 0, and mean F1 over all classes."""
    joined = f1s.select("condition", "f1").join(aucs.select("condition", "auc"), "condition", "left")
    return joined.agg(
        settled(F.avg(F.when(F.col("auc") > 0, F.col("auc"))), DIGITS).alias("mean_auc"),
        settled(F.avg("f1"), DIGITS).alias("mean_f1"),
    )


def mean_roc(steps: DataFrame, points: int = 100, by: Sequence[str] = ("condition",)) -> DataFrame:
    """(grid, fpr, mean_tpr): the curves read off on an even grid and averaged.

    Each step emits only the grid points it spans, so a class adds ``points``
    rows however many scores it has.  Ends are forced to 0 and 1.
    """
    last = points - 1
    usable = steps.filter("p > 0 AND n > 0")
    # grid points x with fp0/n <= x < fp/n, in whole numbers so that no point is lost or met twice
    lo = F.expr(f"cast((fp0 * {last} + n - 1) div n as int)")
    hi = F.expr(f"cast((fp * {last} + n - 1) div n - 1 as int)")
    none = F.array().cast("array<int>")
    spanned = F.when((F.col("neg") > 0) & (hi >= lo), F.sequence(lo, hi)).otherwise(none)
    is_end = (F.col("tp") == F.col("p")) & (F.col("fp") == F.col("n"))
    ends = F.when(is_end, F.array(F.lit(last))).otherwise(none)
    points_of = usable.withColumn("grid", F.explode(F.concat(spanned, ends)))
    at = (F.col("grid") * F.col("n") / F.lit(float(last)) - F.col("fp0")) / F.col("neg")
    inside = (F.col("tp0") + F.col("pos") * at) / F.col("p")
    curve = points_of.select(*by, "grid", F.when(F.col("grid") == last, F.lit(1.0)).otherwise(inside).alias("tpr"))
    mean = F.when(F.col("grid") == 0, F.lit(0.0)).when(F.col("grid") == last, F.lit(1.0)).otherwise(F.avg("tpr"))
    return curve.groupBy("grid").agg(settled(mean, DIGITS).alias("mean_tpr")).withColumn(
        "fpr", F.round(F.col("grid") / F.lit(float(last)), DIGITS)
    )


def mean_roc_area(curve: DataFrame) -> DataFrame:
    """Trapezoid area of the mean curve (a grid of a hundred rows)."""
    w = W.orderBy("grid")
    width = F.col("fpr") - F.lag("fpr").over(w)
    height = (F.col("mean_tpr") + F.lag("mean_tpr").over(w)) / 2
    return curve.select((width * height).alias("a")).agg(settled(F.sum("a"), 4).alias("mean_auc"))


def log_loss(scored: DataFrame, by: Sequence[str] = ("condition",), clip: float = 1e-7) -> DataFrame:
    p = F.greatest(F.least(F.col("score"), F.lit(1 - clip)), F.lit(clip))
    loss = -F.when(F.col("label") == 1, F.log(p)).otherwise(F.log(1 - p))
    return scored.groupBy(*by).agg(settled(F.avg(loss), DIGITS).alias("log_loss"))


def threshold_value(index: Column, grid: tuple[float, float, int] = THRESHOLD_GRID) -> Column:
    lo, hi, n = grid
    return F.lit(lo) + index * F.lit((hi - lo) / (n - 1))


def threshold_curve(scored: DataFrame, by: Sequence[str] = ("condition",), grid: tuple[float, float, int] = THRESHOLD_GRID) -> DataFrame:
    """(condition, grid, threshold, tp, fp, fn, f1) for score >= threshold.

    Items are first counted by the number of grid thresholds they reach, so the
    search itself runs on at most n + 1 rows per class.
    """
    real = (F.col("label") == 1).cast("long")
    return threshold_counts(scored.withColumns({"pos": real, "neg": 1 - real}), by, grid)


def threshold_counts(weighted: DataFrame, by: Sequence[str], grid: tuple[float, float, int]) -> DataFrame:
    """``threshold_curve`` of rows that stand for ``pos`` and ``neg`` items of a score."""
    by = list(by)
    lo, hi, n = grid
    score = F.col("score")
    guess = F.floor((score - lo) / F.lit((hi - lo) / (n - 1))).cast("int")
    guess = F.greatest(F.least(guess, F.lit(n - 1)), F.lit(-1))
    # settle the last digit with the very comparison that defines a hit
    reached = (
        F.when((guess < n - 1) & (threshold_value(guess + 1, grid) <= score), guess + 1)
        .when((guess >= 0) & (threshold_value(guess, grid) > score), guess - 1)
        .otherwise(guess)
    )
    binned = weighted.groupBy(*by, reached.alias("bin")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    full = (
        binned.select(*by).distinct().withColumn("bin", F.explode(F.sequence(F.lit(-1), F.lit(n - 1))))
        .join(binned, [*by, "bin"], "left").fillna(0, ["pos", "neg"])
    )
    above = W.partitionBy(*by).orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*by)
    counted = full.select(
        *by,
        F.col("bin").alias("grid"),
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        (F.sum("pos").over(whole) - F.sum("pos").over(above)).alias("fn"),
    ).filter("grid >= 0")
    f1 = _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return counted.withColumns({"threshold": threshold_value(F.col("grid"), grid), "f1": settled(f1, DIGITS)})


def best_thresholds(curve: DataFrame, by: Sequence[str] = ("condition",)) -> DataFrame:
    """Threshold with the highest F1 per class, the lowest on a tie."""
    best = F.min(F.struct((-F.col("f1")).alias("_neg"), "grid", "threshold", "f1"))
    return curve.groupBy(*by).agg(best.alias("b")).select(
        *by, F.round("b.threshold", DIGITS).alias("threshold"), F.col("b.f1").alias("best_f1")
    )


def tuning_gain(default_f1: DataFrame, best: DataFrame) -> DataFrame:
    """Mean F1 at the default threshold and after tuning, and the gain in percent."""
    means = default_f1.join(best, "condition").agg(F.avg("f1").alias("b"), F.avg("best_f1").alias("a"))
    return means.select(
        settled("b", DIGITS).alias("mean_f1_default"),
        settled("a", DIGITS).alias("mean_f1_tuned"),
        settled(F.when(F.col("b") > 0, (F.col("a") - F.col("b")) / F.col("b") * 100).otherwise(F.lit(0.0)), 2).alias("gain_pct"),
    )


# ---- training records ----


def best_epoch(history: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Epoch of the lowest val_loss and of the highest val_acc, the earliest on a tie."""
    loss = F.min(F.struct("val_loss", "epoch"))
    acc = F.min(F.struct((-F.col("val_acc")).alias("_neg"), "epoch", "val_acc"))
    return history.groupBy(*by).agg(loss.alias("l"), acc.alias("a")).select(
        *by,
        F.col("l.epoch").alias("best_loss_epoch"),
        F.col("l.val_loss").alias("best_val_loss"),
        F.col("a.epoch").alias("best_acc_epoch"),
        F.col("a.val_acc").alias("best_val_acc"),
    )


def compare_models(results: DataFrame, model: str, metrics: Sequence[str]) -> DataFrame:
    """(model, metric, value_pct, winner): shares are shown in percent, one winner per metric."""
    long = results.unpivot(model, list(metrics), "metric", "value")
    pct = F.when(F.col("value") <= 1.0, F.col("value") * 100).otherwise(F.col("value"))
    shown = long.select(model, "metric", settled(F.coalesce(pct, F.lit(0.0)), 4).alias("value_pct"))
    place = F.row_number().over(W.partitionBy("metric").orderBy(F.desc("value_pct"), model))
    return shown.withColumn("winner", place == 1)
