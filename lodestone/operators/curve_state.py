"""One pass over scored items for every metric of a binary classifier.

The state counts positives and negatives per class and score on a grid of 10^-digits, so it has at most 10^digits + 1
rows per class, is combined before the shuffle, and states of other days or shards add up.  Areas, curves, thresholds,
confusion counts and the loss are read off the state; they are exact where scores have no more digits than the grid,
and ``rounded`` says how many had.  Items without a score or label take no part; a score outside 0 to 1 is an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.constants import DEFAULT_THRESHOLD, THRESHOLD_GRID
from lodestone.functions.numbers import settled
from lodestone.functions.unions import union_all
from lodestone.operators import classifier as cl
from lodestone.operators.classifier import DIGITS
from lodestone.session import materialise

COUNTS = ("pos", "neg", "rounded")


def curve_state(scored: DataFrame, by: Sequence[str] = ("condition",), digits: int = 4) -> DataFrame:
    """(by, score, pos, neg, rounded) of (by, score, label) rows, written once."""
    real, score = (F.col("label") == 1).cast("long"), F.col("score").cast("double")
    valid = F.when(score.between(0, 1), F.round(score, digits)).otherwise(F.raise_error(F.concat(F.lit("not a probability: "), score.cast("string"))))
    counted = scored.filter("score IS NOT NULL AND label IS NOT NULL").select(*by, valid.alias("cell"), real.alias("real"), score.alias("given"))
    state = counted.groupBy(*by, F.col("cell").alias("score")).agg(
        F.sum("real").alias("pos"), F.sum(1 - F.col("real")).alias("neg"), F.count_if(F.col("given") != F.col("cell")).alias("rounded")
    )
    return materialise(state, "curve-state")


def add_states(*states: DataFrame) -> DataFrame:
    """The state of all the items that these states have counted."""
    whole = union_all(*states)
    return whole.groupBy(*[c for c in whole.columns if c not in COUNTS]).agg(*[F.sum(c).alias(c) for c in COUNTS])


def steps(state: DataFrame, by: Sequence[str] = ("condition",)) -> DataFrame:
    """What ``classifier.roc_steps`` gives: the areas and curves there take it.  A class is at most 10^digits + 1 rows."""
    whole = W.partitionBy(*by)
    down = whole.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = {"tp": F.sum("pos").over(down), "fp": F.sum("neg").over(down), "p": F.sum("pos").over(whole), "n": F.sum("neg").over(whole)}
    return state.drop("rounded").withColumns(sums).withColumns({"tp0": F.col("tp") - F.col("pos"), "fp0": F.col("fp") - F.col("neg")})


def confusion(state: DataFrame, threshold: float = DEFAULT_THRESHOLD, by: Sequence[str] = ("condition",)) -> DataFrame:
    """(by, tn, fp, fn, tp); predicted positive strictly above the threshold."""
    hit = F.col("score") > threshold
    cells = {"tn": (~hit, "neg"), "fp": (hit, "neg"), "fn": (~hit, "pos"), "tp": (hit, "pos")}
    return state.groupBy(*by).agg(*[F.sum(F.when(when, F.col(c)).otherwise(0)).alias(name) for name, (when, c) in cells.items()])


def log_loss(state: DataFrame, by: Sequence[str] = ("condition",), clip: float = 1e-7) -> DataFrame:
    p = F.greatest(F.least(F.col("score"), F.lit(1 - clip)), F.lit(clip))
    loss = F.sum(F.col("pos") * -F.log(p) + F.col("neg") * -F.log(1 - p)) / F.sum(F.col("pos") + F.col("neg"))
    return state.groupBy(*by).agg(settled(loss, DIGITS).alias("log_loss"))


def threshold_curve(state: DataFrame, by: Sequence[str] = ("condition",), grid: tuple[float, float, int] = THRESHOLD_GRID) -> DataFrame:
    """(by, grid, threshold, tp, fp, fn, f1) for score >= threshold."""
    return cl.threshold_counts(state, by, grid)


def report(state: DataFrame, by: Sequence[str] = ("condition",), threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """A row per class: labels, area, confusion counts and rates at the threshold, loss, best threshold, rounded scores."""
    by = list(by)
    parts = [
        cl.roc_auc(steps(state, by), by),
        cl.precision_recall_f1(confusion(state, threshold, by)),
        log_loss(state, by),
        cl.best_thresholds(threshold_curve(state, by), by),
        state.groupBy(*by).agg(F.sum("rounded").alias("rounded")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, by)
    return out
