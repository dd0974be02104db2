"""Classifier queries: label preparation, decisions, and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.constants import NO_FINDING, THRESHOLD_GRID
from lodestone.functions.numbers import settled
from lodestone.operators import classifier as cl
from lodestone.operators import curve_state as cs
from lodestone.operators.encoding import placeholder_scores
from lodestone.operators.text_scores import BUCKETS, SHARPNESS, fit_weights, score_texts, text_buckets
from lodestone.operators.vector_search import vector_topk
from lodestone.plans.catalog import query
from lodestone.plans.queries_search import CENTROIDS, _predictions
from lodestone.plans.sql import LABEL_SCORES, PREDICTIONS, share
from lodestone.plans.tables import centroids, label_scores, table
from lodestone.session import materialise

FINDINGS = ["Good_Text", "Toxic Text"]


def _findings(spark, sf) -> DataFrame:
    """Labels as one findings text per item."""
    named = F.concat_ws("|", F.when(F.col("quality") == 1, FINDINGS[0]), F.when(F.col("toxic") == 1, FINDINGS[1]))
    return table(spark, sf, "labels").select(
        F.col("doc_id").alias("item_id"), F.coalesce(F.nullif(named, F.lit("")), F.lit(NO_FINDING)).alias("findings")
    )


FINDINGS_SQL = f"""
f AS (SELECT doc_id AS item_id, quality, toxic, CASE WHEN quality = 1 AND toxic = 1 THEN '{FINDINGS[0]}|{FINDINGS[1]}'
  WHEN quality = 1 THEN '{FINDINGS[0]}' WHEN toxic = 1 THEN '{FINDINGS[1]}' ELSE '{NO_FINDING}' END AS findings FROM labels)"""
LONG_SQL = f"""{FINDINGS_SQL}, l AS (SELECT item_id, 'Good Text' AS condition, quality AS label FROM f UNION ALL SELECT item_id, 'Toxic Text', toxic FROM f)"""


@query("labels_multi_hot", f"WITH {FINDINGS_SQL} SELECT item_id, findings, quality AS good_text, toxic AS toxic_text FROM f")
def labels_multi_hot(spark, sf):
    wide = cl.multi_hot(_findings(spark, sf), ["Good Text", "Toxic Text"])
    return wide.withColumnsRenamed({"Good Text": "good_text", "Toxic Text": "toxic_text"})


@query("label_distribution", f"""WITH {LONG_SQL}
SELECT condition, sum(label)::BIGINT AS positives, round(100.0::DOUBLE * sum(label) / count(*) + 1e-9, 1) AS pct FROM l GROUP BY condition""")
def label_distribution(spark, sf):
    return cl.label_distribution(cl.multi_hot_long(_findings(spark, sf), "item_id", ["Good Text", "Toxic Text"]))


@query("downsample_majority", f"""WITH {FINDINGS_SQL}, r AS (
  SELECT *, row_number() OVER (PARTITION BY findings = '{NO_FINDING}' ORDER BY md5('42:' || item_id), item_id) AS pos FROM f)
SELECT item_id, findings FROM r WHERE findings <> '{NO_FINDING}' OR pos <= (SELECT count(*) FROM f WHERE findings <> '{NO_FINDING}')""")
def downsample_majority(spark, sf):
    return cl.downsample_majority(_findings(spark, sf), "item_id")


@query("downsample_toxic", f"""WITH f AS (SELECT doc_id AS item_id, CASE WHEN toxic = 1 THEN 'Toxic' ELSE '{NO_FINDING}' END AS findings FROM labels), r AS (
  SELECT *, row_number() OVER (PARTITION BY findings = '{NO_FINDING}' ORDER BY md5('42:' || item_id), item_id) AS pos FROM f)
SELECT item_id, findings FROM r WHERE findings <> '{NO_FINDING}' OR pos <= (SELECT count(*) FROM f WHERE findings <> '{NO_FINDING}')""")
def downsample_toxic(spark, sf):
    """Here the rows without a finding are the many, so some are left out."""
    found = F.when(F.col("toxic") == 1, "Toxic").otherwise(NO_FINDING)
    return cl.downsample_majority(
        table(spark, sf, "labels").select(F.col("doc_id").alias("item_id"), found.alias("findings")), "item_id"
    )


SPLIT = "CASE WHEN {p} < {a} THEN 'train' WHEN {p} < {b} THEN 'val' ELSE 'test' END"


@query("group_split", f"""WITH s AS (SELECT event_id, user_id, {share('user_id', 42)} AS p FROM events)
SELECT event_id, user_id, {SPLIT.format(p='p', a='0.8::DOUBLE', b='0.8::DOUBLE + 0.1::DOUBLE')} AS split FROM s""")
def group_split(spark, sf):
    return cl.split_by_hash(table(spark, sf, "events").select("event_id", "user_id"), "user_id")


@query("group_split_exact", f"""WITH u AS (SELECT DISTINCT o_custkey FROM orders),
n AS (SELECT floor(count(*) * 0.8::DOUBLE) AS a, floor(count(*) * 0.1::DOUBLE) AS b FROM u),
r AS (SELECT o_custkey, row_number() OVER (ORDER BY md5('42:' || o_custkey), o_custkey) - 1 AS p FROM u)
SELECT o_custkey, count(*) AS n_orders, {SPLIT.format(p='any_value(p)', a='any_value(a)', b='any_value(a + b)')} AS split
FROM orders JOIN r USING (o_custkey), n GROUP BY o_custkey""")
def group_split_exact(spark, sf):
    split = cl.split_exact(table(spark, sf, "orders").select("o_custkey"), "o_custkey")
    return split.groupBy("o_custkey", "split").agg(F.count("*").alias("n_orders"))


CONFUSION_SQL = f"""{LABEL_SCORES}, m AS (
  SELECT condition, count(*) FILTER (WHERE score <= 0.5 AND label = 0) AS tn, count(*) FILTER (WHERE score > 0.5 AND label = 0) AS fp,
         count(*) FILTER (WHERE score <= 0.5 AND label = 1) AS fn, count(*) FILTER (WHERE score > 0.5 AND label = 1) AS tp FROM scored GROUP BY condition),
prf AS (SELECT *, round(CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END + 1e-9, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END + 1e-9, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0 END + 1e-9, 6) AS f1,
  round((tp + tn)::DOUBLE / (tp + tn + fp + fn) + 1e-9, 6) AS accuracy FROM m)"""


@query("confusion", f"WITH {CONFUSION_SQL} SELECT * FROM m")
def confusion(spark, sf):
    return cl.confusion(label_scores(spark, sf))


@query("class_prf", f"WITH {CONFUSION_SQL} SELECT * FROM prf")
def class_prf(spark, sf):
    return cl.precision_recall_f1(cl.confusion(label_scores(spark, sf)))


@query("class_matrix", f"""WITH {CENTROIDS},
s AS (SELECT vec_id, e.label AS actual, c.label AS predicted, round(list_cosine_similarity(v, cv), 6) AS sim FROM e, c),
p AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, predicted) = 1)
SELECT actual, predicted, count(*) AS n, round(count(*) / (sum(count(*)) OVER (PARTITION BY actual))::DOUBLE + 1e-9, 6) AS share FROM p GROUP BY actual, predicted""")
def class_matrix(spark, sf):
    items = table(spark, sf, "embeddings")
    classes = centroids(items, "label").select(F.col("label").alias("predicted"), F.col("vector").alias("embedding"))
    queries = items.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    nearest = vector_topk(classes, queries, ["predicted"], 1)
    truth = items.select(F.col("vec_id").alias("query_id"), F.col("label").alias("actual"))
    return cl.class_matrix(nearest.join(truth, "query_id"))


# Pair counting, a second way to the same area.
AUC_SQL = f"""{LABEL_SCORES}, auc AS (
  SELECT t.condition, t.positives, t.negatives, round(CASE WHEN pairs > 0 THEN won / pairs ELSE 0 END + 1e-9, 6) AS auc FROM (
    SELECT condition, sum(label)::BIGINT AS positives, sum(1 - label)::BIGINT AS negatives, sum(label)::DOUBLE * sum(1 - label) AS pairs FROM scored GROUP BY condition) t
  LEFT JOIN (SELECT a.condition, sum(CASE WHEN a.score > b.score THEN 1.0::DOUBLE WHEN a.score = b.score THEN 0.5 ELSE 0 END) AS won
    FROM scored a JOIN scored b ON a.condition = b.condition AND a.label = 1 AND b.label = 0 GROUP BY a.condition) w USING (condition))"""


@query("roc_auc", f"WITH {AUC_SQL} SELECT *, CASE WHEN auc >= 0.8 THEN 'good' WHEN auc >= 0.7 THEN 'fair' ELSE 'weak' END AS band FROM auc")
def roc_auc(spark, sf):
    return cl.roc_auc(cl.roc_steps(label_scores(spark, sf))).withColumn("band", cl.auc_band(F.col("auc")))


@query("macro_metrics", f"""WITH {AUC_SQL}, {CONFUSION_SQL.split(', m AS', 1)[1].join(['m AS', ''])}
SELECT round(avg(CASE WHEN auc > 0 THEN auc END) + 1e-9, 6) AS mean_auc, round(avg(f1) + 1e-9, 6) AS mean_f1 FROM prf JOIN auc USING (condition)""")
def macro_metrics(spark, sf):
    scored = label_scores(spark, sf)
    return cl.macro_metrics(cl.roc_auc(cl.roc_steps(scored)), cl.precision_recall_f1(cl.confusion(scored)))


STEPS_SQL = f"""{LABEL_SCORES},
g AS (SELECT condition, score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY condition, score),
st AS MATERIALIZED (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY condition) AS p, sum(neg) OVER (PARTITION BY condition) AS n
  FROM g WINDOW w AS (PARTITION BY condition ORDER BY score DESC))"""


@query("roc_points", f"WITH {STEPS_SQL} SELECT condition, score, round(fp::DOUBLE / n + 1e-9, 6) AS fpr, round(tp::DOUBLE / p + 1e-9, 6) AS tpr FROM st UNION ALL SELECT DISTINCT condition, NULL, 0.0::DOUBLE, 0.0::DOUBLE FROM st")
def roc_points(spark, sf):
    return cl.roc_points(cl.roc_steps(label_scores(spark, sf)))


MEAN_ROC_SQL = f"""{STEPS_SQL},
grid AS (SELECT unnest(range(0, 100)) AS i),
pts AS (SELECT condition, fp, tp, p, n, score FROM st UNION ALL SELECT condition, 0, 0, any_value(p), any_value(n), 2 FROM st GROUP BY condition),
seg AS (SELECT condition, p, n, fp AS f1, tp AS t1, lag(fp) OVER w AS f0, lag(tp) OVER w AS t0 FROM pts WINDOW w AS (PARTITION BY condition ORDER BY score DESC)),
rd AS (
  SELECT i, (t0 + (t1 - t0) * (i * n / 99.0::DOUBLE - f0) / (f1 - f0)) / p AS tpr FROM seg, grid WHERE f1 > f0 AND i * n >= f0 * 99 AND i * n < f1 * 99
  UNION ALL SELECT 99, 1.0::DOUBLE FROM (SELECT DISTINCT condition FROM st)),
curve AS (
  SELECT i::INTEGER AS grid, round(i / 99.0::DOUBLE, 6) AS fpr, round(CASE WHEN i = 0 THEN 0.0::DOUBLE WHEN i = 99 THEN 1.0 ELSE avg(tpr) END + 1e-9, 6) AS mean_tpr FROM rd GROUP BY i)"""


@query("mean_roc", f"WITH {MEAN_ROC_SQL} SELECT * FROM curve")
def mean_roc(spark, sf):
    return cl.mean_roc(cl.roc_steps(label_scores(spark, sf)))


@query("mean_roc_area", f"""WITH {MEAN_ROC_SQL}
SELECT round(sum(a) + 1e-9, 4) AS mean_auc FROM (SELECT (fpr - lag(fpr) OVER (ORDER BY grid)) * (mean_tpr + lag(mean_tpr) OVER (ORDER BY grid)) / 2 AS a FROM curve)""")
def mean_roc_area(spark, sf):
    return cl.mean_roc_area(cl.mean_roc(cl.roc_steps(label_scores(spark, sf))))


@query("log_loss", f"""WITH {LABEL_SCORES}
SELECT condition, round(avg(-CASE WHEN label = 1 THEN ln(p) ELSE ln(1 - p) END) + 1e-9, 6) AS log_loss
FROM (SELECT condition, label, greatest(least(score, 1 - 1e-7::DOUBLE), 1e-7::DOUBLE) AS p FROM scored) GROUP BY condition""")
def log_loss(spark, sf):
    return cl.log_loss(label_scores(spark, sf))


STEP = repr((THRESHOLD_GRID[1] - THRESHOLD_GRID[0]) / (THRESHOLD_GRID[2] - 1))
CURVE_SQL = f"""
tg AS (SELECT i AS grid, 0.05::DOUBLE + i * {STEP}::DOUBLE AS threshold FROM (SELECT unnest(range(0, 100)) AS i)),
cnt AS (
  SELECT condition, grid, threshold, count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp,
         count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp, count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn
  FROM scored, tg GROUP BY ALL),
cv AS (SELECT *, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0 END + 1e-9, 6) AS f1 FROM cnt),
bt AS (SELECT condition, round(threshold, 6) AS threshold, f1 AS best_f1 FROM cv QUALIFY row_number() OVER (PARTITION BY condition ORDER BY f1 DESC, grid) = 1)"""


@query("threshold_curve", f"WITH {LABEL_SCORES}, {CURVE_SQL} SELECT condition, grid::INTEGER AS grid, round(threshold, 6) AS threshold, tp, fp, fn, f1 FROM cv")
def threshold_curve(spark, sf):
    return cl.threshold_curve(label_scores(spark, sf)).withColumn("threshold", F.round("threshold", 6))


@query("best_threshold", f"WITH {LABEL_SCORES}, {CURVE_SQL} SELECT * FROM bt")
def best_threshold(spark, sf):
    return cl.best_thresholds(cl.threshold_curve(label_scores(spark, sf)))


@query("tuning_gain", f"""WITH {CONFUSION_SQL}, {CURVE_SQL}
SELECT round(avg(f1) + 1e-9, 6) AS mean_f1_default, round(avg(best_f1) + 1e-9, 6) AS mean_f1_tuned,
       round(CASE WHEN avg(f1) > 0 THEN (avg(best_f1) - avg(f1)) / avg(f1) * 100 ELSE 0 END + 1e-9, 2) AS gain_pct FROM prf JOIN bt USING (condition)""")
def tuning_gain(spark, sf):
    scored = label_scores(spark, sf)
    f1s = cl.precision_recall_f1(cl.confusion(scored))
    return cl.tuning_gain(f1s, cl.best_thresholds(cl.threshold_curve(scored)))


REPORT_SQL = f"""ll AS (SELECT condition, round(avg(-CASE WHEN label = 1 THEN ln(p) ELSE ln(1 - p) END) + 1e-9, 6) AS log_loss
  FROM (SELECT condition, label, greatest(least(score, 1 - 1e-7::DOUBLE), 1e-7::DOUBLE) AS p FROM scored) GROUP BY condition)
SELECT condition, positives, negatives, auc, tn, fp, fn, tp, precision, recall, f1, accuracy, log_loss, threshold, best_f1, 0::BIGINT AS rounded
FROM auc JOIN prf USING (condition) JOIN ll USING (condition) JOIN bt USING (condition)"""
AFTER_SCORES = f"{AUC_SQL.removeprefix(LABEL_SCORES)}{CONFUSION_SQL.removeprefix(LABEL_SCORES)}, {CURVE_SQL}, {REPORT_SQL}"


@query("curve_report", f"WITH {LABEL_SCORES}{AFTER_SCORES}")
def curve_report(spark, sf):
    """Every metric from one pass; the state is the sum of those of even and odd documents."""
    scored = label_scores(spark, sf)
    return cs.report(cs.add_states(*[cs.curve_state(scored.filter(F.col("item_id") % 2 == r)) for r in (0, 1)]))


TEXT_CONDITIONS = ["quality", "toxic"]
TEXT_SCORES = f"""
w AS MATERIALIZED (
  SELECT doc_id, quality, toxic, list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+'),
    lambda x: ((('0x' || substr(md5(lower(x)), 1, 8))::BIGINT) % {BUCKETS})::INTEGER)) AS buckets FROM documents LEFT JOIN labels USING (doc_id)),
x AS (SELECT quality, toxic, unnest(buckets) AS bucket FROM w),
weights AS MATERIALIZED (
  SELECT bucket, c AS condition, round(ln(((count(*) FILTER (WHERE v = 1) + 1)::DOUBLE / (any_value(p) + 2)) / ((count(*) FILTER (WHERE v = 0) + 1)::DOUBLE / (any_value(n) + 2))) * 10000)::BIGINT AS weight
  FROM (SELECT bucket, unnest(['quality', 'toxic']) AS c, unnest([quality, toxic]) AS v FROM x)
  JOIN (SELECT unnest(['quality', 'toxic']) AS c, unnest([sum((quality = 1)::INT), sum((toxic = 1)::INT)]) AS p, unnest([sum((quality = 0)::INT), sum((toxic = 0)::INT)]) AS n FROM w) USING (c)
  GROUP BY bucket, c),
all_scores AS (
  SELECT doc_id AS item_id, condition, label, round(1 / (1 + exp(-{SHARPNESS}::DOUBLE * coalesce(total / (10000.0::DOUBLE * m), 0))), 4) AS score FROM (
    SELECT doc_id, d.condition, any_value(label) AS label, any_value(m) AS m, sum(weight) AS total FROM (
      SELECT doc_id, len(buckets) AS m, unnest(['quality', 'toxic']) AS condition, unnest([quality, toxic]) AS label, buckets FROM w) d
    LEFT JOIN (SELECT doc_id AS id, unnest(buckets) AS bucket FROM w) b ON b.id = doc_id
    LEFT JOIN weights k ON k.bucket = b.bucket AND k.condition = d.condition GROUP BY doc_id, d.condition)),
scored AS MATERIALIZED (SELECT * FROM all_scores WHERE label IS NOT NULL)"""


def _text_scores(spark, sf) -> DataFrame:
    """(item_id, condition, score, label) of all documents: what their words say, and what the label table says, if anything."""
    labels = table(spark, sf, "labels").select("doc_id", *TEXT_CONDITIONS)
    docs = table(spark, sf, "documents").select("doc_id", text_buckets(F.col("text")).alias("buckets"))
    bucketed = materialise(docs.join(labels, "doc_id", "left").withColumnRenamed("doc_id", "item_id"), "text-buckets")
    weights = materialise(fit_weights(bucketed, TEXT_CONDITIONS), "text-weights")
    return score_texts(bucketed, weights, TEXT_CONDITIONS, ["item_id"])


@query("text_scores", f"WITH {TEXT_SCORES} SELECT item_id, condition, score, label FROM all_scores")
def text_scores(spark, sf):
    return _text_scores(spark, sf)


@query("text_curve_report", f"WITH {TEXT_SCORES}{AFTER_SCORES}")
def text_curve_report(spark, sf):
    """The metrics of scores that come from the texts themselves."""
    return cs.report(cs.curve_state(_text_scores(spark, sf)))


@query("text_mean_roc", f"WITH {TEXT_SCORES}{MEAN_ROC_SQL.removeprefix(LABEL_SCORES)} SELECT * FROM curve")
def text_mean_roc(spark, sf):
    return cl.mean_roc(cs.steps(cs.curve_state(_text_scores(spark, sf))))


@query("apply_thresholds", f"WITH {PREDICTIONS} SELECT item_id, condition, probability, threshold, detected FROM pred")
def apply_thresholds(spark, sf):
    return _predictions(spark, sf).select("item_id", "condition", "probability", "threshold", "detected")


@query("sorted_predictions", f"""WITH {PREDICTIONS}
SELECT item_id, string_agg(condition || '=' || printf('%.4f', probability), ' ' ORDER BY probability DESC, condition) AS predictions FROM pred GROUP BY item_id""")
def sorted_predictions(spark, sf):
    from lodestone.operators.prompts import findings_per_item

    per_item = findings_per_item(_predictions(spark, sf), "item_id")
    shown = F.transform("predictions", lambda p: F.concat(p["condition"], F.lit("="), F.format_string("%.4f", p["probability"])))
    return per_item.select("item_id", F.array_join(shown, " ").alias("predictions"))


@query("needs_review", f"""WITH {PREDICTIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY probability DESC, condition) AS pos FROM pred)
SELECT item_id, max(probability) AS max_probability, max(probability) < 0.15::DOUBLE OR NOT bool_or(detected) AS needs_review,
       min(condition) FILTER (WHERE pos = 1 AND detected) AS top_condition FROM r GROUP BY item_id""")
def needs_review(spark, sf):
    return cl.review_flags(_predictions(spark, sf), "item_id")


@query("placeholder_predictions", f"""WITH {PREDICTIONS}
SELECT item_id, condition, 0.0::DOUBLE AS probability, FALSE AS detected, 0.5::DOUBLE AS threshold FROM pred""")
def placeholder_predictions(spark, sf):
    return placeholder_scores(table(spark, sf, "labels").select(F.col("doc_id").alias("item_id")), "item_id")


HISTORY_SQL = """history AS (
  SELECT event_type AS model, extract(day FROM ts)::INTEGER AS epoch, round(avg(value) + 1e-9, 6) AS val_loss,
         round(avg(CASE WHEN value > 10 THEN 1.0::DOUBLE ELSE 0 END) + 1e-9, 6) AS val_acc FROM events GROUP BY ALL)"""


def _history(spark, sf) -> DataFrame:
    """Days as epochs of one training run per event type."""
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("model"), F.dayofmonth("ts").alias("epoch")).agg(
        settled(F.avg("value"), 6).alias("val_loss"),
        settled(F.avg((F.col("value") > 10).cast("double")), 6).alias("val_acc"),
    )


@query("best_epoch", f"""WITH {HISTORY_SQL},
l AS (SELECT model, epoch AS best_loss_epoch, val_loss AS best_val_loss FROM history QUALIFY row_number() OVER (PARTITION BY model ORDER BY val_loss, epoch) = 1),
a AS (SELECT model, epoch AS best_acc_epoch, val_acc AS best_val_acc FROM history QUALIFY row_number() OVER (PARTITION BY model ORDER BY val_acc DESC, epoch) = 1)
SELECT * FROM l JOIN a USING (model)""")
def best_epoch(spark, sf):
    return cl.best_epoch(_history(spark, sf), ["model"])


@query("model_compare", f"""WITH {HISTORY_SQL}, r AS (SELECT model, round(avg(val_loss) + 1e-9, 6) AS mean_loss, max(val_acc) AS best_acc FROM history GROUP BY model),
long AS (SELECT model, 'mean_loss' AS metric, mean_loss AS value FROM r UNION ALL SELECT model, 'best_acc', best_acc FROM r),
pct AS (SELECT model, metric, round(CASE WHEN value <= 1 THEN value * 100 ELSE value END + 1e-9, 4) AS value_pct FROM long)
SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value_pct DESC, model) = 1 AS winner FROM pct""")
def model_compare(spark, sf):
    results = _history(spark, sf).groupBy("model").agg(
        settled(F.avg("val_loss"), 6).alias("mean_loss"), F.max("val_acc").alias("best_acc")
    )
    return cl.compare_models(results, "model", ["mean_loss", "best_acc"])
