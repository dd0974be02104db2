"""Measuring retrieval: keyword and semantic metrics, configuration tables, sweeps.

Hits are (by, query_id, rank, chunk_text or vector); cases are one row per
configuration and query.  ``by`` names the configuration columns, so any number
of configurations is measured in one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.constants import TOPIC_COVERED_ABOVE
from lodestone.functions.numbers import settled
from lodestone.functions.text import contains_any, keywords_found, preview, relative_gain_pct
from lodestone.functions.vectors import cosine
from lodestone.operators.fusion import RRF_DIGITS, side_by_side, vote, with_similarity

DIGITS = 4


def per_config(cases: DataFrame, configs: Sequence[dict]) -> DataFrame:
    """Each case once per configuration: the evaluation grid, without a join."""
    rows = [F.struct(*[F.lit(v).alias(c) for c, v in config.items()]) for config in configs]
    return cases.withColumn("_cfg", F.explode(F.array(*rows))).select("_cfg.*", *cases.columns)


def _joined_text() -> Column:
    """The hit texts of one case in rank order (k of them)."""
    in_order = F.array_sort(F.collect_list(F.struct("rank", "chunk_text")))
    return F.array_join(in_order["chunk_text"], " ")


def keyword_scores(hits: DataFrame, cases: DataFrame, k: int, by: Sequence[str] = (), keywords: str = "expected_keywords") -> DataFrame:
    """(by, query_id, precision_at_k, keyword_coverage).

    Precision divides by k however many chunks were found; coverage looks at
    the texts joined; a case without hits or keywords scores 0.
    """
    key = [*by, "query_id"]
    cases = cases.select(*key, keywords)
    judged = hits.filter(F.col("rank") <= k).join(cases, key)
    per_case = judged.groupBy(*key).agg(
        F.count_if(contains_any("chunk_text", keywords)).alias("_relevant"), _joined_text().alias("_joined")
    )
    wanted = F.size(keywords)
    found = keywords_found(F.coalesce("_joined", F.lit("")), keywords)
    return cases.join(per_case, key, "left").select(
        *key,
        settled(F.coalesce(F.col("_relevant") / F.lit(k), F.lit(0.0)), DIGITS).alias("precision_at_k"),
        settled(F.when(wanted > 0, found / wanted).otherwise(F.lit(0.0)), DIGITS).alias("keyword_coverage"),
    )


def topic_arrays(topics: DataFrame, key: Sequence[str] = ("query_id",), pos: str = "topic_pos",
                 vector: str = "topic_vector") -> DataFrame:
    """One row per case with its few topic vectors in order."""
    ordered = F.array_sort(F.collect_list(F.struct(pos, vector)))
    return topics.groupBy(*key).agg(ordered[vector].alias("topics"))


def semantic_scores(hits: DataFrame, topics: DataFrame, by: Sequence[str] = (), topic_key: Sequence[str] = ("query_id",),
                    vector: str = "embedding", threshold: float = TOPIC_COVERED_ABOVE, cases: DataFrame | None = None) -> DataFrame:
    """(by, query_id, semantic_precision, topic_coverage, best_similarity, kept).

    Similarities are worked out next to each hit against the topic array of its
    case; only k short arrays per case are grouped.  Covered means above the
    threshold, not at it.  With ``cases`` (by, query_id), those without hits score 0.
    """
    key = [*by, "query_id"]
    with_topics = hits.join(topic_arrays(topics, topic_key), list(topic_key))
    sims = F.transform("topics", lambda t: F.round(cosine(F.col(vector), t), 6))
    rows = with_topics.select(*key, sims.alias("sims")).withColumn("best", F.array_max("sims"))
    per_case = rows.groupBy(*key).agg(
        F.avg("best").alias("_sp"),
        F.max("best").alias("_bs"),
        F.count("*").alias("_kept"),
        F.collect_list("sims").alias("_sims"),
        F.max(F.size("sims")).alias("_n"),
    )
    reached = F.filter(
        F.sequence(F.lit(0), F.col("_n") - 1),
        lambda t: F.exists("_sims", lambda s: F.get(s, t) > threshold),
    )
    per_case = per_case.withColumn("_tc", F.size(reached) / F.col("_n"))
    if cases is not None:
        per_case = cases.select(*key).join(per_case, key, "left")

    def value(c: str) -> Column:
        return settled(F.coalesce(c, F.lit(0.0)), DIGITS)

    return per_case.select(
        *key,
        value("_sp").alias("semantic_precision"),
        value("_tc").alias("topic_coverage"),
        value("_bs").alias("best_similarity"),
        F.coalesce("_kept", F.lit(0)).cast("long").alias("kept"),
    )


def with_case_keywords(scores: DataFrame, keyword_cases: DataFrame) -> DataFrame:
    """Looks up the keyword coverage of the case with the same id; 0 if there is none."""
    return scores.join(keyword_cases, "query_id", "left").withColumn(
        "keyword_precision", F.coalesce("keyword_precision", F.lit(0.0))
    )


def config_means(per_case: DataFrame, by: Sequence[str], metrics: Sequence[str], latency: str | None = None) -> DataFrame:
    """Mean of each metric over the cases of a configuration."""
    means = [settled(F.avg(m), DIGITS).alias(f"mean_{m}") for m in metrics]
    if latency:
        means.append(settled(F.avg(latency), 2).alias(f"mean_{latency}"))
    return per_case.groupBy(*by).agg(*means, F.count("*").alias("num_cases"))


def rank_configs(means: DataFrame, metric: str, by: Sequence[str]) -> DataFrame:
    """Best first, ties by name.  One row per configuration, so one ordered window."""
    return means.withColumn("rank", F.row_number().over(W.orderBy(F.desc(metric), *by)))


def versus_runner_up(ranked: DataFrame, metric: str, latency: str | None = None) -> DataFrame:
    """The winner with its lead over the second place."""
    nxt = W.orderBy("rank")
    out = ranked.withColumn("lead", settled(F.col(metric) - F.lead(metric).over(nxt), DIGITS))
    if latency:
        out = out.withColumn("latency_lead", settled(F.col(latency) - F.lead(latency).over(nxt), 2))
    return out.filter("rank = 1")


def with_distinct_counts(configs: DataFrame, **columns: str) -> DataFrame:
    """Adds how many different values each column has, to a table of one row per configuration."""
    whole = W.partitionBy()
    return configs.withColumns({name: F.size(F.collect_set(c).over(whole)).cast("long") for name, c in columns.items()})


def by_difficulty(per_case: DataFrame, cases: DataFrame, metric: str, by: Sequence[str] = ()) -> DataFrame:
    joined = per_case.join(cases.select("query_id", "difficulty"), "query_id")
    return joined.groupBy(*by, "difficulty").agg(
        F.count("*").alias("n"), settled(F.avg(metric), DIGITS).alias(f"mean_{metric}")
    )


def best_combined(means: DataFrame, order: str, precision: str = "mean_semantic_precision",
                  coverage: str = "mean_topic_coverage") -> DataFrame:
    """The configuration with the highest 0.5 * precision + 0.5 * coverage; the earliest on a tie."""
    scored = means.withColumn("combined", settled(0.5 * F.col(precision) + 0.5 * F.col(coverage), 6))
    return scored.orderBy(F.desc("combined"), order).limit(1)


def improvement(means: DataFrame, baseline: str, label: str, metrics: Sequence[str]) -> DataFrame:
    """Gain in percent over the baseline row; 0 where the baseline is 0."""
    whole = W.partitionBy()  # one row per configuration

    def base(m: str) -> Column:
        return F.max(F.when(F.col(label) == baseline, F.col(m))).over(whole)

    gains = [settled(relative_gain_pct(F.col(m), base(m)), 1).alias(f"{m}_gain_pct") for m in metrics]
    return means.select("*", *gains)


def sweep_fusion(vector_hits: DataFrame, bm25_hits: DataFrame, items: DataFrame, queries: DataFrame, ids: Sequence[str],
                 configs: Sequence[dict]) -> DataFrame:
    """Final hits of many fusion settings from one pair of candidate lists.

    A setting has label, depth, k, bm25_weight, vector_weight, rrf_k, floor and
    floor_last.  Retrieval and similarities are done once; a setting only
    re-weighs, filters and cuts the candidates.
    """
    fields = ["label", "depth", "k", "bm25_weight", "vector_weight", "rrf_k", "floor", "floor_last"]
    defaults = {"depth": 20, "k": 7, "bm25_weight": 1.0, "vector_weight": 1.0, "rrf_k": 60, "floor": None, "floor_last": False}
    types = {"depth": "int", "k": "int", "rrf_k": "int", "floor": "double", "floor_last": "boolean", "label": "string"}
    settings = F.array(
        *[
            F.struct(*[F.lit({**defaults, **c}[f]).cast(types.get(f, "double")).alias(f) for f in fields])
            for c in configs
        ]
    )

    candidates = with_similarity(side_by_side([vector_hits, bm25_hits], ids), items, queries, ids)
    each = candidates.withColumn("c", F.explode(settings))

    def given(rank: str, weight: str) -> Column:
        in_depth = F.when(F.col(rank) <= F.col("c.depth"), F.col(rank))
        return vote(in_depth, F.col(f"c.{weight}"), F.col("c.rrf_k"))

    rrf = F.round(given("rank_0", "vector_weight") + given("rank_1", "bm25_weight"), RRF_DIGITS)
    passes = F.col("c.floor").isNull() | (F.col("vec_sim") >= F.col("c.floor"))
    scored = each.withColumns({"rrf": rrf, "label": F.col("c.label"), "passes": passes})
    early = scored.filter((F.col("rrf") > 0) & (F.col("c.floor_last") | F.col("passes")))
    order = W.partitionBy("label", "query_id").orderBy(F.desc("rrf"), *ids)
    ranked = early.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= F.col("c.k"))
    return ranked.filter("passes").select("label", "query_id", *ids, "rrf", "vec_sim", "rank")


def sweep_k(hits: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Hits of several cut-offs from one ranked list, tagged ``k``."""
    cuts = F.array(*[F.lit(k) for k in ks])
    return hits.withColumn("k", F.explode(cuts)).filter(F.col("rank") <= F.col("k"))


def hit_previews(hits: DataFrame, chars: int = 120) -> DataFrame:
    return hits.withColumn("preview", preview("chunk_text", chars, suffix="..."))


def nested_results(per_case: DataFrame, means: DataFrame, by: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per configuration with its per-case list, in case order.

    The list holds one short struct per test case; for a case table too large
    to nest, write the flat per-case rows partitioned by configuration instead.
    """
    nested = per_case.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("query_id", *fields))).alias("per_case"))
    return means.join(nested, list(by))
