"""Normalising and checking documents and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lodestone.constants import MIN_ABSTRACT_CHARS, MIN_QUERY_CHARS
from lodestone.functions.text import combined_text, strip_ws


def normalise(docs: DataFrame) -> DataFrame:
    """Trim title, abstract and full_text, add combined_text and text_length."""
    full = F.coalesce(strip_ws("full_text"), F.lit("")) if "full_text" in docs.columns else F.lit("")
    trimmed = docs.withColumns(
        {
            "title": F.coalesce(strip_ws("title"), F.lit("")),
            "abstract": F.coalesce(strip_ws("abstract"), F.lit("")),
            "full_text": full,
        }
    )
    return trimmed.withColumn("combined_text", combined_text("title", "abstract", "full_text")).withColumn(
        "text_length", F.length("combined_text")
    )


def is_valid(min_abstract: int = MIN_ABSTRACT_CHARS):
    return (F.length("title") > 0) & (F.length("abstract") >= min_abstract)


def clean(docs: DataFrame, min_abstract: int = MIN_ABSTRACT_CHARS) -> DataFrame:
    """Documents with a title and an abstract of at least ``min_abstract`` characters."""
    return normalise(docs).filter(is_valid(min_abstract))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Counts the rows as they pass by; read ``observation.get['rows']`` after the sink ran."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def validate_requests(requests: DataFrame, min_query: int = MIN_QUERY_CHARS) -> DataFrame:
    """Adds ``reason``: null when accepted.  Columns that are absent are not checked."""
    checks = [("query", F.coalesce(F.length("query") < min_query, F.lit(True)), "query too short")]
    if "confidence" in requests.columns:
        bad = F.col("confidence").isNotNull() & ~F.col("confidence").between(0.0, 1.0)
        checks.append(("confidence", bad, "confidence out of range"))
    if "content_type" in requests.columns:
        bad = F.coalesce(~F.startswith("content_type", F.lit("image/")), F.lit(True))
        checks.append(("content_type", bad, "not an image"))
    reason = F.concat_ws("; ", *[F.when(bad, F.lit(text)) for _, bad, text in checks])
    return requests.withColumn("reason", F.nullif(reason, F.lit("")))


def split_accepted(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return checked.filter("reason IS NULL").drop("reason"), checked.filter("reason IS NOT NULL")
