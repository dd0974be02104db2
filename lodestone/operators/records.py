"""Flattening landed publication records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.constants import MIN_ABSTRACT_CHARS
from lodestone.functions.text import strip_ws


def joined_parts(raw: Column) -> Column:
    """Text of a field that is a JSON list of strings in some records and a plain string in others."""
    parts = F.from_json(raw, "array<string>")
    is_list = F.startswith(F.ltrim(raw), F.lit("["))
    return F.when(is_list & parts.isNotNull(), F.array_join(parts, " ")).otherwise(raw)


def flatten_records(raw: DataFrame, default_year: int | None = None, namespace: str | None = "PMID:",
                    min_abstract: int = MIN_ABSTRACT_CHARS) -> DataFrame:
    """Documents with a ``reason`` column: null when the record is usable."""
    citation = F.col("MedlineCitation")
    article = citation["Article"]
    number = strip_ws(citation["PMID"])
    year = article["Journal"]["JournalIssue"]["PubDate"]["Year"].try_cast("int")
    if default_year is not None:
        year = F.coalesce(year, F.lit(default_year))
    flat = raw.select(
        (F.concat(F.lit(namespace), number) if namespace else number).alias("id"),
        F.coalesce(strip_ws(article["ArticleTitle"]), F.lit("")).alias("title"),
        F.coalesce(strip_ws(joined_parts(article["Abstract"]["AbstractText"])), F.lit("")).alias("abstract"),
        F.lit("").alias("full_text"),
        year.alias("year"),
        F.make_date(year, F.lit(1), F.lit(1)).alias("publication_date"),
        F.coalesce(F.get(citation["KeywordList"], F.lit(0)), F.array().cast("array<string>")).alias("keywords"),
        *([F.col("_corrupt_record")] if "_corrupt_record" in raw.columns else []),
    )
    reason = F.when(F.col("id").isNull(), "malformed")
    if "_corrupt_record" in raw.columns:
        reason = F.when(F.col("_corrupt_record").isNotNull() | F.col("id").isNull(), "malformed")
    reason = reason.when(F.col("title") == "", "no title").when(F.length("abstract") < min_abstract, "short abstract")
    return flat.withColumn("reason", reason).drop("_corrupt_record")


def usable(flat: DataFrame) -> DataFrame:
    return flat.filter("reason IS NULL").drop("reason")


def rejected(flat: DataFrame) -> DataFrame:
    return flat.filter("reason IS NOT NULL")


def with_keyword(docs: DataFrame, wanted: list[str], keywords: str = "keywords") -> DataFrame:
    """Documents whose keyword array holds any of the wanted ones."""
    return docs.filter(F.arrays_overlap(keywords, F.array(*[F.lit(w) for w in wanted])))


def keyword_index(docs: DataFrame, doc_id: str = "id", keywords: str = "keywords") -> DataFrame:
    """(keyword, doc_id), to be stored clustered by keyword."""
    return docs.select(F.explode(F.array_distinct(keywords)).alias("keyword"), doc_id)
