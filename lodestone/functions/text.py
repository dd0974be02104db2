"""Column expressions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.constants import NOISE_BELOW, TOPIC_COVERED_ABOVE
from lodestone.functions.numbers import settled


WHITESPACE = " \t\n\x0b\f\r"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Strip all leading and trailing ASCII whitespace (Spark's trim takes spaces only)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def combined_text(title: Column | str, abstract: Column | str, full_text: Column | str | None = None) -> Column:
    """Non-empty parts joined by a blank line; concat_ws skips the nulls."""
    parts = [_col(title), _col(abstract)]
    if full_text is not None:
        parts.append(F.nullif(_col(full_text), F.lit("")))
    return F.concat_ws("\n\n", *parts)


def tokens(c: Column | str) -> Column:
    """Lower-cased whitespace tokens, no empty ones."""
    return F.filter(F.split(F.lower(_col(c)), r"\s+"), lambda t: t != "")


def occurrences(text: Column | str, term: str) -> Column:
    """Non-overlapping occurrences of ``term`` in lower-cased text."""
    low = F.lower(_col(text))
    gone = F.replace(low, F.lit(term.lower()), F.lit(""))
    return ((F.length(low) - F.length(gone)) / F.lit(len(term))).cast("long")


def contains_any(text: Column | str, keywords: Column | str) -> Column:
    low = F.lower(_col(text))
    return F.exists(_col(keywords), lambda kw: F.contains(low, F.lower(kw)))


def keywords_found(text: Column | str, keywords: Column | str) -> Column:
    """How many of the keywords occur in the text."""
    low = F.lower(_col(text))
    return F.size(F.filter(_col(keywords), lambda kw: F.contains(low, F.lower(kw))))


def preview(c: Column | str, chars: int, suffix: str = "", one_line: bool = False) -> Column:
    cut = F.substr(_col(c), F.lit(1), F.lit(chars))
    if one_line:
        cut = F.replace(cut, F.lit("\n"), F.lit(" "))
    return F.concat(cut, F.lit(suffix)) if suffix else cut


def percent(c: Column | str, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", settled(_col(c).cast("double") * 100, digits))


def content_hash(c: Column | str, chars: int = 32) -> Column:
    digest = F.md5(_col(c))
    return digest if chars >= 32 else F.substr(digest, F.lit(1), F.lit(chars))


def relevance_grade(similarity: Column | str) -> Column:
    s = _col(similarity)
    return (
        F.when(s > TOPIC_COVERED_ABOVE, "RELEVANT").when(s < NOISE_BELOW, "NOISE").otherwise("MARGINAL")
    )


def relative_gain_pct(value: Column | str, base: Column | str) -> Column:
    v, b = _col(value), _col(base)
    return F.when(b > 0, (v - b) / b * 100).otherwise(F.lit(0.0))
