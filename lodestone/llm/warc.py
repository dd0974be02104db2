"""Operator 7: derivative WARC records of web responses.

Each response gives a metadata record (title, language, source headers, digest
and links) and a conversion record (its plain text).  Both refer to the response
by its record id, URI and date, and carry the digest of their own block.  All
of it is column expressions; files are written and read by Spark's text source,
with the end of a record, or the lines that begin the next, as line separators.  A block never holds a carriage return but at the ends of its lines,
so no text can be taken for a record's end.

Cases: a null or empty payload gives an empty title and an empty text; a null
URI, date or header is empty; line breaks in them become spaces; equal
responses give equal records, with the same ids, each time they occur; an empty
table gives no records; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from html.entities import html5, name2codepoint
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
CRLF = "\r\n"
START = f"{VERSION}{CRLF}WARC-Type: "  # of a record; a text can have the version alone
BLOCK_TAGS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|tr|ul"
# (pattern, replacement), one after another; the first three take out what isn't shown
TO_TEXT = [
    (r"(?s)<!--.*?-->", " "),
    (r"(?is)<script\b[^>]*>.*?</script\s*>", " "),
    (r"(?is)<style\b[^>]*>.*?</style\s*>", " "),
    (r"(?is)<title\b[^>]*>.*?</title\s*>", " "),
    (rf"(?i)</?(?:{BLOCK_TAGS})\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
]
TIDY = [(r"[ \t\r\f]+", " "), (r" ?\n ?", "\n"), (r"\n+", "\n"), (r"^[ \n]+|[ \n]+$", "")]
# The same steps for Spark, in less time: block tags by their first letters, as most tags then fail at once, and blanks
# that are as they shall be, most of them single spaces, aren't matched
BLOCK_TAG = "|".join(f"{k}(?:{'|'.join(n[1:] for n in names)})" for k, names in groupby(sorted(BLOCK_TAGS.split("|")), lambda n: n[0]))
SHOWN, MARKUP = TO_TEXT[:3], [TO_TEXT[3], (rf"(?i)</?(?:{BLOCK_TAG})\b[^>]*>", "\n"), TO_TEXT[5]]
BLANKS = [(r"[ \t\r\f](?:[ \t\r\f]++|(?<! ))", " "), (r" ?+\n[ \n]*+", "\n")]
LINE_ENDS = ("\x85", "\u2028", "\u2029")  # $ also stands before one of these at the end of a text
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"

# name, with its semicolon if it needs one -> text; a no-break space is a blank.  A look-up goes
# through them in order, so the names of old, which are the common ones, stand first
COMMON = dict.fromkeys(["nbsp;", "amp;", "lt;", "gt;", "quot;", "copy;", "middot;", *(f"{n}{e}" for e in (";", "") for n in name2codepoint)])
NAMED = {n: html5[n] for n in [*(n for n in COMMON if n in html5), *(n for n in html5 if n not in COMMON)]} | {"nbsp;": " ", "nbsp": " "}
BARE = "|".join(sorted((n for n in NAMED if n[-1] != ";"), key=lambda n: (-len(n), n)))  # the longest first
NUMBERED = {0xA0: " "} | {b: bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)}
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""  # of an attribute

HEADER_FIELDS = {
    "warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To", "refers_to_uri": "WARC-Refers-To-Target-URI",
    "refers_to_date": "WARC-Refers-To-Date", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "content_type": "Content-Type", "block_digest": "WARC-Block-Digest", "content_length": "Content-Length",
}


def _replaced(text: Column, steps: list[tuple[str, str]]) -> Column:
    return reduce(lambda x, s: F.regexp_replace(x, s[0], F.lit(s[1])), steps, text)


def _table(values: dict) -> Column:
    """A map literal."""
    return F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in values.items())), F.lit("\x02"), F.lit("\x01"))


def _code_point(digits: Column, base: int, most: int) -> Column:
    """The character of a number; what is none becomes the replacement character."""
    short = F.regexp_replace(digits, "^0+", "")
    code = F.when(F.length(short).between(1, most), F.conv(short, base, 10).cast("long"))
    real = (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(real, F.coalesce(F.try_element_at(_table(NUMBERED), code.cast("string")), char)).otherwise(F.lit("\ufffd"))


def _reference(rest: Column) -> Column:
    """What stands behind an ampersand, decoded: named, decimal and hexadecimal references, and old names without semicolon."""
    stop = F.instr(rest, ";")
    named = F.try_element_at(_table(NAMED), F.substr(rest, F.lit(1), stop))
    behind = lambda pattern: F.regexp_replace(rest, pattern, "")
    decimal, hexadecimal = F.regexp_extract(rest, r"^#([0-9]+)", 1), F.regexp_extract(rest, r"^#[xX]([0-9a-fA-F]+)", 1)
    number = (
        F.when(decimal != "", F.concat(_code_point(decimal, 10, 7), behind(r"^#[0-9]+;?")))
        .when(hexadecimal != "", F.concat(_code_point(hexadecimal, 16, 6), behind(r"^#[xX][0-9a-fA-F]+;?")))
    )
    bare = F.concat(F.try_element_at(_table(NAMED), F.regexp_extract(rest, f"^(?:{BARE})", 0)), behind(f"^(?:{BARE})"))
    name = F.coalesce(F.concat(named, F.substr(rest, stop + 1)), bare)
    return F.coalesce(F.when(F.startswith(rest, F.lit("#")), number).otherwise(name), F.concat(F.lit("&"), rest))


def _entities(text: Column) -> Column:
    """Each reference decoded once, so what an ampersand's reference gives is text."""
    parts = F.transform(F.split(text, "&", -1), lambda part, i: F.when(i == 0, part).otherwise(_reference(part)))
    return F.array_join(parts, "")


def _attribute(tag: str, name: str) -> str:
    """The pattern of a tag up to its first attribute of a name, with the value as its group."""
    before = rf"(?:[\s/]++|=|(?!{name}\s*+=)[^\s/>=]++(?:\s*+=\s*+{VALUE}?+)?+)*+"
    return rf"(?i)<{tag}(?=[\s/]){before}{name}\s*+=\s*+({VALUE})"


def _unquoted(value: Column) -> Column:
    quoted = F.substr(value, F.lit(1), F.lit(1)).isin('"', "'")
    return F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def attributes(html: Column, tag: str, name: str) -> Column:
    """Values of a tag's first attribute of a name, in double quotes, single quotes or none."""
    return F.transform(F.regexp_extract_all(html, F.lit(_attribute(tag, name)), F.lit(1)), _unquoted)


def first_attribute(html: Column, tag: str, name: str) -> Column:
    """The first of ``attributes``, or an empty text; what lies behind it isn't searched."""
    return _unquoted(F.regexp_extract(html, _attribute(tag, name), 1))


def _stripped(text: Column) -> Column:
    """Without blanks at its ends; the text is computed once."""
    odd = lambda t: reduce(Column.__or__, [F.endswith(t, F.lit(e)) for e in LINE_ENDS])
    strip = lambda t: F.when(odd(t), F.regexp_replace(t, *TIDY[3])).otherwise(F.btrim(t, F.lit(" \n")))
    return F.get(F.transform(F.array(text), strip), F.lit(0))


def shown(html: Column) -> Column:
    """Without comments, scripts and styles."""
    return _replaced(html, SHOWN)


def text_of_shown(html: Column) -> Column:
    return _stripped(_replaced(_entities(_replaced(html, MARKUP)), BLANKS))


def plain_text(html: Column) -> Column:
    return text_of_shown(shown(html))


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\r\n\f]+", " "))


def urn(digest: Column) -> Column:
    """A record id of the first 128 bits of a hex digest."""
    part = lambda a, n: F.substr(digest, F.lit(a), F.lit(n))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">"))


def sha256(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def derivatives(responses: DataFrame) -> DataFrame:
    """Two records per response (record_id, target_uri, date, http_headers, payload): HEADER_FIELDS and ``block``."""
    r = responses.select(
        F.coalesce("record_id", F.lit("")).alias("source"), one_line(F.col("target_uri")).alias("target_uri"), one_line(F.col("date")).alias("date"),
        F.coalesce("http_headers", F.lit("")).alias("http_headers"), F.coalesce("payload", F.lit("")).alias("html"),
    ).withColumn("shown", shown(F.col("html")))  # links and text are read from it
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    many = lambda name, values: F.array_join(F.transform(values, lambda v: field(name, one_line(v))), "")
    sources = F.filter(F.split("http_headers", r"\r?\n"), lambda h: F.trim(h) != "")
    metadata = F.concat(
        field("title", one_line(_entities(F.regexp_extract("html", TITLE, 1)))),
        field("lang", one_line(_entities(first_attribute(F.col("html"), "html", "lang")))),
        field("source-payload-digest", sha256(F.col("html"))),
        field("source-length", F.octet_length("html").cast("string")),
        many("source-header", sources),
        many("outlink", F.transform(attributes(F.col("shown"), "a", "href"), _entities)),
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), metadata.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), text_of_shown(F.col("shown")).alias("block")),
    )
    rows = r.select("*", F.inline(kinds))
    return rows.select(
        "warc_type", urn(F.sha2(F.concat_ws(" ", "warc_type", "source"), 256)).alias("record_id"), F.col("source").alias("refers_to"),
        F.col("target_uri").alias("refers_to_uri"), F.col("date").alias("refers_to_date"), "target_uri", "date", "content_type",
        sha256(F.col("block")).alias("block_digest"), F.octet_length("block").cast("long").alias("content_length"), "block",
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Files of WARC records below ``path``; Spark commits them, so a lost task leaves nothing behind."""
    head = F.concat(F.lit(VERSION + CRLF), *[F.concat(F.lit(f"{name}: "), F.col(c).cast("string"), F.lit(CRLF)) for c, name in HEADER_FIELDS.items()])
    records.select(F.concat(head, F.lit(CRLF), "block")).write.option("lineSep", CRLF + CRLF).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of files written by ``write_warc``."""
    # What stands before a separator must not be like its beginning: Hadoop's line reader misses a separator that
    # begins within what could have been one, if its buffer ends there.
    raw = spark.read.option("lineSep", f"\n{START}").text(path)
    rest = F.when(F.startswith("value", F.lit(START)), F.substr("value", F.lit(len(START) + 1))).otherwise(F.col("value"))  # a file's first has it
    value = F.concat(F.lit(f"{CRLF}WARC-Type: "), rest)
    cut = F.instr(value, CRLF + CRLF)
    rows = raw.select(F.substr(value, F.lit(1), cut - 1).alias("head"), F.substr(value, cut + 4).alias("block"))
    fields = [F.substring_index(F.split_part("head", F.lit(f"{CRLF}{name}: "), F.lit(2)), CRLF, 1).alias(c) for c, name in HEADER_FIELDS.items()]
    out = rows.select(*fields, "block").withColumn("content_length", F.col("content_length").cast("long"))
    # what ends a record is whole in a file's last one only
    end = F.when(F.endswith("block", F.lit("\n")), len(CRLF + CRLF)).otherwise(len(CRLF + CRLF) - 1)
    return out.withColumn("block", F.substr("block", F.lit(1), F.length("block") - end))
