"""Operator 7's texts: tidied in fewer steps, from what is shown, which is computed once."""

import random
import re

from pyspark.sql import functions as F

from lodestone.llm import warc
from lodestone.session import fresh_dir

STEPS = [(r"[ \t\r\f]+", " "), (r" ?\n ?", "\n"), (r"\n+", "\n"), (r"^[ \n]+|[ \n]+(?=[\x85\u2028\u2029]?\Z)", "")]


def test_blanks_as_step_by_step(spark):
    draw = random.Random(1)
    texts = ["".join(draw.choices(" \n\t\r\fab\x85\u2028\xa0\x0b", k=draw.randrange(14))) for _ in range(2000)]
    texts += ["", " ", "\n", "a \u2028", " a \u2028 ", "\n \n", "a" + " " * 20_000 + "b", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = dict(frame.select("i", warc._stripped(warc._replaced(F.col("t"), warc.BLANKS))).collect())
    for i, t in enumerate(texts):
        for pattern, new in STEPS if t else ():
            t = re.sub(pattern, new, t)
        assert got[i] == t


def test_block_tags(spark):
    names = [*warc.BLOCK_TAGS.split("|"), "b", "a", "span", "divx", "h", "h7", "heade", "custom"]
    html = "".join(f"<{n}>x</{n.upper()} y='1'>{n}<{n}/>" for n in names)
    got = spark.range(1).select(warc._replaced(F.lit(html), warc.MARKUP[1:2])).first()[0]
    assert got == re.sub(rf"(?i)</?(?:{warc.BLOCK_TAGS})\b[^>]*>", "\n", html)


def test_what_is_shown_is_computed_once(spark):
    rows = spark.createDataFrame([("r", "u", "d", "h", "<p>a</p>")], "record_id string, target_uri string, date string, http_headers string, payload string")
    plan = warc.derivatives(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("</script") == 1


def test_records_at_any_end_of_a_buffer_or_split(spark):
    draw = random.Random(2)
    texts = ["<title>WARC/1.1</title>WARC/1.1<p>" + "x" * draw.randrange(300) for _ in range(400)] + ["", "<p>\nWARC/1.1\r\n<p>"]
    rows = spark.createDataFrame([(f"r{i}", "u", "d", "h", t) for i, t in enumerate(texts)], "record_id string, target_uri string, date string, http_headers string, payload string")
    want = warc.derivatives(rows)
    columns = ["refers_to", "warc_type", "block_digest", "content_length", "block"]
    path = fresh_dir(spark, "test-warc")
    warc.write_warc(want.coalesce(2), path)
    hadoop, want = spark.sparkContext._jsc.hadoopConfiguration(), sorted(map(tuple, want.select(columns).collect()))
    size, split = hadoop.get("io.file.buffer.size"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for buffer, part in (("97", split), ("1021", "7919"), ("64", "16411")):
            hadoop.set("io.file.buffer.size", buffer)
            spark.conf.set("spark.sql.files.maxPartitionBytes", part)
            assert sorted(map(tuple, warc.read_warc(spark, path).select(columns).collect())) == want
    finally:
        hadoop.set("io.file.buffer.size", size)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


def test_a_header_is_a_line_of_the_file(spark, tmp_path):
    """Other marks that end a line for a pattern, as U+0085 and U+2028 do, are text of a header."""
    odd = "http://a/\x85Content-Type: text/odd WARC-Block-Digest: none"
    page = ("<urn:uuid:1>", odd, "2024-01-01T00:00:00Z", "", "<html data-x='1' lang=de><body lang=en>a<html lang=fr>b")
    responses = spark.createDataFrame([page], "record_id string, target_uri string, date string, http_headers string, payload string")
    made = warc.derivatives(responses)
    warc.write_warc(made, str(tmp_path / "w"))
    read = warc.read_warc(spark, str(tmp_path / "w"))
    names = [*warc.HEADER_FIELDS, "block"]
    assert sorted(map(tuple, read.select(*names).collect())) == sorted(map(tuple, made.select(*names).collect()))
    blocks = {r.warc_type: r.block for r in read.collect()}
    assert "lang: de\r\n" in blocks["metadata"]
