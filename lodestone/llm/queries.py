"""The registered queries of this folder, with their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.anchors import repeat_report
from lodestone.llm.bit_slices import topk
from lodestone.llm.bpe import round_trip_digests
from lodestone.llm.conversation_paths import damaged, repair
from lodestone.llm import lsa_votes, warc
from lodestone.llm.mixing_lm import mixing_scores
from lodestone.llm.near_dups import near_duplicates
from lodestone.llm.prefix_join import jaccard_components
from lodestone.llm.suffixes import contamination_report
from lodestone.llm.token_counts import token_counts
from lodestone.llm.token_files import read_token_digests, write_token_files
from lodestone.llm.triangle_windows import hard_negatives, mining_rows
from lodestone.session import fresh_dir

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_files")
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, encode_special_tokens=False)
    return read_token_digests(spark, path)


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    return token_counts(docs, lines, "\n", public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, encode_special_tokens=False)


@query("op10_decontamination")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_anchor_dedup")
def op3_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents"))


@query("op9_near_duplicates")
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept", "class_id")


OP6_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), a AS (
    SELECT vec_id, q, row_number() OVER (PARTITION BY vec_id ORDER BY q) AS query_no
    FROM (SELECT DISTINCT vec_id, q FROM v WHERE vec_id % 50 = 0)
), pairs AS (
    SELECT a.vec_id AS query_id, a.query_no, b.vec_id,
           list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM a JOIN v b ON a.vec_id <> b.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id, query_no ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, query_no::INTEGER AS query_no, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op6_bit_sliced_topk", OP6_SQL)
def op6_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


@query("op4_lsa_votes")
def op4_lsa_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lsa_votes.score(docs, lsa_votes.fit(docs, table(spark, sf_dir, "labels")))


HTTP_HEADERS = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
CRAWL_DATE = "2024-01-01T00:00:00Z"


def _sql_text(value: str) -> str:
    shown = {"\n": "chr(10)", "\r": "chr(13)"}
    parts = [shown[c] if c in shown else "'" + c.replace("'", "''") + "'" for c in value]
    return " || ".join(parts) if parts else "''"


def _sql_steps(text: str, steps) -> str:
    for pattern, with_ in steps:
        text = f"regexp_replace({text}, '{pattern.replace(chr(39), chr(39) * 2)}', {_sql_text(with_)}, 'g')"
    return text


# The character references of the given pages, numbers in general, and what stands for an ampersand last of all.
SQL_REFERENCES = [("&quot;?", '"'), ("&copy;?", "\u00a9"), ("&middot;?", "\u00b7"), ("&lt;?", "<"), ("&gt;?", ">"), ("&nbsp;?", " "), ("&#0*39;", "'"), ("&amp;?", "&")]
SQL_LANGUAGE, SQL_LINK = r'(?i)<html\s[^>]*\blang="([^"]*)"', r'(?i)<a\s[^>]*?\bhref="([^"]*)"'


def _op7_sql() -> str:
    one_line = lambda x: f"trim(regexp_replace({x}, '[ \\t\\r\\n\\f]+', ' ', 'g'))"
    decoded = lambda x: _sql_steps(x, SQL_REFERENCES)
    text = _sql_steps(decoded(_sql_steps("html", warc.TO_TEXT)), warc.TIDY)
    title = one_line(decoded(f"regexp_extract(html, '{warc.TITLE}', 1)"))
    language, link = one_line(decoded(f"regexp_extract(html, '{SQL_LANGUAGE}', 1)")), one_line(decoded("l"))
    nl = "chr(13) || chr(10)"
    headers = " || ".join(f"'source-header: {h}' || {nl}" for h in HTTP_HEADERS.split("\r\n"))
    urn = lambda x: f"'<urn:uuid:' || {x}[1:8] || '-' || {x}[9:12] || '-' || {x}[13:16] || '-' || {x}[17:20] || '-' || {x}[21:32] || '>'"
    return f"""
    WITH p AS (
        SELECT coalesce(html, '') AS html, {one_line("coalesce(url, '')")} AS target_uri, coalesce(page_id::VARCHAR, '') || ' ' || coalesce(url, '') AS name FROM pages
    ), s AS (SELECT *, sha256(name) AS h, {_sql_steps("html", warc.TO_TEXT[:3])} AS shown FROM p), r AS (SELECT *, {urn("h")} AS refers_to FROM s), b AS (
        SELECT 'metadata' AS warc_type, 'application/warc-fields' AS content_type, refers_to, target_uri,
               'title: ' || {title} || {nl} || 'lang: ' || {language} || {nl}
               || 'source-payload-digest: sha256:' || sha256(html) || {nl} || 'source-length: ' || strlen(html)::VARCHAR || {nl} || {headers}
               || array_to_string(list_transform(regexp_extract_all(shown, '{SQL_LINK}', 1), lambda l: 'outlink: ' || {link} || {nl}), '') AS block FROM r
      UNION ALL
        SELECT 'conversion', 'text/plain; charset=utf-8', refers_to, target_uri, {text} FROM r
    ), d AS (SELECT *, sha256(warc_type || ' ' || refers_to) AS i FROM b)
    SELECT warc_type, {urn("i")} AS record_id, refers_to, target_uri, target_uri AS refers_to_uri, '{CRAWL_DATE}' AS date, '{CRAWL_DATE}' AS refers_to_date,
           content_type, strlen(block)::BIGINT AS content_length, 'sha256:' || sha256(block) AS block_digest, true AS intact FROM d
    """


@query("op7_warc_derivatives", _op7_sql())
def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(" "), F.coalesce("url", F.lit("")))
    responses = table(spark, sf_dir, "pages").select(
        warc.urn(F.sha2(name, 256)).alias("record_id"), F.col("url").alias("target_uri"), F.lit(CRAWL_DATE).alias("date"),
        F.lit(HTTP_HEADERS).alias("http_headers"), F.col("html").alias("payload"),
    )
    path = fresh_dir(spark, "warc")
    warc.write_warc(warc.derivatives(responses), path)
    records = warc.read_warc(spark, path)
    return records.withColumn("intact", F.col("block_digest") == warc.sha256(F.col("block"))).drop("block")


@query("op5_mixing_lm")
def op5_mixing_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_scores(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH v AS (
    SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), a AS (SELECT *, row_number() OVER () AS anchor FROM v WHERE id % 100 = 0), scored AS (
    SELECT a.anchor, a.id AS anchor_id, v.id, a.label = v.label AS same,
           list_sum(list_transform(list_zip(a.q, v.q), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM a JOIN v ON a.id <> v.id
), positives AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS p FROM scored WHERE same) WHERE p <= 5
), ranked AS (
    SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor, p.p ORDER BY n.score DESC, n.id) AS rank
    FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""


@query("op13_hard_negatives", OP13_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(mining_rows(table(spark, sf_dir, "embeddings"), label), F.col("id") % 100 == 0)


def _op11_sql() -> str:
    """A backward recursion over the rows; a node's value is its cost, least audit and repaired lines, compared in this order."""
    end, gone = "{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}", "{'c': 1000000000000::BIGINT, 'a': '', 'r': []::VARCHAR[]}"
    to = lambda x, cost, letter, line=None: f"{{'c': {x}.c + {cost}, 'a': '{letter}' || {x}.a, 'r': {f'list_prepend({line}, {x}.r)' if line else f'{x}.r'}}}"
    forward = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
    kept = {0: (("s", 1), ("u", 2)), 1: (("u", 2),), 2: (("a", 3),), 3: (("u", 2),)}
    stays, kept_line = "CASE fault WHEN 3 THEN 3 ELSE 0 END", "role || ':' || text"

    def edited(state: int) -> str:
        ways = [to(f"n{state}", 4, "D")]
        for initial, after in kept[state]:
            ways.append(f"CASE WHEN fault IN (0, 3) AND left(role, 1) = '{initial}' THEN {to(f'n{after}', stays, 'K', kept_line)} ELSE {gone} END")
        after, name = forward[state]
        ways.append(f"CASE WHEN fault IN (0, 3) THEN {to(f'n{after}', f'3 + {stays}', 'R', f"'{name}:' || text")} ELSE {gone} END")
        return f"list_min([{', '.join(ways)}])"

    inserted = lambda x, state: to(x, 3, "I", f"'{forward[state][1]}:'")
    two, three = f"list_min([b2, {inserted('b3', 2)}])", f"list_min([b3, {inserted('b2', 3)}])"
    return f"""
    WITH RECURSIVE bytes AS (SELECT range AS b FROM range(256)),
    eight(b, k, v) AS (SELECT b, 0, b FROM bytes UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM eight WHERE k < 8),
    crc AS (SELECT list(v ORDER BY b) AS t FROM eight WHERE k = 8),
    named AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT) AS name FROM conversations
    ), kinds AS (
        SELECT named.*, xor(list_reduce(list_prepend(4294967295::BIGINT, name), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM named, crc
    ), damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
        FROM kinds WHERE kind <> 0
    ), placed AS (
        SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n, regexp_replace(text, '[ \t-\r]+$', '') AS bare FROM damaged
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
    ), faulty AS (
        SELECT *, CASE WHEN bare = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN right(bare, 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS fault,
               left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS meeting
        FROM placed
    ), walk(conv_id, i, s0, s1, s2, s3) AS (
        SELECT DISTINCT ON (conv_id) conv_id, n + 1, {end}, {inserted(inserted(end, 2), 0)}, {inserted(end, 2)}, {end} FROM faulty
      UNION ALL
        SELECT conv_id, i, list_min([b0, {inserted('g2', 0)}]), list_min([b1, {inserted('g2', 1)}]), g2, g3 FROM (
            SELECT *, {two} AS g2, {three} AS g3 FROM (
                SELECT conv_id, i, {', '.join(f'{edited(s)} AS b{s}' for s in range(4))} FROM (
                    SELECT f.conv_id, f.i, f.role, f.text, f.fault, w.s0 AS n0, w.s1 AS n1, w.s2 AS n2, w.s3 AS n3 FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i - 1)))
    ), counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
               count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (i > 1 AND meeting NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id
    )
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
           coalesce(w.s0.c, 0)::BIGINT AS cost, coalesce(w.s0.a, '') AS audit, sha256(coalesce(array_to_string(w.s0.r, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN walk w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.i = 1
    """


@query("op11_conversation_paths", _op11_sql())
def op11_conversation_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))


OP12_SQL = """
WITH w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> '') AS w
    FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
), n AS (SELECT doc_id, len(s) AS n FROM s), u AS (SELECT doc_id, hash(unnest(s)) AS x FROM s), df AS (SELECT x FROM u GROUP BY x HAVING count(*) > 1),
common AS (SELECT doc_id, x FROM u SEMI JOIN df USING (x)),
able AS (SELECT doc_id, n FROM n JOIN (SELECT doc_id, count(*) AS c FROM common GROUP BY doc_id) USING (doc_id) WHERE 100 * c >= 80 * n),
shared AS (SELECT doc_id, n, x FROM common JOIN able USING (doc_id)),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shared a JOIN shared b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
    WITH RECURSIVE r(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a) SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a
), same AS (SELECT doc_id, CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY list_sort(s)) END AS class_id FROM s)
SELECT n.doc_id, n.n AS n_shingles, component_id, class_id FROM n JOIN reach USING (doc_id) JOIN same USING (doc_id)
"""


@query("op12_prefix_join", OP12_SQL)
def op12_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"), width=5)
    return found.select("doc_id", "n_shingles", "component_id", "class_id")
