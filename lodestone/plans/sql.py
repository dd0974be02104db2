"""Pieces of the oracle SQL that several queries share (DuckDB dialect)."""

from __future__ import annotations

from lodestone.constants import CONDITION_CONTEXT, CONDITIONS

WS = r"'^\s+|\s+$', '', 'g'"


def toks(expr: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({expr}), '\s+'), lambda t: t <> '')"


def share(expr: str, seed: int) -> str:
    """The seeded hash of a key as a number in [0, 1)."""
    return f"(('0x' || substr(md5('{seed}:' || {expr}), 1, 8))::BIGINT::DOUBLE / 4294967296.0)"


CLEAN = rf"""
docs AS (
  SELECT doc_id AS id, lang, source,
         regexp_replace(split_part(text, chr(10), 1), {WS}) AS title,
         regexp_replace(text, {WS}) AS abstract
  FROM documents),
clean AS (
  SELECT *, title || chr(10) || chr(10) || abstract AS combined_text FROM docs
  WHERE length(title) > 0 AND length(abstract) >= 50)"""


def word_chunks(size: int, name: str = "chunks") -> str:
    """CTE of whole words packed up to ``size`` characters, over CLEAN."""
    return rf"""
{name}_p AS (
  SELECT id, title, lang, list_filter(list_transform(
      regexp_extract_all(regexp_replace(combined_text, ' +', ' ', 'g'), '(?s)(.{{1,{size}}})(?: |\z)|([^ ]+ ?)'),
      lambda c: regexp_replace(c, {WS})), lambda c: c <> '') AS cs FROM clean),
{name} AS MATERIALIZED (
  SELECT id AS doc_id, title, lang, (generate_subscripts(cs, 1) - 1)::INTEGER AS chunk_index,
         unnest(cs) AS chunk_text FROM {name}_p)"""


def window_chunks(size: int, overlap: int, name: str = "chunks") -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT id AS doc_id, title, lang, i::INTEGER AS chunk_index,
         substr(combined_text, (1 + i * {size - overlap})::INTEGER, {size}) AS chunk_text
  FROM clean, LATERAL (
    SELECT unnest(generate_series(0, ((greatest(length(combined_text) - {overlap}, 1) - 1) // {size - overlap})::BIGINT)) AS i))"""


def recursive_chunks(size: int, overlap: int, separators: list[str], name: str = "chunks", longer_than: int | None = None) -> str:
    """CTE of recursive chunks: a level per separator, then neighbours that fit are packed by a recursion over their cuts.

    Texts of up to ``longer_than`` characters are kept whole.
    """
    some = f"length(combined_text) > {longer_than}" if longer_than else "TRUE"
    steps = [f"{name}_p0 AS (SELECT id, 1::BIGINT AS a, combined_text AS t FROM clean WHERE {some} AND combined_text <> '')"]
    for level, separator in enumerate(separators):
        sep = quoted(separator)
        steps.append(f"""{name}_q{level} AS (
  SELECT id, parent, ord, t, (parent + coalesce(sum(length(t)) OVER (PARTITION BY id, parent ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS a
  FROM (SELECT id, a AS parent, unnest(ts) AS t, generate_subscripts(ts, 1) AS ord FROM (
    SELECT id, a, list_filter(list_transform(string_split(t, {sep}), lambda x, i: CASE WHEN i = 1 THEN x ELSE {sep} || x END), lambda x: x <> '') AS ts
    FROM {name}_p{level} WHERE contains(t, {sep})))),
{name}_p{level + 1} AS (
  SELECT id, a, t FROM {name}_q{level} WHERE length(t) >= {size} UNION ALL SELECT id, a, t FROM {name}_p{level} WHERE NOT contains(t, {sep}))""")
    fits = " UNION ALL ".join(f"SELECT {i} AS level, id, parent, ord, a, length(t) AS n FROM {name}_q{i} WHERE length(t) < {size}" for i in range(len(separators)))
    steps.append(f"""{name}_r AS MATERIALIZED (
  SELECT id, list(a ORDER BY ord) || [max(a + n)] AS cuts FROM (
    SELECT *, ord - row_number() OVER (PARTITION BY level, id, parent ORDER BY ord) AS island FROM ({fits}))
  GROUP BY level, id, parent, island),
{name}_k AS (
  WITH RECURSIVE k AS (
    SELECT id, cuts, 1::BIGINT AS f, len(list_filter(cuts, lambda c: c <= cuts[1] + {size})) AS l FROM {name}_r
    UNION ALL
    SELECT id, cuts, f, len(list_filter(cuts, lambda c: c <= cuts[f] + {size})) AS l FROM (
      SELECT id, cuts, 1 + len(list_filter(cuts, lambda c: c < greatest(cuts[l] - {overlap}, cuts[l + 1] - {size}))) AS f FROM k WHERE l < len(cuts)))
  SELECT id, cuts[f] AS a, cuts[l] AS b FROM k),
{name} AS MATERIALIZED (
  SELECT id AS doc_id, title, lang, (row_number() OVER (PARTITION BY id ORDER BY a) - 1)::INTEGER AS chunk_index, t AS chunk_text FROM (
    SELECT id, title, lang, a, regexp_replace(substr(combined_text, a, b - a), {WS}) AS t
    FROM (SELECT id, a, b FROM {name}_k UNION ALL SELECT id, a, a + length(t) FROM {name}_p{len(separators)}) JOIN clean USING (id)
    {f"UNION ALL SELECT id, title, lang, 1, combined_text FROM clean WHERE NOT ({some})" if longer_than else ""})
  WHERE t <> '')""")
    return ",\n".join(steps)


def embedding(name: str, src: str, keys: str, text: str, dim: int = 64) -> str:
    """CTEs ``name`` (keys, bucket, v) with unit length, from signed hashing of tokens."""
    return f"""
{name}_t AS (SELECT {keys}, unnest({toks(text)}) AS term FROM {src}),
{name}_h AS (
  SELECT term, (('0x' || substr(md5(term), 1, 8))::BIGINT % {dim})::INTEGER AS bucket,
         CASE WHEN ('0x' || substr(md5(term), 9, 1))::INTEGER % 2 = 0 THEN 1 ELSE -1 END AS s
  FROM (SELECT DISTINCT term FROM {name}_t)),
{name}_r AS (SELECT {keys}, bucket, sum(s)::DOUBLE AS v FROM {name}_t JOIN {name}_h USING (term) GROUP BY ALL HAVING sum(s) <> 0),
{name}_l AS (SELECT {keys}, sqrt(sum(v * v)) AS len FROM {name}_r GROUP BY ALL),
{name} AS MATERIALIZED (SELECT {keys}, bucket, v / len AS v FROM {name}_r JOIN {name}_l USING ({keys}))"""


def vector_hits(name: str, depth: int, q: str = "qv", c: str = "cv") -> str:
    return f"""
{name}_s AS (
  SELECT query_id, doc_id, chunk_index, round(sum(a.v * b.v), 6) AS similarity
  FROM {q} a JOIN {c} b USING (bucket) GROUP BY query_id, doc_id, chunk_index),
{name} AS MATERIALIZED (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id, chunk_index))::INTEGER AS rank
  FROM {name}_s QUALIFY rank <= {depth})"""


def bm25_hits(name: str, depth: int, chunks: str = "chunks", queries: str = "q") -> str:
    """Over chunks (doc_id, chunk_index, chunk_text) and queries (query_id, query)."""
    return f"""
{name}_k AS MATERIALIZED (SELECT doc_id, chunk_index, {toks("chunk_text")} AS ts FROM {chunks}),
{name}_n AS (SELECT count(*) AS n, sum(len(ts))::DOUBLE / count(*) AS mean FROM {name}_k),
{name}_f AS (SELECT doc_id, chunk_index, term, len(ts) AS dl, count(*) AS tf
  FROM (SELECT doc_id, chunk_index, ts, unnest(ts) AS term FROM {name}_k) GROUP BY ALL),
{name}_d AS (SELECT term, count(*) AS df FROM {name}_f GROUP BY term),
{name}_q AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({toks("query")}) AS term FROM {queries}) GROUP BY ALL),
{name}_s AS (
  SELECT query_id, doc_id, chunk_index,
         round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / mean))), 6) AS bm25
  FROM {name}_q JOIN {name}_f USING (term) JOIN {name}_d USING (term), {name}_n GROUP BY query_id, doc_id, chunk_index),
{name} AS MATERIALIZED (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY bm25 DESC, doc_id, chunk_index))::INTEGER AS rank
  FROM {name}_s QUALIFY rank <= {depth})"""


QUERIES = "q AS (SELECT item_id AS query_id, text AS query FROM benchmark)"

CASES = rf"""
cases AS MATERIALIZED (
  SELECT item_id AS query_id, text AS query,
         list_distinct(list_filter({toks("text")}, lambda t: length(t) >= 8)) AS expected_keywords,
         CASE WHEN len({toks("text")}) < 30 THEN 'standard' ELSE 'complex' END AS difficulty
  FROM benchmark)"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def focused(query: str, condition: str) -> str:
    arms = " ".join(f"WHEN {quoted(c)} THEN {quoted(' ' + t)}" for c, t in CONDITION_CONTEXT.items())
    return f"{query} || CASE {condition} {arms} ELSE '' END"


CONDITION_LIST = "[" + ", ".join(quoted(c) for c in CONDITIONS) + "]"
REQUEST_CONDITIONS = "[" + ", ".join(quoted(c) for c in [*CONDITIONS, "Normal", "Unknown"]) + "]"

REQUESTS = f"""
req AS MATERIALIZED (
  SELECT conv_id * 1000 + turn AS query_id, text AS query, {REQUEST_CONDITIONS}[(conv_id % 16 + 1)::INTEGER] AS condition
  FROM conversations WHERE role = 'user'),
freq AS MATERIALIZED (SELECT *, {focused("query", "condition")} AS focused_query FROM req)"""

LABEL_SCORES = f"""
scored AS MATERIALIZED (
  SELECT doc_id AS item_id, condition, label,
         round((label * 0.4::DOUBLE + {share("doc_id || ':' || condition", 7)} * 0.8::DOUBLE) / 1.2::DOUBLE, 4) AS score
  FROM (SELECT doc_id, 'quality' AS condition, quality AS label FROM labels
        UNION ALL SELECT doc_id, 'toxic', toxic FROM labels))"""

PREDICTIONS = f"""
cond AS (
  SELECT i, {CONDITION_LIST}[i + 1] AS condition, 0.12::DOUBLE + 0.02::DOUBLE * i AS t
  FROM (SELECT unnest(range(0, {len(CONDITIONS)})) AS i)),
raw AS (SELECT doc_id AS item_id, condition, t, {share("doc_id || ':' || condition", 11)} AS u FROM labels, cond),
pred AS MATERIALIZED (
  SELECT item_id, condition, round(round(u * u * u, 6) + 1e-9, 4) AS probability, round(t, 3) AS threshold,
         round(u * u * u, 6) >= t AS detected FROM raw)"""
