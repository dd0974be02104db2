"""Corpus queries: cleaning, chunking, duplicates, inserts, records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.constants import CHUNKING_STRATEGIES, RECURSIVE_SEPARATORS, SWEEP_SIZES
from lodestone.functions.text import preview
from lodestone.functions.unions import union_all
from lodestone.operators import chunking, cleaning, dedup, monitoring, records
from lodestone.plans import corpus as job
from lodestone.plans.catalog import query
from lodestone.plans.sql import CLEAN, WS, recursive_chunks, window_chunks, word_chunks
from lodestone.plans.tables import corpus, stream_table, as_corpus, table
from lodestone.session import fresh_dir
from lodestone.sources.keyed_table import KeyedTable
from lodestone.sources.writers import write_parquet
from lodestone.streaming.ingest import start_ingest, start_stateful_ingest

WINDOW = {"kind": "window", "size": 512, "overlap": 64}
CHUNK_COLUMNS = "doc_id, chunk_index, chunk_text, length(chunk_text)::INTEGER AS char_count, md5(chunk_text) AS content_hash"


@query("corpus_clean", f"WITH {CLEAN} SELECT id, title, combined_text, length(combined_text)::INTEGER AS text_length, lang FROM clean")
def corpus_clean(spark, sf):
    return cleaning.clean(corpus(spark, sf)).select("id", "title", "combined_text", "text_length", "lang")


@query("corpus_stage_counts", f"""WITH {CLEAN}, {word_chunks(512)}
SELECT 'ingested' AS stage, count(*) AS n FROM documents
UNION ALL SELECT 'cleaned', count(*) FROM clean
UNION ALL SELECT 'chunked', count(*) FROM chunks
UNION ALL SELECT 'unique', count(DISTINCT md5(chunk_text)) FROM chunks""")
def corpus_stage_counts(spark, sf):
    docs = cleaning.normalise(corpus(spark, sf))
    kept = F.count_if(cleaning.is_valid())
    per_doc = docs.agg(F.count("*").alias("ingested"), kept.alias("cleaned")).unpivot([], ["ingested", "cleaned"], "stage", "n")
    chunks = chunking.chunk(docs.filter(cleaning.is_valid()), "fixed_512")
    per_hash = chunks.groupBy("content_hash").agg(F.count("*").alias("c"))
    per_chunk = per_hash.agg(F.sum("c").alias("chunked"), F.count("*").alias("unique"))
    return union_all(per_doc, per_chunk.unpivot([], ["chunked", "unique"], "stage", "n"))


@query("chunk_window", f"WITH {CLEAN}, {window_chunks(512, 64)} SELECT {CHUNK_COLUMNS} FROM chunks WHERE chunk_text <> ''")
def chunk_window(spark, sf):
    return chunking.chunk(cleaning.clean(corpus(spark, sf)), WINDOW)


@query("chunk_words_512", f"WITH {CLEAN}, {word_chunks(512)} SELECT {CHUNK_COLUMNS} FROM chunks")
def chunk_words_512(spark, sf):
    return chunking.chunk(cleaning.clean(corpus(spark, sf)), "fixed_512")


@query("chunk_words_256", f"WITH {CLEAN}, {word_chunks(256)} SELECT {CHUNK_COLUMNS} FROM chunks")
def chunk_words_256(spark, sf):
    return chunking.chunk(cleaning.clean(corpus(spark, sf)), "fixed_256")


@query("chunk_document", f"WITH {CLEAN} SELECT id AS doc_id, 0 AS chunk_index, combined_text AS chunk_text, "
       "length(combined_text)::INTEGER AS char_count, md5(combined_text) AS content_hash FROM clean")
def chunk_document(spark, sf):
    return chunking.chunk(cleaning.clean(corpus(spark, sf)), "document")


def _recursive(name: str, strategy: str) -> None:
    """Registers the chunks of a recursive strategy with their SQL."""
    s = CHUNKING_STRATEGIES[strategy]
    chunks = recursive_chunks(s["size"], s["overlap"], s["separators"], longer_than=s.get("whole_up_to"))

    @query(name, f"WITH {CLEAN}, {chunks} SELECT {CHUNK_COLUMNS} FROM chunks")
    def run(spark, sf) -> DataFrame:
        return chunking.chunk(cleaning.clean(corpus(spark, sf)), strategy)


_recursive("chunk_recursive_800", "recursive_800")
_recursive("chunk_recursive_450", "recursive_paragraph")
_recursive("chunk_sentence", "sentence_based")
_recursive("chunk_natural", "natural_paragraph")

SWEEP_CHUNKS = ", ".join(recursive_chunks(size, size // 10, RECURSIVE_SEPARATORS, f"c{size}") for size in SWEEP_SIZES)
SWEEP_ROWS = " UNION ALL ".join(
    f"SELECT {size} AS size, count(*) AS chunks, min(length(chunk_text))::INTEGER AS min_chars, round(avg(length(chunk_text)) + 1e-9, 4) AS avg_chars, "
    f"max(length(chunk_text))::INTEGER AS max_chars FROM c{size}" for size in SWEEP_SIZES
)


@query("chunk_size_sweep", f"WITH {CLEAN}, {SWEEP_CHUNKS} {SWEEP_ROWS}")
def chunk_size_sweep(spark, sf):
    return chunking.chunk_summary(chunking.sweep(cleaning.clean(corpus(spark, sf)), SWEEP_SIZES), "size")


@query("chunk_stats", f"""WITH {CLEAN}, {word_chunks(512)}
SELECT lang, count(*) AS chunks, min(length(chunk_text))::INTEGER AS min_chars, round(avg(length(chunk_text)) + 1e-9, 4) AS avg_chars,
       max(length(chunk_text))::INTEGER AS max_chars FROM chunks GROUP BY lang""")
def chunk_stats(spark, sf):
    chunks = chunking.chunk(cleaning.clean(corpus(spark, sf)), "fixed_512", keep=("lang",))
    return chunking.chunk_summary(chunks, "lang")


DEDUP_SQL = f"""WITH {CLEAN}, {word_chunks(512)}
SELECT doc_id, chunk_index, chunk_text, length(chunk_text)::INTEGER AS char_count, md5(chunk_text) AS content_hash FROM chunks
QUALIFY row_number() OVER (PARTITION BY md5(chunk_text) ORDER BY doc_id, chunk_index) = 1"""


@query("chunk_dedup", DEDUP_SQL)
def chunk_dedup(spark, sf):
    return job.unique_chunks(corpus(spark, sf), "fixed_512")


@query("chunk_dedup_stored", DEDUP_SQL)
def chunk_dedup_stored(spark, sf):
    """The same from a stored chunk table, whose texts are not shuffled."""
    stored = write_parquet(chunking.chunk(cleaning.clean(corpus(spark, sf)), "fixed_512"), fresh_dir(spark, "chunks"))
    return dedup.dedup_stored(spark.read.parquet(stored))


@query("dedup_stats_by_lang", f"""WITH {CLEAN}, {window_chunks(512, 64)}, firsts AS (
  SELECT * FROM chunks WHERE chunk_text <> ''
  QUALIFY row_number() OVER (PARTITION BY md5(chunk_text) ORDER BY doc_id, chunk_index) = 1)
SELECT lang, count(*) AS chunks, count(DISTINCT doc_id) AS docs, sum(length(chunk_text))::BIGINT AS chars FROM firsts GROUP BY lang""")
def dedup_stats_by_lang(spark, sf):
    unique = job.unique_chunks(corpus(spark, sf), WINDOW, keep=("lang",))
    # Per document first, so distinct documents need no second expansion.
    per_doc = unique.groupBy("lang", "doc_id").agg(F.count("*").alias("chunks"), F.sum("char_count").alias("chars"))
    return per_doc.groupBy("lang").agg(
        F.sum("chunks").alias("chunks"), F.count("*").alias("docs"), F.sum("chars").alias("chars")
    )


@query("chunk_title_prefix", f"""WITH {CLEAN}, {word_chunks(512)}
SELECT doc_id, chunk_index, '[' || substr(title, 1, 80) || '] ' || chunk_text AS chunk_text FROM chunks""")
def chunk_title_prefix(spark, sf):
    chunks = chunking.chunk(cleaning.clean(corpus(spark, sf)), "fixed_512", keep=("title",))
    return chunking.with_title_prefix(chunks).select("doc_id", "chunk_index", "chunk_text")


@query("chunk_preview", f"""WITH {CLEAN}, {word_chunks(512)}
SELECT doc_id, chunk_index, substr(chunk_text, 1, 120) || '...' AS short, substr(chunk_text, 1, 80) AS query_line,
       replace(substr(chunk_text, 1, 180), chr(10), ' ') AS one_line FROM chunks""")
def chunk_preview(spark, sf):
    chunks = chunking.chunk(cleaning.clean(corpus(spark, sf)), "fixed_512")
    return chunks.select(
        "doc_id", "chunk_index",
        preview("chunk_text", 120, suffix="...").alias("short"),
        preview("chunk_text", 80).alias("query_line"),
        preview("chunk_text", 180, one_line=True).alias("one_line"),
    )


TERMS = ["the", "tion", "nicht", "les", "lung cancer", "and that"]


@query("term_mentions", " UNION ALL ".join(
    f"SELECT '{t}' AS term, m AS mentions, m = 0 AS missing FROM (SELECT sum((length(lower(text)) - "
    f"length(replace(lower(text), '{t}', ''))) // {len(t)})::BIGINT AS m FROM documents)" for t in TERMS))
def term_mentions(spark, sf):
    return monitoring.term_mentions(table(spark, sf, "documents"), TERMS, "text")


@query("corpus_scaled", f"""WITH docs AS (SELECT doc_id, text, unnest(range(0, 4)) AS copy FROM documents)
SELECT CASE WHEN copy > 0 THEN doc_id || '_copy' || copy ELSE doc_id::VARCHAR END AS id, copy::INTEGER AS copy,
       md5(CASE WHEN copy > 0 THEN '[Batch ' || copy || '] ' || text ELSE text END) AS abstract_hash FROM docs""")
def corpus_scaled(spark, sf):
    return job.scaled(corpus(spark, sf), 4).select("id", "copy", F.md5("abstract").alias("abstract_hash"))


@query("source_top5", "SELECT source, count(*) AS total FROM documents GROUP BY source ORDER BY total DESC, source LIMIT 5")
def source_top5(spark, sf):
    return monitoring.largest_groups(table(spark, sf, "documents"), "source", 5)


def _found(spark, sf) -> DataFrame:
    """Documents as finds of a search per source; the same text is the same document."""
    return table(spark, sf, "documents").select(
        F.md5("text").alias("id"), F.substr("source", F.lit(4)).cast("int").alias("term_pos"), F.col("doc_id").alias("pos")
    )


FOUND = "found AS (SELECT md5(text) AS id, substr(source, 4)::INTEGER AS term_pos, doc_id AS pos FROM documents)"
FIRSTS = f"""{FOUND}, firsts AS (
  SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY id ORDER BY term_pos, pos) = 1)"""


@query("first_by_term", f"WITH {FIRSTS} SELECT id, term_pos, pos FROM firsts")
def first_by_term(spark, sf):
    return dedup.first_by_term(_found(spark, sf))


@query("running_unique", f"""WITH {FIRSTS},
per AS (SELECT term_pos, count(f.id) AS new_docs FROM (SELECT DISTINCT term_pos FROM found) LEFT JOIN firsts f USING (term_pos) GROUP BY term_pos)
SELECT term_pos, new_docs, (sum(new_docs) OVER (ORDER BY term_pos))::BIGINT AS running_total FROM per""")
def running_unique(spark, sf):
    return dedup.running_unique(_found(spark, sf))


def _batch_and_stored(spark, sf) -> tuple[DataFrame, DataFrame]:
    """All documents as a batch; those with labels are stored already."""
    batch = table(spark, sf, "documents").select(F.md5("text").alias("content_hash"), "doc_id", "n_chars")
    stored = batch.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi").select("content_hash")
    return batch, stored


STORED = """batch AS (SELECT md5(text) AS content_hash, doc_id, n_chars FROM documents),
stored AS (SELECT DISTINCT content_hash FROM batch WHERE doc_id IN (SELECT doc_id FROM labels))"""


@query("insert_if_absent", f"""WITH {STORED} SELECT content_hash, doc_id, n_chars FROM batch
WHERE content_hash NOT IN (SELECT content_hash FROM stored)
QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY doc_id) = 1""")
def insert_if_absent(spark, sf):
    batch, stored = _batch_and_stored(spark, sf)
    return dedup.unseen(batch, stored, "content_hash", ["doc_id"])


@query("insert_counts", f"""WITH {STORED}, new AS (
  SELECT DISTINCT content_hash FROM batch WHERE content_hash NOT IN (SELECT content_hash FROM stored))
SELECT (SELECT count(*) FROM new) AS inserted, (SELECT count(*) FROM batch) - (SELECT count(*) FROM new) AS skipped,
       0::BIGINT AS errors""")
def insert_counts(spark, sf):
    return dedup.insert_counts(*_batch_and_stored(spark, sf), "content_hash")


@query("insert_embeddings", f"""WITH {CLEAN}, {word_chunks(512)}, batch AS (
  SELECT doc_id, chunk_index, md5(chunk_text) AS content_hash, unnest(['hash32', 'hash64']) AS embedding_model FROM chunks),
stored AS (SELECT DISTINCT content_hash, 'hash64' AS embedding_model FROM batch WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT doc_id, chunk_index, content_hash, embedding_model FROM batch ANTI JOIN stored USING (content_hash, embedding_model)
QUALIFY row_number() OVER (PARTITION BY content_hash, embedding_model ORDER BY doc_id, chunk_index) = 1""")
def insert_embeddings(spark, sf):
    """Chunks for two models; one model already holds the chunks of the labelled documents."""
    both = F.explode(F.array(F.lit("hash32"), F.lit("hash64"))).alias("embedding_model")
    batch = chunking.chunk(cleaning.clean(corpus(spark, sf)), "fixed_512").select("doc_id", "chunk_index", "content_hash", both)
    stored = batch.filter("embedding_model = 'hash64'").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    return dedup.unseen(batch, stored, ["content_hash", "embedding_model"], ["doc_id", "chunk_index"])


def _landed(spark, sf) -> DataFrame:
    """Pages as landed nested records."""
    html = F.col("html")
    # every tag of the article but <p> goes, so a paragraph's inline tags and missing ends don't matter
    article = F.regexp_replace(F.regexp_extract(html, "(?s)<article>(.*?)</article>", 1), "(?s)<h1>.*?</h1>", "")
    pieces = F.split(F.regexp_replace(article, "</[^>]*>|<[^p/][^>]*>|<p[a-z][^>]*>", " "), "<p>")
    parts = F.filter(F.transform(F.slice(pieces, 2, 1 << 30), lambda x: F.trim(x)), lambda x: x != "")
    words = F.regexp_extract_all(html, F.lit('<li><a href="[^"]*">([^<]*)</a>'), F.lit(1))
    return table(spark, sf, "pages").select(
        F.struct(
            F.col("page_id").cast("string").alias("PMID"),
            F.struct(
                F.regexp_extract(html, "<title>([^<]*)</title>", 1).alias("ArticleTitle"),
                F.struct(F.to_json(parts).alias("AbstractText")).alias("Abstract"),
                F.struct(F.struct(F.struct((F.col("page_id") % 120 + 1900).cast("string").alias("Year")).alias("PubDate"))
                         .alias("JournalIssue")).alias("Journal"),
            ).alias("Article"),
            F.array(words).alias("KeywordList"),
        ).alias("MedlineCitation")
    )


FLAT = rf"""
raw AS (
  SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t,
         list_filter(list_transform(string_split(a, '<p>')[2:], lambda x: trim(regexp_replace(x, '<[^>]*>', ' ', 'g'))), lambda x: x <> '') AS parts,
         (1900 + page_id % 120)::INTEGER AS year,
         regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1) AS keywords
  FROM (SELECT *, substr(html, instr(html, '</h1>'), instr(html, '</article>') - instr(html, '</h1>')) AS a FROM pages)),
flat AS (
  SELECT 'PMID:' || page_id AS id, regexp_replace(t, {WS}) AS title,
         regexp_replace(array_to_string(parts, ' '), {WS}) AS abstract, year, keywords FROM raw),
judged AS (SELECT *, CASE WHEN title = '' THEN 'no title' WHEN length(abstract) < 50 THEN 'short abstract' END AS reason FROM flat)"""


@query("record_flatten", f"""WITH {FLAT} SELECT id, title, abstract, year, make_date(year, 1, 1) AS publication_date,
array_to_string(keywords, '|') AS keywords FROM judged WHERE reason IS NULL""")
def record_flatten(spark, sf):
    flat = records.usable(records.flatten_records(_landed(spark, sf)))
    return flat.select("id", "title", "abstract", "year", "publication_date", F.array_join("keywords", "|").alias("keywords"))


@query("record_reasons", f"WITH {FLAT} SELECT coalesce(reason, 'usable') AS reason, count(*) AS n FROM judged GROUP BY 1")
def record_reasons(spark, sf):
    flat = records.flatten_records(_landed(spark, sf))
    return flat.groupBy(F.coalesce("reason", F.lit("usable")).alias("reason")).agg(F.count("*").alias("n"))


KEYWORDS = ["the", "The", "and", "de", "der", "of"]


@query("keyword_filter", f"""WITH {FLAT} SELECT id, title FROM judged
WHERE reason IS NULL AND list_has_any(keywords, [{', '.join(f"'{k}'" for k in KEYWORDS)}])""")
def keyword_filter(spark, sf):
    return records.with_keyword(records.usable(records.flatten_records(_landed(spark, sf))), KEYWORDS).select("id", "title")


@query("keyword_index", f"WITH {FLAT} SELECT DISTINCT unnest(keywords) AS keyword, id FROM judged WHERE reason IS NULL")
def keyword_index(spark, sf):
    return records.keyword_index(records.usable(records.flatten_records(_landed(spark, sf))))


@query("ingest_stream", DEDUP_SQL)
def ingest_stream(spark, sf):
    target = fresh_dir(spark, "ingest")
    stream = as_corpus(stream_table(spark, sf, "documents"))
    start_ingest(spark, stream, target, fresh_dir(spark, "ingest-checkpoint"), "fixed_512").awaitTermination()
    return spark.read.parquet(target)


@query("ingest_stateful", f"SELECT content_hash, char_count FROM ({DEDUP_SQL})")
def ingest_stateful(spark, sf):
    """Two runs of one stream: what the second finds is known to the restored state."""
    target, checkpoint = fresh_dir(spark, "ingest"), fresh_dir(spark, "ingest-checkpoint")
    for _ in range(2):
        stream = as_corpus(stream_table(spark, sf, "documents"))
        start_stateful_ingest(spark, stream, target, checkpoint, "fixed_512").awaitTermination()
    return KeyedTable(spark, target).read().select("content_hash", "char_count")
