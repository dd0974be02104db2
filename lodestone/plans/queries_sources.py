"""Readers and sinks over landed copies of the provided tables: each query writes files, then reads them as its source."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.constants import CONDITIONS, DEFAULT_THRESHOLD, NO_FINDING
from lodestone.functions.numbers import settled
from lodestone.functions.unions import union_all
from lodestone.operators import classifier as cl
from lodestone.operators import chunking, cleaning, records, retrieval_eval
from lodestone.operators.encoding import embed, score_items
from lodestone.plans.catalog import query
from lodestone.plans.queries_corpus import FLAT, _landed
from lodestone.plans.queries_search import CENTROIDS
from lodestone.plans.sql import CASES, CLEAN, QUERIES, word_chunks
from lodestone.plans.tables import benchmark_cases, benchmark_topics, centroids, corpus, table
from lodestone.session import fresh_dir
from lodestone.sources import readers, writers
from lodestone.sources.keyed_table import KeyedTable


def _published(spark, sf) -> DataFrame:
    """Documents in corpus form.  Null fields are left out of JSON, so records miss keys as landed ones do."""
    foreign = F.col("lang") != "en"
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("abstract"),
        F.when(foreign, F.col("lang")).alias("year"),
        F.when(foreign, F.array("source")).alias("keywords"),
        "doc_id",
    )


def _read_back(docs: DataFrame) -> DataFrame:
    return docs.select("id", "title", F.md5("abstract").alias("abstract_hash"), "full_text", "year", F.array_join("keywords", "|").alias("keywords"))


PUBLISHED = """published AS (
  SELECT doc_id, doc_id::VARCHAR AS id, coalesce(split_part(text, chr(10), 1), '') AS title, md5(coalesce(text, '')) AS abstract_hash, '' AS full_text,
         CASE WHEN lang <> 'en' THEN lang END AS year, CASE WHEN lang <> 'en' THEN coalesce(source, '') ELSE '' END AS keywords, text FROM documents)"""
BACK = "id, title, abstract_hash, full_text, year, keywords"


@query("landed_corpus", f"WITH {PUBLISHED} SELECT {BACK} FROM published")
def landed_corpus(spark, sf):
    path = writers.write_json(_published(spark, sf).drop("doc_id"), fresh_dir(spark, "landed"))
    return _read_back(readers.read_corpus(spark, path, lines=True))


@query("landed_corpus_array", f"WITH {PUBLISHED} SELECT 'array' AS origin, {BACK} FROM published UNION ALL SELECT 'fallback', {BACK} FROM published")
def landed_corpus_array(spark, sf):
    """The corpus from JSON arrays, and from the fallback where no file has landed."""
    docs = _published(spark, sf).drop("doc_id")
    path = writers.write_json_array(readers.spread(docs), fresh_dir(spark, "landed"))
    fallback = readers.read_corpus(spark, writers.write_json(docs, fresh_dir(spark, "landed")), lines=True)
    found = {"array": path, "fallback": fresh_dir(spark, "nothing")}
    return union_all(*[_read_back(readers.load_corpus(spark, p, fallback)).withColumn("origin", F.lit(name)) for name, p in found.items()])


@query("corpus_cache", f"""WITH {PUBLISHED} SELECT abstract_hash AS id, title, abstract_hash, full_text, year, keywords FROM published WHERE text IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY abstract_hash ORDER BY doc_id) = 1""")
def corpus_cache(spark, sf):
    """Documents found by several searches are written once."""
    found = _published(spark, sf).filter("abstract IS NOT NULL").withColumns({"id": F.md5("abstract"), "full_text": F.lit("")})
    return _read_back(readers.read_corpus(spark, writers.write_corpus_cache(found, fresh_dir(spark, "cache"), ["doc_id"]), lines=True))


@query("corpus_append", f"""WITH {PUBLISHED}, told AS (SELECT *, doc_id IN (SELECT doc_id FROM labels) AS early FROM published WHERE text IS NOT NULL)
SELECT abstract_hash AS id, doc_id, title FROM told QUALIFY row_number() OVER (PARTITION BY abstract_hash ORDER BY early DESC, doc_id) = 1""")
def corpus_append(spark, sf):
    """Labelled documents come first, then all of them, then all of them again."""
    docs = _published(spark, sf).withColumn("id", F.md5("abstract")).select("id", "title", "abstract", "doc_id")
    early, target = table(spark, sf, "labels").select("doc_id"), fresh_dir(spark, "corpus")
    for batch in (docs.join(early, "doc_id", "left_semi").select(*docs.columns), docs, docs):
        writers.append_corpus(spark, batch, target, arrival="doc_id")
    return spark.read.parquet(target).select("id", "doc_id", "title")


def _two_writers(spark, sf) -> tuple[str, dict[str, dict[str, int]]]:
    """Labelled documents and all documents go into one table at a time: both are checked before either is committed."""
    docs = _published(spark, sf).withColumn("pmid", F.md5("abstract")).select("pmid", "title", "abstract", "doc_id")
    early, target = table(spark, sf, "labels").select("doc_id"), fresh_dir(spark, "keyed")
    batches = {"labelled": docs.join(early, "doc_id", "left_semi").select(*docs.columns), "all": docs}
    writers_of = {name: writers.prepare_documents(spark, batch, target, "doc_id") for name, batch in batches.items()}
    return target, {name: insert.commit() for name, insert in writers_of.items()}


@query("keyed_insert_documents", f"""WITH {PUBLISHED}, told AS (SELECT *, doc_id IN (SELECT doc_id FROM labels) AS early FROM published WHERE text IS NOT NULL)
SELECT abstract_hash AS pmid, doc_id, title FROM told QUALIFY row_number() OVER (PARTITION BY abstract_hash ORDER BY early DESC, doc_id) = 1""")
def keyed_insert_documents(spark, sf):
    """After both commits the batches are merged into one."""
    shared = KeyedTable(spark, _two_writers(spark, sf)[0])
    shared.compact()
    return shared.read().select("pmid", "doc_id", "title")


@query("keyed_insert_counts", """WITH told AS (SELECT md5(text) AS h, doc_id IN (SELECT doc_id FROM labels) AS early FROM documents),
n AS (SELECT count(DISTINCT h) AS every, count(DISTINCT CASE WHEN early THEN h END) AS first FROM told)
SELECT 'labelled' AS writer, any_value(first) AS inserted, count(h) - any_value(first) AS skipped, count(*) - count(h) AS errors FROM told CROSS JOIN n WHERE early
UNION ALL SELECT 'all', any_value(every - first), count(h) - any_value(every - first), count(*) - count(h) FROM told CROSS JOIN n""")
def keyed_insert_counts(spark, sf):
    _, counts = _two_writers(spark, sf)
    rows = [(name, *(c[k] for k in ("inserted", "skipped", "errors"))) for name, c in counts.items()]
    return spark.createDataFrame(rows, "writer string, inserted long, skipped long, errors long")


@query("keyed_insert_embeddings", f"""WITH {CLEAN}, {word_chunks(512)}, batch AS (
  SELECT doc_id, chunk_index, md5(chunk_text) AS content_hash, doc_id IN (SELECT doc_id FROM labels) AS early, unnest(['hash32', 'hash64']) AS embedding_model FROM chunks)
SELECT doc_id, chunk_index, content_hash, embedding_model FROM batch
QUALIFY row_number() OVER (PARTITION BY content_hash, embedding_model ORDER BY embedding_model = 'hash64' AND early DESC, doc_id, chunk_index) = 1""")
def keyed_insert_embeddings(spark, sf):
    """Two models' vectors; a writer of the second brings labelled documents while all are on their way."""
    chunks = chunking.chunk(cleaning.clean(corpus(spark, sf)), "fixed_512")
    early, target = table(spark, sf, "labels").select("doc_id"), fresh_dir(spark, "keyed")
    batches = [(chunks.join(early, "doc_id", "left_semi").select(*chunks.columns), "hash64"), (chunks, "hash32"), (chunks, "hash64")]
    inserts = [writers.prepare_embeddings(spark, embed(batch, model), model, "fixed_512", target) for batch, model in batches]
    for insert in inserts:
        insert.commit()
    return KeyedTable(spark, target).read().select("doc_id", "chunk_index", "content_hash", "embedding_model")


def _landed_lines(spark, sf) -> DataFrame:
    """Records as JSON lines; where the page's number has remainder 3 by 7, the line breaks off in the middle."""
    line = F.to_json(F.struct("MedlineCitation"))
    cut = F.col("MedlineCitation.PMID").cast("long") % 7 == 3
    lines = _landed(spark, sf).select(F.when(cut, F.left(line, F.floor(F.length(line) / 2).cast("int"))).otherwise(line).alias("value"))
    path = fresh_dir(spark, "records")
    lines.write.text(path)
    return records.flatten_records(readers.read_raw_records(spark, path))


BROKEN = f"""{FLAT}, told AS (
  SELECT *, CASE WHEN substr(id, 6)::BIGINT % 7 = 3 THEN 'malformed' ELSE reason END AS why FROM judged)"""


@query("landed_records", f"WITH {BROKEN} SELECT id, title, abstract, year, make_date(year, 1, 1) AS publication_date, array_to_string(keywords, '|') AS keywords FROM told WHERE why IS NULL")
def landed_records(spark, sf):
    return records.usable(_landed_lines(spark, sf)).select("id", "title", "abstract", "year", "publication_date", F.array_join("keywords", "|").alias("keywords"))


@query("landed_rejects", f"WITH {BROKEN} SELECT why AS reason, count(*) AS n FROM told WHERE why IS NOT NULL GROUP BY why")
def landed_rejects(spark, sf):
    return records.rejected(_landed_lines(spark, sf)).groupBy("reason").agg(F.count("*").alias("n"))


@query("landed_xml", f"WITH {FLAT} SELECT id, title, abstract, year, array_to_string(keywords, '|') AS keywords FROM judged")
def landed_xml(spark, sf):
    """The same records as XML: the parts of an abstract and the keywords are repeated elements."""
    c = F.col("MedlineCitation")
    parts = F.from_json(c["Article"]["Abstract"]["AbstractText"], "array<string>")
    nested = _landed(spark, sf).select(
        F.struct(
            c["PMID"].alias("PMID"),
            F.struct(
                c["Article"]["ArticleTitle"].alias("ArticleTitle"),
                F.struct(parts.alias("AbstractText")).alias("Abstract"),
                c["Article"]["Journal"].alias("Journal"),
            ).alias("Article"),
            F.struct(F.get(c["KeywordList"], F.lit(0)).alias("Keyword")).alias("KeywordList"),
        ).alias("MedlineCitation")
    )
    path = fresh_dir(spark, "xml")
    nested.write.format("xml").option("rootTag", "PubmedArticleSet").option("rowTag", "PubmedArticle").save(path)
    flat = records.flatten_records(readers.read_raw_xml(spark, path))
    return flat.select("id", "title", "abstract", "year", F.array_join("keywords", "|").alias("keywords"))


@query("landed_labels", f"""SELECT doc_id || '.png' AS image, coalesce(nullif(concat_ws('|', CASE WHEN quality = 1 THEN 'Good' END, CASE WHEN toxic = 1 THEN 'Toxic' END), ''), '{NO_FINDING}') AS findings,
source AS patient_id FROM labels LEFT JOIN documents USING (doc_id)""")
def landed_labels(spark, sf):
    """A label table as CSV, with a column more than is read, under the second of the names it may have."""
    named = F.concat_ws("|", F.when(F.col("quality") == 1, "Good"), F.when(F.col("toxic") == 1, "Toxic"))
    labels = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id", "left").select(
        F.concat("doc_id", F.lit(".png")).alias("Image Index"),
        F.coalesce(F.nullif(named, F.lit("")), F.lit(NO_FINDING)).alias("Finding Labels"),
        F.lit(0).alias("Follow-up #"),
        F.col("source").alias("Patient ID"),
    )
    folder = fresh_dir(spark, "labels")
    labels.write.option("header", True).csv(f"{folder}/{readers.LABEL_FILES[1]}")
    return readers.read_image_labels(spark, folder)


SPELLED = ", ".join(f"({i}, '{c}')" for i, c in enumerate(CONDITIONS))


@query("landed_thresholds", f"""WITH c(label, condition) AS (VALUES {SPELLED}), s AS (SELECT label, round(count(*) / (SELECT count(*) FROM embeddings)::DOUBLE + 1e-9, 6) AS share FROM embeddings GROUP BY label)
SELECT condition, coalesce(share, {DEFAULT_THRESHOLD}::DOUBLE) AS threshold FROM c LEFT JOIN s USING (label)""")
def landed_thresholds(spark, sf):
    """A threshold file with the share of each label, blanks of its names as underscores."""
    per_label = table(spark, sf, "embeddings").groupBy("label").agg(F.count("*").alias("n"))
    names = F.array(*[F.lit(c.replace(" ", "_")) for c in CONDITIONS])
    named = F.when(F.col("label").between(0, len(CONDITIONS) - 1), F.struct(F.get(names, F.col("label")).alias("name"), "n"))
    whole = per_label.agg(F.collect_list(named).alias("each"), F.sum("n").alias("n"))  # at most a row per condition
    shares = F.transform("each", lambda x: F.struct(x["name"], settled(x["n"] / F.col("n"), 6)))
    path = writers.write_json(whole.select(F.map_from_entries(shares).alias("thresholds"), F.lit("share").alias("method")), fresh_dir(spark, "thresholds"))
    return readers.read_thresholds(spark, path)


def _landed_cases(spark, sf) -> str:
    """Test cases as JSON arrays: benchmark items with their long words and their sentences as topics."""
    topics = benchmark_topics(spark, sf).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("topic_pos", "topic")))["topic"].alias("expected_topics"))
    cases = benchmark_cases(spark, sf).join(topics, "query_id", "left").withColumnRenamed("query_id", "id")
    return writers.write_json_array(cases, fresh_dir(spark, "cases"))


TOPICS = r"""topics AS (
  SELECT item_id AS query_id, generate_subscripts(ts, 1)::INTEGER - 1 AS topic_pos, unnest(ts) AS topic
  FROM (SELECT item_id, list_filter(regexp_split_to_array(text, '\.\s*'), lambda s: s <> '') AS ts FROM benchmark))"""


@query("landed_cases", f"WITH {QUERIES}, {CASES} SELECT query_id::INTEGER AS query_id, query, array_to_string(list_sort(expected_keywords), '|') AS keywords, difficulty FROM cases")
def landed_cases(spark, sf):
    cases = readers.read_keyword_cases(spark, _landed_cases(spark, sf))
    return cases.select("query_id", "query", F.array_join(F.array_sort("expected_keywords"), "|").alias("keywords"), "difficulty")


@query("landed_topics", f"WITH {QUERIES}, {CASES}, {TOPICS} SELECT query_id::INTEGER AS query_id, query, difficulty, topic_pos, topic FROM topics JOIN cases USING (query_id)")
def landed_topics(spark, sf):
    return readers.read_topics(spark, _landed_cases(spark, sf))


@query("case_keyword_lookup", f"""WITH {QUERIES}, {CASES}, {TOPICS}, n AS (SELECT query_id, count(*) AS topics FROM topics GROUP BY query_id)
SELECT query_id::INTEGER AS query_id, topics, CASE WHEN difficulty = 'complex' THEN len(expected_keywords) / 100.0::DOUBLE ELSE 0.0::DOUBLE END AS keyword_precision FROM n JOIN cases USING (query_id)""")
def case_keyword_lookup(spark, sf):
    """Keyword figures are there for complex cases only; the others get 0."""
    path = _landed_cases(spark, sf)
    scores = readers.read_topics(spark, path).groupBy("query_id").agg(F.count("*").alias("topics"))
    known = readers.read_keyword_cases(spark, path).filter("difficulty = 'complex'")
    return retrieval_eval.with_case_keywords(scores, known.select("query_id", (F.size("expected_keywords") / 100.0).alias("keyword_precision")))


@query("query_log_append", """SELECT 'q' || event_id AS query_text, event_type AS prediction, substr(repeat(coalesce(props, '') || ' ', 300), 1, 2000) AS response_text,
user_id::VARCHAR AS retrieved, value AS latency_ms, event_type <> 'error' AS success, ts::DATE AS log_date FROM events""")
def query_log_append(spark, sf):
    """Failed requests are appended after the others; the log is partitioned by day and keeps 2,000 characters of a response."""
    responses = table(spark, sf, "events").select(
        F.concat(F.lit("q"), "event_id").alias("query"),
        F.col("event_type").alias("prediction"),
        F.lit(None).cast("double").alias("confidence"),
        F.array(F.col("user_id").cast("string")).alias("retrieved_doc_ids"),
        F.repeat(F.concat(F.coalesce("props", F.lit("")), F.lit(" ")), F.lit(300)).alias("response"),
        F.col("value").alias("latency_ms"),
        (F.col("event_type") != "error").alias("success"),
        F.when(F.col("event_type") == "error", "error").alias("error_message"),
        F.col("ts").alias("created_at"),
    )
    target = fresh_dir(spark, "log")
    for some in ("success", "NOT success"):
        writers.append_query_log(responses.filter(some).repartition(F.to_date("created_at")), target)
    return spark.read.parquet(target).select(
        "query_text", "prediction", "response_text", F.array_join("retrieved_doc_ids", "|").alias("retrieved"), "latency_ms", "success", "log_date"
    )


SHARPNESS = 16.0  # logits per unit of the product of a vector and a label's mean


def label_mean_predictor(items: DataFrame):
    """A model for ``score_items``: a logit per condition, from the product with the mean vector of its label.

    The means, at most one vector per condition, are the model; they are shipped with the predictor.  A condition without
    items gets a logit of 0.
    """
    means = {r["label"]: r["vector"] for r in centroids(items.filter(F.col("label").between(0, len(CONDITIONS) - 1)), "label").collect()}

    def load():
        size = max((len(v) for v in means.values()), default=0)
        weights = np.asarray([means.get(i, [0.0] * size) for i in range(len(CONDITIONS))])
        return lambda vectors: SHARPNESS * (np.asarray(vectors, dtype="float64").reshape(len(vectors), -1) @ weights.T)

    return load


def _vector_scores(spark, sf) -> DataFrame:
    """(vec_id, condition, score, label): what the label means say of every vector, and whether it is so."""
    items = table(spark, sf, "embeddings").filter("embedding IS NOT NULL AND label IS NOT NULL")
    scored = score_items(items, label_mean_predictor(items), "vec_id", "embedding")
    own = items.select("vec_id", F.get(F.array(*[F.lit(c) for c in CONDITIONS]), F.col("label")).alias("own"))
    joined = scored.join(own, "vec_id")
    return joined.select("vec_id", "condition", F.round("score", 4).alias("score"), F.coalesce(F.col("condition") == F.col("own"), F.lit(False)).cast("int").alias("label"))


VECTOR_SCORES = f"""{CENTROIDS}, named(label, condition) AS (VALUES {SPELLED}),
scored AS MATERIALIZED (
  SELECT vec_id, condition, round(1 / (1 + exp(-coalesce({SHARPNESS}::DOUBLE * list_dot_product(v, cv), 0))), 4) AS score, (e.label = named.label)::INTEGER AS label
  FROM e CROSS JOIN named LEFT JOIN c ON c.label = named.label)"""


@query("vector_condition_scores", f"WITH {VECTOR_SCORES} SELECT * FROM scored")
def vector_condition_scores(spark, sf):
    return _vector_scores(spark, sf)


@query("vector_auc", f"""WITH {VECTOR_SCORES}, g AS (SELECT condition, score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY ALL),
steps AS (SELECT *, sum(pos) OVER (PARTITION BY condition ORDER BY score DESC) AS tp FROM g)
SELECT condition, sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives,
  round(CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(neg * (2 * tp - pos)) / (2.0::DOUBLE * sum(pos) * sum(neg)) ELSE 0 END + 1e-9, 6) AS auc FROM steps GROUP BY condition""")
def vector_auc(spark, sf):
    return cl.roc_auc(cl.roc_steps(_vector_scores(spark, sf)))


@query("vector_log_loss", f"""WITH {VECTOR_SCORES}
SELECT condition, round(avg(-CASE WHEN label = 1 THEN ln(p) ELSE ln(1 - p) END) + 1e-9, 6) AS log_loss
FROM (SELECT condition, label, greatest(least(score, 1 - 1e-7::DOUBLE), 1e-7::DOUBLE) AS p FROM scored) GROUP BY condition""")
def vector_log_loss(spark, sf):
    return cl.log_loss(_vector_scores(spark, sf))
