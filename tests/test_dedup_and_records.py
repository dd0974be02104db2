import json

import pytest
from pyspark.sql import functions as F

from lodestone.operators import dedup, records
from lodestone.session import fresh_dir
from lodestone.sources import readers, writers


@pytest.mark.parametrize("parts", [1, 8])
def test_first_chunk_survives_whatever_the_partitioning(spark, rows, parts):
    data = [(f"d{i % 50:02d}", i // 50, "same" if i % 3 == 0 else f"t{i % 97}") for i in range(600)]
    want = {}
    for doc, idx, text in sorted(data):
        want.setdefault(text, (doc, idx))
    df = spark.createDataFrame(data[::-1], "doc_id string, chunk_index int, chunk_text string").repartition(parts)
    got = dedup.dedup_chunks(df.withColumn("content_hash", F.md5("chunk_text")))
    assert {r["chunk_text"]: (r["doc_id"], r["chunk_index"]) for r in got.collect()} == want
    assert rows(dedup.dedup_chunks(got)) == rows(got)  # idempotent


def test_first_term_wins_and_running_total(spark, rows):
    data = [("a", 0, 0), ("b", 0, 1), ("a", 1, 0), ("c", 1, 1), ("b", 2, 0), ("d", 3, 0)]
    df = spark.createDataFrame(data, "id string, term_pos int, pos int")
    assert rows(dedup.first_by_term(df)) == [("a", 0, 0), ("b", 0, 1), ("c", 1, 1), ("d", 3, 0)]
    assert rows(dedup.running_unique(df)) == [(0, 2, 2), (1, 1, 3), (2, 0, 3), (3, 1, 4)]


def test_insert_if_absent_is_idempotent(spark):
    target = fresh_dir(spark, "t")
    batch = spark.createDataFrame([("k1", 1), ("k1", 2), ("k2", 3), (None, 4)], "key string, v int")
    first = writers.insert_if_absent(spark, batch, target, ["key"], ["v"])
    assert first == {"inserted": 2, "skipped": 1, "errors": 1}
    again = writers.insert_if_absent(spark, batch, target, ["key"], ["v"])
    assert again == {"inserted": 0, "skipped": 3, "errors": 1}
    more = spark.createDataFrame([("k2", 0), ("k3", 9)], "key string, v int")
    assert writers.insert_if_absent(spark, more, target, ["key"], ["v"])["inserted"] == 1
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [("k1", 1), ("k2", 3), ("k3", 9)]
    counts = dedup.insert_counts(batch, spark.createDataFrame([("k2",)], "key string"), "key").first()
    assert tuple(counts) == (1, 2, 1)


def test_documents_embeddings_and_corpus_inserts(spark):
    docs = spark.createDataFrame(
        [("1", "T", "A", ["x"]), ("2", "T2", "A2", [])], "pmid string, title string, abstract string, keywords array<string>"
    )
    target = fresh_dir(spark, "docs")
    assert writers.insert_documents(spark, docs, target)["inserted"] == 2
    assert writers.insert_documents(spark, docs, target)["inserted"] == 0

    emb = spark.createDataFrame(
        [("d", 0, "txt", "h", [1.0]), ("e", 0, "txt", "h", [1.0])],
        "doc_id string, chunk_index int, chunk_text string, content_hash string, embedding array<float>",
    )
    target = fresh_dir(spark, "emb")
    assert writers.insert_embeddings(spark, emb, "m1", "s", target) == {"inserted": 1, "skipped": 1, "errors": 0}
    assert writers.insert_embeddings(spark, emb, "m2", "s", target)["inserted"] == 1
    assert readers.load_index(spark, target, "m1", "s").first()["doc_id"] == "d"

    corpus = spark.createDataFrame([("a", "t", "x"), ("b", "t", "x")], "id string, title string, abstract string")
    target = fresh_dir(spark, "corpus")
    assert writers.append_corpus(spark, corpus.limit(1), target)["inserted"] == 1
    assert writers.append_corpus(spark, corpus, target) == {"inserted": 1, "skipped": 1, "errors": 0}


LONG = "This abstract is certainly longer than fifty characters in all."


def raw(pmid, title=None, abstract=None, year=None, keywords=None):
    article = {"ArticleTitle": title, "Abstract": {"AbstractText": abstract}}
    if year:
        article["Journal"] = {"JournalIssue": {"PubDate": {"Year": year}}}
    out = {"MedlineCitation": {"PMID": pmid, "Article": article}}
    if keywords:
        out["MedlineCitation"]["KeywordList"] = keywords
    return json.dumps(out)


def test_flatten(spark, tmp_path):
    lines = [
        raw("1", " A title ", [LONG, "Second part."], "2019", [["k1", "k2"], ["other"]]),
        raw("2", "Scalar", LONG, None),
        raw("3", "", LONG, "2020"),
        raw("4", "Short", "tiny", "2020"),
        raw("5", "Odd year", LONG, "spring"),
        "{not json",
    ]
    (tmp_path / "raw.jsonl").write_text("\n".join(lines))
    flat = records.flatten_records(readers.read_raw_records(spark, str(tmp_path / "raw.jsonl")))
    good = {r["id"]: r for r in records.usable(flat).collect()}
    assert set(good) == {"PMID:1", "PMID:2", "PMID:5"}
    assert good["PMID:1"]["abstract"] == LONG + " Second part."
    assert good["PMID:1"]["title"] == "A title" and good["PMID:1"]["keywords"] == ["k1", "k2"]
    assert str(good["PMID:1"]["publication_date"]) == "2019-01-01"
    assert good["PMID:2"]["abstract"] == LONG and good["PMID:2"]["keywords"] == []
    assert good["PMID:2"]["year"] is None and good["PMID:5"]["year"] is None
    assert sorted(r["reason"] for r in records.rejected(flat).collect()) == ["malformed", "no title", "short abstract"]
    dated = records.flatten_records(readers.read_raw_records(spark, str(tmp_path / "raw.jsonl")), default_year=2020)
    assert {r["year"] for r in records.usable(dated).collect()} == {2019, 2020}
    assert [r["id"] for r in records.with_keyword(records.usable(flat), ["k2", "z"]).collect()] == ["PMID:1"]
    assert records.keyword_index(records.usable(flat)).count() == 2


def test_xml_records(spark, tmp_path):
    (tmp_path / "r.xml").write_text(
        "<Set><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>X</ArticleTitle><Abstract>"
        f"<AbstractText>{LONG}</AbstractText><AbstractText>More.</AbstractText></Abstract><Journal><JournalIssue><PubDate>"
        "<Year>2001</Year></PubDate></JournalIssue></Journal></Article><KeywordList><Keyword>k</Keyword></KeywordList>"
        "</MedlineCitation></PubmedArticle></Set>"
    )
    row = records.usable(records.flatten_records(readers.read_raw_xml(spark, str(tmp_path / "r.xml")))).first()
    assert (row["id"], row["abstract"], row["year"], row["keywords"]) == ("PMID:7", LONG + " More.", 2001, ["k"])
