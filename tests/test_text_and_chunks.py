import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.constants import SWEEP_SIZES
from lodestone.functions import text as t
from lodestone.functions.splitters import split_recursive
from lodestone.operators import chunking as ch
from lodestone.operators import cleaning


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column).first()[0]


def test_strip_and_tokens(spark):
    assert one(spark, t.strip_ws("s"), s="\t\n a b \r\n ") == "a b"
    assert one(spark, t.tokens("s"), s="  The  quick\nBrown\t") == ["the", "quick", "brown"]
    assert one(spark, t.tokens("s"), s="   ") == []


def test_occurrences_do_not_overlap(spark):
    assert one(spark, t.occurrences("s", "aa"), s="AAAA aa a") == 3
    assert one(spark, t.occurrences("s", "lung cancer"), s="none") == 0


def test_previews_and_formats(spark):
    assert one(spark, t.preview("s", 3, suffix="..."), s="abcdef") == "abc..."
    assert one(spark, t.preview("s", 4, one_line=True), s="a\nbcdef") == "a bc"
    assert one(spark, t.percent(F.lit(0.7615))) == "76.2%"
    assert one(spark, t.percent(F.lit(0.5), 0)) == "50%"
    assert one(spark, t.content_hash("s", 12), s="x") == "9dd4e461268c"


@pytest.mark.parametrize("sim,grade", [(0.46, "RELEVANT"), (0.45, "MARGINAL"), (0.30, "MARGINAL"), (0.29, "NOISE")])
def test_grades(spark, sim, grade):
    assert one(spark, t.relevance_grade(F.lit(sim))) == grade


def test_clean_keeps_fifty_and_drops_forty_nine(spark):
    docs = spark.createDataFrame(
        [
            ("a", "\t Title\n", "x" * 50, None),
            ("b", "Title", "x" * 49, ""),
            ("c", "  ", "x" * 80, "full"),
            ("d", "T", "y" * 60 + "\n ", " full "),
            ("e", None, "x" * 80, None),
        ],
        "id string, title string, abstract string, full_text string",
    )
    got = {r["id"]: r for r in cleaning.clean(docs).collect()}
    assert set(got) == {"a", "d"}
    assert got["a"]["combined_text"] == "Title\n\n" + "x" * 50
    assert got["d"]["combined_text"] == "T\n\n" + "y" * 60 + "\n\nfull"
    assert got["a"]["text_length"] == 57


def test_request_validation(spark):
    rows = [("four", 0.5), ("fiver", 0.0), ("fiver", 1.0), ("fiver", 1.5), ("fiver", -0.1), (None, 0.5), ("fiver", None)]
    checked = cleaning.validate_requests(spark.createDataFrame(rows, "query string, confidence double"))
    assert [r["reason"] for r in checked.collect()] == [
        "query too short", None, None, "confidence out of range", "confidence out of range", "query too short", None,
    ]
    accepted, rejected = cleaning.split_accepted(checked)
    assert (accepted.count(), rejected.count()) == (3, 4)


def packed(text, size):
    out, line = [], ""
    for word in [w for w in text.split(" ") if w]:
        if line and len(line) + 1 + len(word) > size:
            out.append(line)
            line = word
        else:
            line = f"{line} {word}" if line else word
    out.append(line)
    return [c.strip() for c in out if c.strip()]


@pytest.mark.parametrize("text", [
    "xxxxxx ab cd", "ab xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx cd ef",
    "aaa bb c dddd eeeeeeeeeeeeeeeeeeee ff", "  double  spaced   text here ", "", "x" * 40, "one\ntwo three\nfour five six",
    "ends with newline\n", "exactly10c exactly10c", "é à ü ß œ " * 9,
])
def test_word_chunks_pack_greedily(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(ch.word_chunks(F.col("s"), 10)).first()[0] == packed(text, 10)


def test_windows(spark):
    def windows(s, size, overlap):
        return one(spark, ch.window_chunks(F.col("s"), size, overlap), s=s)

    assert windows("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]
    assert windows("abcdefghijk", 4, 1) == ["abcd", "defg", "ghij", "jk"]
    assert windows("abc", 4, 1) == ["abc"]
    assert windows("", 4, 1) == []
    assert windows("abcdefgh", 4, 0) == ["abcd", "efgh"]
    with pytest.raises(ValueError):
        ch.window_chunks(F.col("s"), 4, 4)


def test_strategies(spark):
    short, long = "Short text.", "Sentence number one here. " * 60
    docs = spark.createDataFrame([("s", short), ("l", long)], "id string, combined_text string")

    def texts(strategy):
        out = {}
        for r in ch.chunk(docs, strategy).orderBy("doc_id", "chunk_index").collect():
            out.setdefault(r["doc_id"], []).append(r["chunk_text"])
        return out

    natural = texts("natural_paragraph")
    assert natural["s"] == [short]
    assert natural["l"] == split_recursive(long, 900, 90, ["\n\n", "\n", ". ", " "])
    assert texts("document") == {"s": [short], "l": [long]}
    assert texts("sentence_based")["l"] == split_recursive(long, 200, 30, [". ", "! ", "? ", "\n"])
    assert all(len(c) <= 256 for c in texts("fixed_256")["l"])
    with pytest.raises(ValueError, match="unknown strategy"):
        ch.chunk(docs, "nope")


def test_sweep_equals_single_runs(spark):
    docs = spark.createDataFrame([("l", "Sentence number one here. " * 300)], "id string, combined_text string")
    swept = ch.sweep(docs, SWEEP_SIZES)
    for size in SWEEP_SIZES:
        strategy = {"kind": "recursive", "size": size, "overlap": size // 10}
        want = [r["chunk_text"] for r in ch.chunk(docs, strategy).orderBy("chunk_index").collect()]
        got = [r["chunk_text"] for r in swept.filter(F.col("size") == size).orderBy("chunk_index").collect()]
        assert got == want and len(want) > 1


def test_prefix_and_stats(spark):
    docs = spark.createDataFrame([("a", "T" * 100, "body text")], "id string, title string, combined_text string")
    chunks = ch.with_title_prefix(ch.chunk(docs, "document", keep=("title",)))
    assert chunks.first()["chunk_text"] == "[" + "T" * 80 + "] body text"
    row = ch.chunk(docs, "document").first()
    assert (row["chunk_index"], row["char_count"]) == (0, 9)


def test_splitting_holds_a_bounded_part_of_a_batch(spark, monkeypatch):
    """a batch of many texts is split some bytes at a time, in one size at a time."""
    from lodestone.functions import splitters

    monkeypatch.setattr(splitters, "TEXT_AT_ONCE", 1000)
    texts = pa.array(["a b. " * 30, None, "", "c d\n" * 1000, *["e " * 200] * 5])
    held = list(splitters.text_slices(texts))
    assert [lo for lo, _ in held] == [0] + [hi for _, hi in held[:-1]] and held[-1][1] == len(texts)
    assert all(hi - lo == 1 or sum(len(t or "") for t in texts.slice(lo, hi - lo).to_pylist()) <= 1000 for lo, hi in held)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts.to_pylist())], "id long, combined_text string").coalesce(1)
    swept = ch.sweep(docs, [50, 80])
    got = sorted(tuple(r) for r in swept.select("size", "doc_id", "chunk_index", "chunk_text").collect())
    want = [(s, i, n, c) for s in (50, 80) for i, t in enumerate(texts.to_pylist()) for n, c in enumerate(split_recursive(t, s, s // 10, ["\n\n", "\n", ". ", " "]))]
    assert got == sorted(want)
    assert not any(n in swept._jdf.queryExecution().toString() for n in ("ArrowEvalPython", "BatchEvalPython"))
