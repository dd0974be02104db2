import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.operators import encoding, fusion, lexical, topk, vector_search
from lodestone.plans import search


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 8))
    base[::3] = base[0]  # a third of all rows is the same vector
    base[7] = 0.0
    data = [(int(i), i % 5, [float(x) for x in v]) for i, v in enumerate(base)]
    items = spark.createDataFrame(data, "item long, grp int, embedding array<double>")
    queries = items.filter("item < 40").select(
        F.col("item").alias("query_id"), F.col("grp"), F.col("embedding").alias("query_vector")
    )
    return base, items, queries


def brute(base, k, same_group=False):
    size = np.linalg.norm(base, axis=1)
    unit = np.divide(base, size[:, None], out=np.zeros_like(base), where=size[:, None] > 0)
    out = set()
    for q in range(40):
        sims = np.round(unit @ unit[q], 6) + 0.0
        pool = [i for i in range(len(base)) if not same_group or i % 5 == q % 5]
        for rank, i in enumerate(sorted(pool, key=lambda i: (-sims[i], i))[:k], 1):
            out.add((q, i, float(sims[i]), rank))
    return out


def found(df):
    return {(r["query_id"], r["item"], r["similarity"] + 0.0, r["rank"]) for r in df.collect()}


def test_scan_is_exact_with_ties(vectors):
    base, items, queries = vectors
    assert found(vector_search.vector_topk(items.repartition(7), queries, ["item"], 6)) == brute(base, 6)


def test_tiles_are_exact(vectors, monkeypatch):
    base, items, queries = vectors
    monkeypatch.setattr(topk, "MAX_BLOCK_QUERIES", 3)
    monkeypatch.setattr(topk, "TILE_ITEMS", 40)
    monkeypatch.setattr(topk, "TILE_QUERIES", 9)
    assert found(vector_search.vector_topk(items, queries, ["item"], 6)) == brute(base, 6)


def test_search_within_keys(vectors, monkeypatch):
    base, items, queries = vectors
    monkeypatch.setattr(topk, "TILE_ITEMS", 25)
    got = found(vector_search.vector_topk_within(items, queries, ["grp"], ["item"], 4))
    assert got == brute(base, 4, same_group=True)


def test_small_steps_and_k_beyond_rows(vectors, monkeypatch):
    base, items, queries = vectors
    monkeypatch.setattr(topk, "CELLS_PER_STEP", 64)
    assert found(vector_search.vector_topk(items, queries, ["item"], 3)) == brute(base, 3)
    few = vector_search.vector_topk(items.filter("item < 4"), queries.filter("query_id = 0"), ["item"], 10)
    assert few.count() == 4


def test_cells_reach_everything_when_all_are_probed(vectors):
    base, items, queries = vectors
    usable = items.filter("item <> 7")
    model = vector_search.fit_cells(usable, lists=5)
    placed = vector_search.assign_cells(usable, model)
    exact = vector_search.vector_topk(usable, queries, ["item"], 5)
    every = vector_search.vector_topk_cells(placed, queries, model, ["item"], 5, nprobe=5)
    assert vector_search.recall_at_k(every, exact, ["item"]).first()[0] == 1.0
    some = vector_search.vector_topk_cells(placed, queries, model, ["item"], 5, nprobe=2)
    assert vector_search.recall_at_k(some, exact, ["item"]).first()[0] >= 0.5


def test_null_vectors_are_left_out(spark):
    items = spark.createDataFrame([(1, None), (2, [1.0, 2.0])], "item long, embedding array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, query_vector array<double>")
    assert [r["item"] for r in vector_search.vector_topk(items, queries, ["item"], 5).collect()] == [2]


def test_mixed_lengths_are_refused(spark):
    items = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "item long, embedding array<double>").coalesce(1)
    queries = spark.createDataFrame([(1, [1.0])], "query_id long, query_vector array<double>")
    with pytest.raises(Exception, match="different lengths"):
        vector_search.vector_topk(items, queries, ["item"], 1).collect()


def bm25_brute(docs, queries, k, k1=1.5, b=0.75):
    toks = {i: t.lower().split() for i, t in docs.items()}
    n, mean = len(docs), sum(map(len, toks.values())) / len(docs)
    out = set()
    for q, text in queries.items():
        scored = []
        for i, ts in toks.items():
            s = 0.0
            for w in text.lower().split():
                tf, df = ts.count(w), sum(w in x for x in toks.values())
                idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                s += idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(ts) / mean))
            if s > 0:
                scored.append((-round(s, 6), i))
        for rank, (s, i) in enumerate(sorted(scored)[:k], 1):
            out.add((q, i, -s, rank))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    docs = {i: " ".join(["the"] + rng.choices(words, k=rng.randint(0, 40))) for i in range(120)}
    docs.update({200 + i: "the the copy text" for i in range(60)})
    queries = {0: "the w1 w2 w2", 1: "Copy", 2: "missing words", 3: "w3 the the", 4: ""}
    return docs, queries


@pytest.mark.parametrize("mode", ["scan", "tiles", "open vocabulary"])
def test_bm25(spark, texts, monkeypatch, mode):
    docs, queries = texts
    if mode == "tiles":
        monkeypatch.setattr(topk, "MAX_BLOCK_QUERIES", 1)
        monkeypatch.setattr(topk, "TILE_ITEMS", 30)
    if mode == "open vocabulary":
        monkeypatch.setattr(lexical, "MAX_VOCABULARY", 2)
    d = spark.createDataFrame(list(docs.items()), "item long, chunk_text string").repartition(5)
    q = spark.createDataFrame(list(queries.items()), "query_id long, query string")
    got = {(r["query_id"], r["item"], round(r["bm25"], 6), r["rank"]) for r in lexical.bm25_topk(d, q, ["item"], 8).collect()}
    want = bm25_brute(docs, queries, 8)
    assert {g[:2] + g[3:] for g in got} == {w[:2] + w[3:] for w in want}
    assert {g for g in got} == {(w[0], w[1], round(w[2], 6), w[3]) for w in want}


def test_bm25_pads_when_asked(spark):
    d = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, "a a")], "item long, chunk_text string")
    q = spark.createDataFrame([(0, "a")], "query_id long, query string")
    padded = lexical.bm25_topk(d, q, ["item"], 5, pad_zero=True).orderBy("rank").collect()
    assert [r["item"] for r in padded] == [3, 1, 2] and padded[-1]["bm25"] == 0.0


def ranked(spark, pairs):
    return spark.createDataFrame([(0, i, r) for r, i in enumerate(pairs, 1)], "query_id int, item int, rank int")


def test_fusion_by_hand(spark):
    a, b = ranked(spark, [10, 20, 30]), ranked(spark, [30, 40])
    got = {r["item"]: r["rrf"] for r in fusion.fuse([(a, 1.0), (b, 2.0)], ["item"]).collect()}
    want = {10: 1 / 61, 20: 1 / 62, 30: 1 / 63 + 2 / 61, 40: 2 / 62}
    assert got == pytest.approx(want, abs=1e-9)
    heavier = {r["item"]: r["rrf"] for r in fusion.fuse([(a, 1.0), (b, 3.0)], ["item"]).collect()}
    assert all(heavier[i] >= got[i] - 1e-12 for i in got)


def test_floor_before_and_after_the_cut(spark):
    items = spark.createDataFrame([(10, [0.1, 1.0]), (20, [1.0, 0.0]), (30, [1.0, 0.1]), (40, [0.9, 0.2])], "item int, embedding array<double>")
    queries = spark.createDataFrame([(0, [1.0, 0.0])], "query_id int, query_vector array<double>")
    a, b = ranked(spark, [10, 20, 30]), ranked(spark, [10, 40])

    def run(**kw):
        out = fusion.weighted_hybrid(a, b, items, queries, ["item"], 2, floor=0.3, **kw)
        return [(r["item"], r["rank"]) for r in out.orderBy("rank").collect()]

    assert run() == [(20, 1), (40, 2)]  # 20 and 40 tie at 1/62, the smaller id first
    assert run(floor_last=True) == [(20, 2)]


def test_rerank(spark):
    texts = spark.createDataFrame([(10, "alpha beta"), (20, "beta"), (30, "alpha beta gamma")], "item int, chunk_text string")
    queries = spark.createDataFrame([(0, "alpha gamma")], "query_id int, query string")
    got = fusion.rerank(ranked(spark, [20, 10, 30]), texts, queries, ["item"], 2).orderBy("rank").collect()
    assert [(r["item"], r["pair_score"]) for r in got] == [(30, 1.0), (10, 0.5)]

    by_column = fusion.rerank(ranked(spark, [20, 10, 30]), texts, queries, ["item"], 1, -F.length("chunk_text").cast("double"))
    assert by_column.first()["item"] == 20

    def longest():
        return lambda pairs: np.array([len(t) for _, t in pairs], dtype=float)

    by_model = fusion.rerank(
        ranked(spark, [20, 10, 30]), texts, queries, ["item"], 1, lambda df: encoding.score_pairs(df, longest)
    )
    assert by_model.first()["item"] == 30


def test_encoder(spark):
    df = spark.createDataFrame([(1, "Alpha beta  alpha"), (2, ""), (3, None), (4, "\t alpha\nBETA alpha ")], "id int, chunk_text string")
    got = {r["id"]: r["embedding"] for r in encoding.embed(df, "hash32").collect()}
    assert all(len(v) == 32 for v in got.values())
    assert np.linalg.norm(got[1]) == pytest.approx(1.0, abs=1e-6) and got[1] == got[4]
    assert not any(got[2]) and not any(got[3])
    want = np.zeros(32)
    for token in ["alpha", "beta", "alpha"]:
        bucket, sign = encoding._bucket_and_sign(token, 32)
        want[bucket] += sign
    assert got[1] == pytest.approx((want / np.linalg.norm(want)).tolist(), abs=1e-6)
    with pytest.raises(ValueError, match="unknown name"):
        encoding.embed(df, "biobert")
    summary = encoding.embedding_summary(encoding.embed(df.withColumn("m", F.lit("x")), "hash32"), ["m"]).first()
    assert (summary["num_chunks"], summary["dimension"]) == (4, 32)


def test_model_is_loaded_once_per_task(spark):
    def factory():
        loaded = [0]

        def encode(texts):
            loaded[0] += 1
            return np.full((len(texts), 1), float(loaded[0]))

        return encode

    df = spark.range(10).select(F.col("id").cast("string").alias("chunk_text")).coalesce(1)
    calls = [r["embedding"][0] for r in encoding.embed(df, factory, batch_size=4).collect()]
    assert calls == [1.0] * 4 + [2.0] * 4 + [3.0] * 2


def test_item_scores(spark):
    def predictor():
        return lambda payloads: [[float(len(p)), 0.0] for p in payloads]

    df = spark.createDataFrame([("i", bytearray(b"ab"))], "item string, content binary")
    got = {r["condition"]: r["score"] for r in encoding.score_items(df, predictor, "item", "content", ["A", "B"]).collect()}
    assert got == pytest.approx({"A": 1 / (1 + math.exp(-2)), "B": 0.5})
    assert encoding.placeholder_scores(df, "item").filter("NOT detected AND probability = 0").count() == 14


def test_batch_requests(spark):
    index = encoding.embed(
        spark.createDataFrame(
            [("d1", 0, "pneumonia antibiotics treatment"), ("d2", 0, "pleural effusion thoracentesis"), ("d3", 0, "unrelated words")],
            "doc_id string, chunk_index int, chunk_text string",
        ), "hash128", precise=True,
    )
    requests = spark.createDataFrame(
        [(1, "what treatment", "unknown", 0.85, "Pneumonia"), (2, "fluid on the lung", "Effusion", 0.5, "")],
        "query_id int, query string, finding string, confidence double, condition string",
    )
    made = {r["query_id"]: r["prompt"] for r in search.batch_query(requests, index, "hash128", k=2).collect()}
    assert "- Prediction: Pneumonia\n- Confidence: 85.0%" in made[1] and "[Source 1] (PMID: d1, relevance: 0." in made[1]
    assert "[Source 1] (PMID: d2" in made[2] and "(2 sources)" in made[2]


def test_encoders_share_a_pass_and_forget(spark, monkeypatch):
    """one Python stage for all encoders, and a bounded memory of tokens."""
    df = spark.createDataFrame([(i, f"word{i} word{i + 1} and x{i * 7}") for i in range(60)] + [(60, "")], "id long, chunk_text string")
    both = encoding.embed_each(df, {"a": "hash32", "b": "hash64"}, precise=True)
    assert both._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    single = encoding.embed(encoding.embed(df, "hash32", out="a", precise=True), "hash64", out="b", precise=True)
    assert both.orderBy("id").collect() == single.orderBy("id").collect()
    texts = [r["chunk_text"] for r in df.collect()]
    want = encoding.hashing_encoder(32)()(texts)
    monkeypatch.setattr(encoding, "KNOWN_TOKENS", 20)
    encode = encoding.hashing_encoder(32)()
    assert np.array_equal(np.concatenate([encode(texts[i : i + 5]) for i in range(0, len(texts), 5)]), want)
    known = next(c.cell_contents for c in encode.__closure__[0].cell_contents.__closure__ if isinstance(c.cell_contents, dict))
    assert len(known) <= 20 + 1 + 5 * 4


def test_requests_with_equal_vectors_are_searched_once(spark, monkeypatch, rows):
    """equal and repeated requests get what each would get alone."""
    chunks = [(i, 0, f"{w} lung {i % 3}") for i, w in enumerate(["heart", "cough", "pain", "heart", "fever", "cough"] * 3)]
    index = encoding.embed(spark.createDataFrame(chunks, "doc_id long, chunk_index int, chunk_text string"), "hash64", precise=True)
    asked = [(1, "heart pain"), (2, "pain heart"), (3, "cough"), (4, "heart  pain"), (4, "heart pain"), (5, "fever"), (5, "cough"), (None, "cough")]
    queries = spark.createDataFrame(asked, "query_id long, query string")
    want = search.retrieve(queries, index, "hash64", 4)
    sent, plain = [], search.vector_topk
    monkeypatch.setattr(search, "vector_topk", lambda items, asked, *a: sent.append(asked.count()) or plain(items, asked, *a))
    got = search.retrieve_alike(queries, index, "hash64", 4)
    assert sent == [3]
    assert rows(got.select(*want.columns)) == rows(want)


def test_cells_of_a_mask():
    mask = np.random.default_rng(3).random((70, 33)) < 0.1
    for m in (mask, mask.T, mask[:0], mask & False):
        assert all(np.array_equal(a, b) for a, b in zip(topk.cells_of(m), np.nonzero(m)))


def test_wide_blocks_and_narrow_products(vectors, monkeypatch):
    """a scan of the items serves four times the queries, and a product stays small whatever their number."""
    base, items, queries = vectors
    scans, plain, sizes, matmul = [], topk.topk_scan, [], np.matmul
    monkeypatch.setattr(topk, "topk_scan", lambda *a: scans.append(a[1].num_rows) or plain(*a))
    many = queries.count()
    monkeypatch.setattr(topk, "MAX_BLOCK_QUERIES", -(-many // 4))
    assert found(vector_search.vector_topk(items, queries, ["item"], 6)) == brute(base, 6) and scans == [many]
    rng = np.random.default_rng(2)
    rows, asked = rng.normal(size=(1500, 6)), rng.normal(size=(700, 6))
    vector = lambda m: pa.array(m.tolist())
    monkeypatch.setattr(np, "matmul", lambda a, b, out=None: sizes.append((len(a), b.shape[1])) or matmul(a, b, out=out))
    batch = pa.RecordBatch.from_pydict({"item": list(range(1500)), "embedding": vector(rows)})
    best = topk._best_of([batch], vector_search.CosineScorer(pa.table({"query_id": list(range(700)), "query_vector": vector(asked)}), "embedding"), ["item"], 4).compact()
    assert max(r * q for r, q in sizes) <= topk.ROWS_AT_ONCE * topk.QUERIES_AT_ONCE
    cosines = np.round((rows / np.linalg.norm(rows, axis=1)[:, None]) @ (asked / np.linalg.norm(asked, axis=1)[:, None]).T, 6)
    want = np.argsort(-cosines, axis=0, kind="stable")[:4]
    assert best.sort_values(["_q", "_score", "item"], ascending=[True, False, True])["item"].tolist() == want.T.ravel().tolist()
