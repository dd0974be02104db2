"""Every operator against a plain version, on rows with all the odd cases."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lodestone.llm import bit_mixing as M
from lodestone.llm import bit_slices, lsa_votes, warc
from lodestone.llm.anchors import repeat_report, without_repeats
from lodestone.llm.bpe import decode_documents, encode_documents, round_trip_digests
from lodestone.llm.duck_bpe import Merger, merger, read_ranks
from lodestone.llm.mixing_lm import mixing_scores
from lodestone.llm.near_dups import near_duplicates, without_near_duplicates
from lodestone.llm.rans import CHECK_STEPS, Decoder, Encoder, Table
from lodestone.llm.suffixes import contamination_report, remove_contaminated, verbatim_matches
from lodestone.llm.token_counts import token_counts
from lodestone.llm.token_files import read_token_digests, read_token_files, write_token_files
from lodestone.llm.words import mix as words_mix
from lodestone.session import fresh_dir, materialise

HF, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shingles string, _id long, label int, word string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


def passage(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 400, n))


SHARED = passage(1, 120)
ITEM = passage(2, 30)
TEXTS = [
    None, "", " ", "\n \n", "one", "ONE", "one two", "a  b   c ", "x \n \ny\t z", "naïve café — 日本語 テスト", "it's <|endoftext|> 12 34!!",
    SHARED, SHARED, SHARED.upper(), f"start {SHARED} end", passage(3, 70), f"{passage(4, 60)} {SHARED} {passage(5, 60)}",
    passage(6, 300), passage(6, 300) + " tail", "head " + passage(6, 299), "dup " * 200, f"{passage(7, 40)} {ITEM} {passage(8, 40)}",
    "q" * 5000 + " " + "ab" * 900, " ".join(ITEM.split()[:13]), "\x00 nul \x1c sep nbsp  ", passage(9, 4000),
]


@pytest.fixture(scope="module")
def rows():
    return [(3 * i + 1 - (i == 12) * 29, t) for i, t in enumerate(TEXTS)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None, "x", 7, 1, "w") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_token_files(spark, docs, none, rows):
    tokenizer = Tokenizer.from_file(HF)
    tokenizer.encode_special_tokens = True
    want, at = [], 0
    for i, t in sorted(rows):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, at, len(ids), ids))
        at += len(ids)
    path = fresh_dir(spark, "t")
    write_token_files(docs, path, HF, P.PATTERN)
    assert sorted(tuple(r) for r in read_token_files(spark, path).collect()) == want
    crc = {i: zlib.crc32(np.array(ids, "<u4").tobytes()) for i, _, _, ids in want}
    assert {r.doc_id: r.ids_crc32 for r in read_token_digests(spark, path).collect()} == crc
    empty = fresh_dir(spark, "t")
    write_token_files(none, empty, HF, P.PATTERN)
    assert read_token_digests(spark, empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 5_000, 300_000])
def test_rans_round_trip_and_checkpoints(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 50_000).astype(np.uint32)
    table = Table.from_bytes(Table.of(ids).to_bytes())
    block = Encoder(table).block(ids)
    decoder = Decoder(table)
    assert (decoder.block(block) == ids).all()
    for k in range(len(block["check_at"])):  # every span by itself
        lo = k * CHECK_STEPS * block["lanes"]
        assert (decoder.span(block, k) == ids[lo : lo + CHECK_STEPS * block["lanes"]]).all()
    with pytest.raises(ValueError):
        decoder.block(block | {"crc32": block["crc32"] ^ 1})


def test_byte_bpe(docs, none, rows):
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    got = by_id(round_trip_digests(docs, RANKS, P.PATTERN))
    for i, t in rows:
        ids = np.array(plain.encode_ordinary(t or ""), "<u4").tobytes()
        assert tuple(got[i]) == (i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()), t
    back = by_id(decode_documents(encode_documents(docs, RANKS, P.PATTERN), RANKS))
    assert {i: back[i].text for i, _ in rows} == {i: t or "" for i, t in rows}
    assert round_trip_digests(none, RANKS, P.PATTERN).count() == 0


UNBROKEN = {
    "letters": lambda rng, n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n)),
    "four letters": lambda rng, n: "".join(rng.choice(list("ACGT"), n)),
    "words": lambda rng, n: "".join(rng.choice(["there", "ther", "he", "ing", "ation", "ance", "tion"], n // 4)),
    "one letter": lambda rng, n: "a" * n,
    "no spaces": lambda rng, n: "".join(map(chr, rng.integers(0xE01, 0xE2E, n // 3))),
}


@pytest.mark.parametrize("kind", UNBROKEN)
@pytest.mark.parametrize("size", [65, 300, 20_000])
def test_byte_bpe_of_long_pieces(kind, size):
    text = UNBROKEN[kind](np.random.default_rng(size), size)
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    assert merger(RANKS).encode([text.encode()])[0].tolist() == plain.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=2, max_size=5), max_size=12, unique=True), st.text("abc", min_size=65, max_size=120))
def test_byte_bpe_of_any_vocabulary(tokens, text):
    """Ranks that no training would give: a contraction can make a pair of a smaller rank."""
    ranks = {bytes([b]): b for b in range(256)} | {t.encode(): 256 + k for k, t in enumerate(tokens)}
    plain = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    own = Merger(ranks)
    assert own.encode([text.encode()])[0].tolist() == plain.encode_ordinary(text)
    assert own._contract_long(text.encode()).tolist() == plain.encode_ordinary(text)


def test_byte_bpe_of_a_megabyte_without_a_blank():
    started = time.monotonic()
    for kind in ("letters", "four letters", "one letter"):
        text = UNBROKEN[kind](np.random.default_rng(1), 1 << 20).encode()
        ids, many = merger(RANKS).encode([text])
        assert many.tolist() == [len(ids)] and merger(RANKS).decode(ids.astype(np.int32), np.zeros(len(ids), np.int32), 1) == [text]
    assert time.monotonic() - started < 120


def test_anchor_dedup(docs, none, rows):
    seen, want = {}, {}
    for i, t in sorted(rows):
        words = WORDS.findall(t or "")
        gone = set()
        for p in range(len(words) - 49):
            if seen.setdefault(tuple(words[p : p + 50]), i) < i:
                gone.update(range(p, p + 50))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        want[i] = (i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    assert {i: tuple(r) for i, r in by_id(repeat_report(docs)).items()} == want
    cut = without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert {i: hashlib.sha256(" ".join(WORDS.findall(r.text or "")).encode()).hexdigest() for i, r in by_id(cut).items()} == {i: w[3] for i, w in want.items()}
    assert repeat_report(none).count() == 0
    # repeated rows stay as many as they are; a null id neither takes nor loses
    twice = docs.unionByName(docs).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(SHARED)))
    out = repeat_report(twice).collect()
    assert Counter(tuple(r) for r in out if r.doc_id is not None) == Counter({w: 2 for w in want.values()})
    assert [r.n_removed for r in out if r.doc_id is None] == [0]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, none, rows, width):
    sets = {}
    for i, t in rows:
        w = WORDS.findall(lower(t or ""))
        sets[i] = {tuple(w[p : p + width]) for p in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = min(label[a], label[b])
    got = by_id(near_duplicates(docs, width))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), label[i], label[i] == i) for i in sets}
    left = without_near_duplicates(docs, width)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i in sets if label[i] == i}
    assert near_duplicates(none, width).count() == 0


def test_contamination(spark, docs, none, rows):
    items = [(1, ITEM), (2, "ONE"), (10, passage(6, 20)), (11, None), (12, "..."), (13, ITEM)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t in rows:
        words, hit, found = ALNUM.findall(lower(t or "")), set(), set()
        for item, text in items:
            line = ALNUM.findall(lower(text or ""))
            width = min(13, len(line))
            windows = {tuple(line[p : p + width]) for p in range(len(line) - width + 1)} if width else set()
            for p in range(len(words) - width + 1):
                if tuple(words[p : p + width]) in windows:
                    hit.update(range(p, p + width))
                    found.add(str(item))
        names = ",".join(sorted(found))
        want[i] = (i, len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(words))
    assert {i: tuple(r) for i, r in by_id(contamination_report(docs, bench)).items()} == want
    left = remove_contaminated(docs, bench)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i, w in want.items() if not w[5]}
    matches = verbatim_matches(docs, bench).filter("item_id = '1'").collect()
    assert max(m.n_words for m in matches) == 30
    assert contamination_report(none, bench).count() == 0
    assert not any(r.contaminated for r in contamination_report(docs, bench.limit(0)).collect())


def test_contamination_in_blocks(spark, docs, monkeypatch):
    from lodestone.llm import suffixes

    bench = spark.createDataFrame([(1, ITEM), (2, "ONE"), (10, passage(6, 20))], "item_id long, text string")
    want = sorted(map(tuple, contamination_report(docs, bench).collect()))
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 200)
    assert sorted(map(tuple, contamination_report(docs, bench).collect())) == want


def test_token_counts(docs, none, rows):
    tokenizer = Tokenizer.from_file(HF)
    tokenizer.encode_special_tokens = True
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    got = {(r.doc_id, r.part): (r.begin, r.n_chars, r.n_tokens) for r in token_counts(docs, lines, "\n", HF, P.PATTERN).collect()}
    want = {}
    for i, t in rows:
        parts, at, spans = (t or "").split("\n"), 0, []
        for k, part in enumerate(parts):
            size = len(part) + (k + 1 < len(parts))
            spans.append((at, at + size))
            at += size
        many = [0] * len(parts)
        for b, e in tokenizer.encode(t or "", add_special_tokens=False).offsets:
            many[max(range(len(parts)), key=lambda k: (min(e, spans[k][1]) - max(b, spans[k][0]), -k))] += 1
        want |= {(i, k): (s[0], s[1] - s[0], n) for k, (s, n) in enumerate(zip(spans, many))}
    assert got == want
    assert token_counts(none, lines, "\n", HF, P.PATTERN).count() == 0


def test_added_tokens_have_their_own_ids(spark, tmp_path):
    """The registered queries against the tokenizer as it is loaded."""
    from lodestone.llm.queries import QUERIES

    mark = "<|endoftext|>"
    texts = ["a <|endoftext|> b", mark, mark * 3, f" {mark}\n\n{mark} ", f"é{mark}日本 {mark[:-1]} {mark}x", f"one\ntwo{mark}\n  three", "plain text", None, "", f"{'w ' * 400}{mark}{' v' * 400}"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(HF)
    want = {i: tokenizer.encode(t or "", add_special_tokens=False) for i, t in enumerate(texts)}
    assert want[0].ids == [64, 220, 50256, 275]
    got = by_id(QUERIES["op1_token_files"](spark, str(tmp_path)))
    at = 0
    for i, e in want.items():
        ids = [*e.ids, 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), texts[i]
        at += len(ids)
    many = Counter()
    for r in QUERIES["op8_token_counts"](spark, str(tmp_path)).collect():
        many[r.doc_id] += r.n_tokens
    assert dict(many) == {i: len(e.ids) for i, e in want.items()}
    counts = {(r.part): r.n_tokens for r in QUERIES["op8_token_counts"](spark, str(tmp_path)).filter("doc_id = 5").collect()}
    spans, lines = want[5].offsets, [(0, 4), (4, 21), (21, 28)]
    assert counts == {k: sum(max(range(3), key=lambda p: (min(e, lines[p][1]) - max(b, lines[p][0]), -p)) == k for b, e in spans) for k in range(3)}


def test_mixing_scores(docs, none, rows):
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    tokens = {i: [*WORDS.findall(lower(t or "")), None] for i, t in rows}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, r in by_id(mixing_scores(docs)).items():
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[i])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(tokens[i]), sum(counts[w] > 0 for w in tokens[i]), n)
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert mixing_scores(none).count() == 0


def test_bit_slices(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(230, 9)).round(2)
    x[7] = x[8]
    rows = [(k, [float(v) for v in row], "x") for k, row in enumerate(x)] + [(300, None, "x"), (301, [1.0, None], "x"), (302, [float("nan")], "x"), (303, [float("inf")], "x"), (None, [1.0], "x"), (304, [2.0], "x"), (305, [], "x")]
    other = [float(v) for v in rng.normal(size=9).round(2)]
    rows += [(40, other, "x"), (60, rows[60][1], "x")]  # a query of two vectors, and one that is there twice
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, q string").repartition(4)
    whole = {k: np.floor(256 * row).astype(int) for k, row in enumerate(x)}
    whole |= {304: np.array([512] + [0] * 8), 305: np.zeros(9, int)}
    items = [*whole.items(), (40, np.floor(256 * np.array(other)).astype(int)), (60, whole[60])]
    want = []
    for q in sorted({k for k, _ in items if k % 20 == 0}):
        for no, vector in enumerate(sorted({tuple(v.tolist()) for k, v in items if k == q}), 1):
            best = sorted((-int(np.array(vector) @ v), k) for k, v in items if k != q)[:5]
            want += [(q, no, r + 1, k, -s) for r, (s, k) in enumerate(best)]
    got = bit_slices.topk(df, F.col("id") % 20 == 0, 5)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert bit_slices.topk(df.limit(0), F.col("id") % 20 == 0, 5).count() == 0
    assert bit_slices.topk(df.filter("vec_id IN (0, 3)"), F.col("id") % 20 == 0, 5).count() == 1


def test_warc_round_trip(spark):
    html = '<html lang="en"><title>A &amp; B\r\n</title><script>"<p>"</script><p>One<br>two &lt;3<!-- x --></p><a href="/l?WARC/1.1">l</a>'
    rows = [("<urn:uuid:1>", "http://a/\r\nx", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nX-A: b", html, 1), (None, None, None, None, None, 2), ("<urn:uuid:3>", "http://b", "d", "", "", 3)]
    responses = spark.createDataFrame(rows, "record_id string, target_uri string, date string, http_headers string, payload string, block int")
    records = warc.derivatives(responses)
    path = fresh_dir(spark, "w")
    warc.write_warc(records, path)
    back = warc.read_warc(spark, path)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, records.select(back.columns).collect()), key=repr)
    text = {r.refers_to: r.block for r in back.filter("warc_type = 'conversion'").collect()}
    assert text == {"<urn:uuid:1>": "One\ntwo <3\nl", "": "", "<urn:uuid:3>": ""}
    meta = back.filter("warc_type = 'metadata' AND refers_to = '<urn:uuid:1>'").first().block
    assert "title: A & B\r\n" in meta and "source-header: X-A: b\r\n" in meta and "outlink: /l?WARC/1.1\r\n" in meta
    assert warc.derivatives(responses.limit(0)).count() == 0


def test_warc_references_and_attributes(spark):
    references = [
        "&copy;&middot;&hellip;", "&#8217;&#xE9;&#X1F600;", "&copy 2024 &ampx &notit; &notin;", "&amp;lt; &amp;#65;", "&#128;&#x9f;", "&#0;&#xD800;&#x110000;&#99999999999999999999;",
        "a && b &nosuch; &; &#; &#x; &", "&#0000065;&#x000041;", "&NotEqualTilde;&fjlig;", "x&nbsp;&#160;&#xa0;y",
    ]
    want = [
        "©·…", "’é😀", "© 2024 &x ¬it; ∉", "&lt; &#65;", "€Ÿ", "\ufffd" * 4,
        "a && b &nosuch; &; &#; &#x; &", "AA", "≂̸fj", "x y",
    ]
    html = "<HTML class=x lang='de-AT'><title>" + references[0] + "</title><p>" + "<p>".join(references) + "<p>"
    links = """<a href='/single'>1</a><A class=b HREF=/bare?x=1&y=2 id=k>2</A><a title="x > y" href = "/late">3</a><a data-href="/no">4</a><a
    href="/it's">5</a><abbr href="/no">6</abbr><a href>7</a><a name='href="/no"' href=/yes/>8</a>"""
    rows = [("<urn:uuid:1>", "u", "d", "", html + links), ("<urn:uuid:2>", "u", "d", "", "<p>none")]
    records = warc.derivatives(spark.createDataFrame(rows, "record_id string, target_uri string, date string, http_headers string, payload string"))
    blocks = {(r.refers_to[-2], r.warc_type): r.block for r in records.collect()}
    assert blocks["1", "conversion"].split("\n")[: len(want)] == want
    meta = blocks["1", "metadata"].split("\r\n")
    assert "title: ©·…" in meta and "lang: de-AT" in meta and "lang: " in blocks["2", "metadata"].split("\r\n")
    assert [m[9:] for m in meta if m.startswith("outlink: ")] == ["/single", "/bare?x=1&y=2", "/late", "/it's", "/yes/"]


def test_quality_votes(spark, none):
    good = [(i, " ".join(f"word{(i * 7 + k) % 90} is" for k in range(40)) + ".") for i in range(200)]
    bad = [(1000 + i, " ".join(f"WORD{(i * 5 + k) % 90}!!" for k in range(40))) for i in range(60)]
    docs = frame(spark, [*good, *bad, (5000, None), (5001, "")])
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in good + bad] + [(5001, None, 0)], "doc_id long, quality int, toxic int")
    got = by_id(lsa_votes.score(docs, lsa_votes.fit(docs, labels)))
    assert all(r.predicted == int(i < 1000) for i, r in got.items() if i < 5000)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    # the held-out fold's labels don't matter
    flipped = labels.withColumn("quality", F.when(lsa_votes.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = by_id(lsa_votes.score(docs, lsa_votes.fit(docs, flipped)))
    assert {i: r.score for i, r in again.items()} == {i: r.score for i, r in got.items()}
    kept = lsa_votes.keep_good(docs, lsa_votes.fit(docs, labels))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {i for i, _ in good}
    assert lsa_votes.score(none, lsa_votes.fit(none, labels)).count() == 0


def test_quality_votes_against_plain_cosines(docs, rows, spark):
    """Every document beside every labelled vector, one pair after another, sorted in full."""
    labels = spark.createDataFrame([(i, k % 3 % 2) for k, (i, _) in enumerate(rows)], "doc_id long, quality int")
    model = lsa_votes.fit(docs, labels)
    x = lsa_votes.features(pa.array([t or "" for _, t in rows]))
    train = [k for k, (i, _) in sorted(enumerate(rows), key=lambda r: r[1][0]) if zlib.crc32(str(i).encode()) % 5 != 0]
    truth = np.array([k % 3 % 2 for k in train])
    weight = 1 + np.log((1 + len(train)) / (1 + (x[train] > 0).sum(axis=0)))
    assert np.allclose(model.weight, weight, atol=1e-5) and model.labels.tolist() == truth.tolist()
    length = lambda v: math.sqrt(float(v @ v))
    known = [(x[k] * model.weight / max(length(x[k] * model.weight), 1e-12)) @ model.axes for k in train]
    assert all(np.allclose(z / max(length(z), 1e-12), m, atol=1e-4) for z, m in zip(known, model.known))
    got = by_id(lsa_votes.score(docs, model))
    for k, (i, t) in enumerate(rows):
        z = (x[k] * model.weight) @ model.axes
        cosines = [float(z @ m) / max(length(z), 1e-12) for m in model.known]
        near = sorted(range(len(train)), key=lambda j: -cosines[j])[:15]
        votes = [max(cosines[j], 0) ** 8 for j in near]
        want = sum(v * truth[j] for v, j in zip(votes, near)) / sum(votes) if np.abs(x[k]).sum() and sum(votes) else truth.mean()
        assert got[i].score == pytest.approx(want, abs=5e-3), t
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and got[i].predicted == int(got[i].score >= 0.3)
    again = lsa_votes.score(docs.unionByName(docs), model).collect()  # repeated rows are each scored
    assert Counter((r.doc_id, round(r.score, 6)) for r in again) == Counter({(i, round(r.score, 6)): 2 for i, r in got.items()})


def plain_mixer(model, unit: bytes) -> float:
    """log10 of the probability of a unit, a bit at a time."""
    mask, out = (1 << 64) - 1, 0.0
    hashed = lambda v: int(words_mix(np.array([v & mask], np.uint64))[0])
    near, whole = 0, 0x1234567
    for place, byte in enumerate(unit):
        contexts = [near & (1 << 8 * k) - 1 for k in M.ORDERS] + [whole]
        seeds = [hashed(c + (0x9E3779B97F4A7C15 * (k + 1) & mask)) for k, c in enumerate(contexts)]
        node = 1
        for bit in range(7, -1, -1):
            slots = [(((s ^ node * 0xD6E8FEB86659FD93 & mask) * 0xBF58476D1CE4E5B9 & mask) >> 64 - b) + int(o) for s, b, o in zip(seeds, M.TABLE_BITS, M.OFFSETS)]
            zeros, ones = model["counts"][0::2], model["counts"][1::2]
            level = int(min(math.log2(zeros[slots[-1]] + ones[slots[-1]] + 1), M.EVIDENCE - 1))
            weights = model["weights"][:, (bit * M.PLACES + min(place, M.PLACES - 1)) * M.EVIDENCE + level]
            mixed = 0.3 * weights[-1] + sum(w * math.log((ones[s] + 0.4) / (zeros[s] + 0.4)) for w, s in zip(weights, slots))
            refined = model["refined"][node * M.BUCKETS + round((min(max(mixed, -8), 8) + 8) * (M.BUCKETS - 1) / 16)]
            one = 0.25 / (1 + math.exp(-mixed)) + 0.75 * refined
            y = byte >> bit & 1
            out += math.log10(min(max(one if y else 1 - one, 1e-7), 1))
            node = node * 2 + y
        near = (near << 8 | byte) & mask
        whole = hashed(whole ^ (byte + 0x100) * 0x2545F4914F6CDD1D)
    return out


def test_bit_mixer_against_a_plain_one():
    units = [b" the\xff", b" then\xff", b"there\xff", "né".encode() + b"\xff", b"\xfe", b" 123\xff", b"the" * 30 + b"\xff"]
    data, sizes = np.frombuffer(b"".join(units), np.uint8), np.array([len(u) for u in units])
    walk = M.Walk(data, np.cumsum(sizes) - sizes, sizes)
    counts, weights, outcomes = np.zeros(2 * M.SLOTS, np.int64), M.start_weights(), np.zeros(2 * 256 * M.BUCKETS)
    M.count(counts, walk, np.ones(len(units), np.int64))
    assert counts.sum() == 8 * sizes.sum() * len(M.TABLE_BITS)
    counts = counts.astype(np.float32)
    M.learn(counts, weights, outcomes, walk, np.ones(len(units), np.int64))
    assert outcomes.sum() == 8 * sizes.sum() and (weights != M.start_weights()).any()
    model = {"counts": counts, "weights": weights, "refined": M.refinement(outcomes)}
    fresh = [*units, b"unseen\xff", b"\x00\xff"]
    data, sizes = np.frombuffer(b"".join(fresh), np.uint8), np.array([len(u) for u in fresh])
    got = M.Scorer(**model).log10(data, np.cumsum(sizes) - sizes, sizes)
    assert got == pytest.approx([plain_mixer(model, u) for u in fresh], rel=2e-2)


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = materialise(stage(spark, docs, sf), "stage")
        assert docs.columns == columns, name
        assert docs.join(before, "doc_id", "left_anti").isEmpty() and 0 < docs.count() <= before.count()
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf).collect()) == sorted(r.doc_id for r in docs.collect())


def test_warc_outlinks_are_decoded_and_shown_ones_only(spark):
    html = '<html lang="a&amp;b"><!-- <a href="/hidden"> --><script>x = '+"'"+'<a href="/script">'+"'"+'</script><a href="/p?a=1&amp;b=2">x</a><a href="/q?a=1&b=2">y</a>'
    rows = [("<urn:uuid:1>", "http://x", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK", html)]
    records = warc.derivatives(spark.createDataFrame(rows, "record_id string, target_uri string, date string, http_headers string, payload string"))
    meta = records.filter("warc_type = 'metadata'").first()["block"].split("\r\n")
    assert [m for m in meta if m.startswith("outlink: ")] == ["outlink: /p?a=1&b=2", "outlink: /q?a=1&b=2"] and "lang: a&b" in meta
