"""The pipeline beside a plain version of each of its stages, over whole tables."""

import hashlib
import re

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import tiktoken

import corpus_pipeline
from lodestone.llm import lsa_votes
from lodestone.llm.duck_bpe import read_ranks

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"


def lower(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


def good_ones(docs, model):
    """Votes of the nearest labelled vectors, a document at a time; the fitted vectors are given."""
    kept = {}
    for i, text in docs.items():
        x = lsa_votes.features(pa.array([text]))[0]
        z = (x * model.weight) @ model.axes
        cosines = np.array([float(z @ m) for m in model.known]) / max(float(np.linalg.norm(z)), 1e-12)
        near = np.argsort(-cosines, kind="stable")[: lsa_votes.NEIGHBOURS]
        votes = np.maximum(cosines[near], 0) ** 8
        score = float(votes @ model.labels[near] / votes.sum()) if np.abs(x).sum() and votes.sum() else model.share
        if score >= lsa_votes.CUT:
            kept[i] = text
    return kept


def one_of_each_group(docs):
    sets = {}
    for i, text in docs.items():
        w = WORDS.findall(lower(text))
        sets[i] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    return {i: t for i, t in docs.items() if label[i] == i}


def without_passages(docs):
    seen, out = {}, {}
    for i, text in sorted(docs.items()):
        words, gone = WORDS.findall(text), set()
        for p in range(len(words) - 49):
            if seen.setdefault(tuple(words[p : p + 50]), i) < i:
                gone.update(range(p, p + 50))
        out[i] = " ".join(w for k, w in enumerate(words) if k not in gone) if gone else text
    return out


def clean_ones(docs, items):
    kept = {}
    windows = set()
    for text in items:
        line = ALNUM.findall(lower(text or ""))
        width = min(13, len(line))
        windows |= {tuple(line[p : p + width]) for p in range(len(line) - width + 1)} if width else set()
    widths = {len(w) for w in windows}
    for i, text in docs.items():
        words, hit = ALNUM.findall(lower(text)), set()
        for width in widths:
            for p in range(len(words) - width + 1):
                if tuple(words[p : p + width]) in windows:
                    hit.update(range(p, p + width))
        if not hit or 20 * len(hit) < len(words):
            kept[i] = text
    return kept


def test_pipeline_against_plain_stages(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r["doc_id"]: r["text"] or "" for r in table.select("doc_id", "text").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    model = lsa_votes.fit(table, spark.read.parquet(f"{SF}/labels.parquet"))
    good = good_ones(docs, model)
    single = one_of_each_group(good)
    cut = without_passages(single)
    clean = clean_ones(cut, items)
    assert len(docs) > len(clean) > 0
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = {}
    for i, text in clean.items():
        ids = np.array(plain.encode_ordinary(text), "<u4").tobytes()
        want[i] = (i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert {r["doc_id"]: tuple(r)[:4] for r in corpus_pipeline.run(spark, SF).collect()} == want
