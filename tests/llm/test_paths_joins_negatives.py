"""Conversation repair, the n-gram join and hard negatives against plain versions, on rows with all the odd cases."""

import hashlib
import heapq
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import conversation_paths, link_groups, prefix_join, triangle_windows
from lodestone.llm.conversation_paths import damaged, repair
from lodestone.llm.prefix_join import choose_matches, jaccard_components, least_overlap
from lodestone.llm.triangle_windows import angles, hard_negatives, mining_rows, norms, products, score_bounds

# ---- conversations

TALK = "conv_id long, turn long, role string, text string, n long, name string, block int, start string"


def plain_rows(rows):
    """Rows after damage by conversation, by turn, role and text."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        shown = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {c: sorted(v, key=key) for c, v in out.items()}


def plain_repair(rows):
    """Cheapest first, then by audit: the first end that a search reaches."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    follow = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, lines = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        new = follow[state]
        heapq.heappush(queue, (cost + 3, audit + "I", i, new[0], (*lines, f"{new}:")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(queue, (cost + 4, audit + "D", i + 1, state, lines))
            if faults[i] in ("", "truncated"):
                extra = 3 * (faults[i] == "truncated")
                if role[:1] and (state + role[:1]) in ("s", "u", "su", "ua", "au"):
                    heapq.heappush(queue, (cost + extra, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))
                heapq.heappush(queue, (cost + extra + 3, audit + "R", i + 1, new[0], (*lines, f"{new}:{text}")))
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def talk(seed, conversations, turns):
    rng = np.random.default_rng(seed)
    pick = lambda values: values[rng.integers(len(values))]
    rows = []
    for conv in range(conversations):
        for turn in range(int(rng.integers(1, turns))):
            role = pick(["user", "assistant"] * 4 + ["system", None, "", "uncle", "tool", "User"]) if turn else pick(["system", "user", "user"])
            text = pick(["Fine.", "Yes!", "no", "", None, " \t\n", "¿Qué?", "Ends. \x0b", f"Turn {turn}.", f"Said {turn}", "a.b\n"])
            rows.append((conv, pick([turn] * 9 + [None, turn + 2]), role, text))
    return rows + [(None, 0, "user", "Who?"), (None, 1, "assistant", "None."), (7777, None, None, None)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 9, "x", 1, "y") for r in rows], TALK).repartition(parts)


def got_repairs(spark, rows, parts=3):
    out = repair(damaged(frame(spark, rows, parts)))
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len({r[0] for r in got})
    return {r[0]: r[1:] for r in got}


def test_repairs(spark):
    rows = talk(1, 120, 9)
    assert got_repairs(spark, rows) == {c: plain_repair(v) for c, v in plain_rows(rows).items()}


def test_repairs_of_long_conversations_go_through_blocks(spark, monkeypatch):
    monkeypatch.setattr(conversation_paths, "BLOCK", 3)
    rows = talk(2, 12, 40) + [(500, 1, "user", "Same.")] * 30 + [(501, t, "user", "Again") for t in range(25)]
    assert got_repairs(spark, rows, 7) == {c: plain_repair(v) for c, v in plain_rows(rows).items()}


def test_repair_of_no_rows(spark):
    assert got_repairs(spark, []) == {}
    dropped = next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert got_repairs(spark, [(dropped, 0, "user", "Hi.")]) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_ranks_follow_whole_audits():
    runs = [conversation_paths._Run(i) for i in range(40)]
    for i, run in enumerate(runs):
        for turn, role, text in plain_rows(talk(i, 1, 12))[0]:
            fault = 1 if not text.strip() else 0 if text.strip()[-1] in ".!?" else 3
            run.add(turn, role, text, 1, fault)
    starts, ends, counts, steps = conversation_paths._arrays(runs)
    closed = np.ones(len(runs), bool)
    togo = conversation_paths.costs(starts, ends, steps, np.broadcast_to(conversation_paths.ENDS_HERE, (len(runs), 4)))
    rank, _, _ = conversation_paths.rank_paths(starts, ends, steps, togo, closed)
    texts, _, _ = conversation_paths.audits(starts, ends, np.ones_like(counts), steps, togo, np.zeros(len(runs), np.int64), closed)
    own = rank[(starts + np.arange(len(runs))) * 4]
    assert [texts[i] for i in np.argsort(own, kind="stable")] == sorted(texts)
    assert len(set(own.tolist())) == len(set(texts))


# ---- joins


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORDS.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def plain_components(rows, width):
    sets = [shingles(t, width) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] is not None and rows[j][0] is not None and both and 100 * both >= 80 * len(sets[i] | sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    out = []
    for i, (doc, _) in enumerate(rows):
        mine = [rows[j][0] for j in range(len(rows)) if label[j] == label[i]]
        out.append((doc, len(sets[i]), None if doc is None else min(mine)))
    return sorted(out, key=repr)


def near_texts(seed, many):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(3000)}"
    base = [word() for _ in range(150)]
    out = [" ".join(base)]
    for i in range(many):
        words = list(base)
        for _ in range(int(rng.integers(0, 9))):
            at = int(rng.integers(len(words)))
            words[at : at + 1] = [word()] if rng.integers(2) else [word(), word()]
        out.append(" ".join(words if i % 3 else words[: int(rng.integers(100, 150))]))
    return out


TEXTS = [None, "", " \n", "one", "ONE", "one two", "a  b   c ", "a b c", "dup " * 200, "dup " * 300, "q" * 5000, "the same five words here " * 700]


def joined(spark, rows, width):
    docs = spark.createDataFrame([(i, t, 1, 2, "k") for i, t in rows], "doc_id long, text string, set_id int, n int, key string").repartition(3)
    out = jaccard_components(docs, width)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()), key=repr)


@pytest.mark.parametrize("width", [2, 5])
def test_join_components(spark, width):
    texts = TEXTS + near_texts(1, 60) + near_texts(2, 25) + near_texts(1, 3)
    rows = [(1000 - 7 * i, t) for i, t in enumerate(texts)] + [(1000, "other text of a repeated id"), (None, texts[20]), (None, None)]
    assert joined(spark, rows, width) == plain_components(rows, width)


def test_join_by_groups_alone(spark, monkeypatch):
    """Without leader rounds every link has to come from the tiles."""
    monkeypatch.setattr(prefix_join, "ROUNDS", 0)
    monkeypatch.setattr(link_groups, "TILE_SETS", 7)
    rows = list(enumerate(near_texts(3, 50) + near_texts(4, 20) + TEXTS))
    assert joined(spark, rows, 2) == plain_components(rows, 2)


def test_join_of_no_rows(spark):
    assert joined(spark, [], 5) == []
    assert joined(spark, [(1, None), (2, "")], 5) == [(1, 0, 1), (2, 0, 2)]


def test_longer_prefixes_where_lists_are_long():
    assert choose_matches(100, np.concatenate([np.full(11, 2), np.full(79, 5000)])) == 1  # the next are in long lists
    assert choose_matches(100, np.concatenate([np.full(12, 500), np.full(80, 501)])) > 1
    assert [least_overlap(n) for n in (1, 4, 5, 6, 10)] == [1, 4, 4, 5, 8]


# ---- hard negatives


def plain_negatives(rows, positives=5, negatives=10):
    fine = {}
    for i, label, vector in rows:
        if None not in (i, label, vector) and all(x is not None and np.isfinite(x) for x in vector):
            q = [int(np.floor(256 * np.float64(np.float32(x)))) for x in vector]
            fine[(i, label, tuple(q + [0] * (4 - len(q))))] = 1
    out = []
    for i, label, q in fine:
        if i % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, v)), j, other) for j, other, v in fine if j != i), key=lambda t: t[:2])
        for minus, p, _ in [t for t in scored if t[2] == label][:positives]:
            some = [t for t in scored if t[2] != label and 30 * -minus <= 100 * -t[0] <= 90 * -minus][:negatives]
            out += [(i, p, rank, j, -minus, -score) for rank, (score, j, _) in enumerate(some, 1)]
    return sorted(out)


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(triangle_windows, "WINDOW", 16)
    monkeypatch.setattr(triangle_windows, "ANCHORS", 3)
    rng = np.random.default_rng(5)
    rows = [(int(i), int(rng.integers(4)), [float(np.float32(x)) for x in rng.normal(size=4) + 0.5]) for i in range(0, 4000, 4)]
    rows += [(100, 1, [0.5, 0.5, 0.5, 0.5]), (100, 2, [0.5, -0.5, 0.25, 0.5]), rows[3], rows[3]]  # ids and rows that repeat
    rows += [(5001 + i, 3, [1.0, 1.0, 0.0, 0.0]) for i in range(40)]  # ties
    rows += [(None, 1, [1.0] * 4), (6001, None, [1.0] * 4), (6002, 1, None), (6100, 1, [1.0, None, 1.0, 1.0]), (6200, 1, [float("nan")] * 4), (6300, 1, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(6400, 0, [0.0] * 4), (6500, 0, [1.0]), (6600, 2, []), (6700, 77, [1.0, 1.0, 1.0, 1.0])]
    vectors = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, label int, embedding array<float>, id int, q int, slot string").repartition(4)
    mined = hard_negatives(mining_rows(vectors, F.col("label")), F.col("id") % 100 == 0)
    assert mined.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in mined.collect()) == plain_negatives(rows)
    none = vectors.filter("false")
    assert hard_negatives(mining_rows(none, F.col("label")), F.col("id") % 100 == 0).count() == 0


def test_bounds_hold_every_score():
    rng = np.random.default_rng(6)
    anchors, rows = rng.integers(-400, 400, (30, 16)), rng.integers(-400, 400, (500, 16))
    rows[:100] = anchors[0] * np.arange(100)[:, None] // 50  # near an anchor's own direction, and zero
    directions = rng.integers(-9, 9, (6, 16))
    score, at, norm = products(anchors, rows), angles(rows, directions), norms(rows)
    for lo in range(0, 500, 20):
        some = slice(lo, lo + 20)
        low, high = score_bounds(angles(anchors, directions), norms(anchors), at[some].min(axis=0)[None], at[some].max(axis=0)[None], norm[some].min()[None], norm[some].max()[None])
        assert (low[:, 0] <= score[:, some].min(axis=1)).all() and (score[:, some].max(axis=1) <= high[:, 0]).all()
    assert products(np.array([[1 << 30, 1]]), np.array([[1 << 30, 1]]))[0, 0] == (1 << 60) + 1


def test_negatives_skip_windows():
    """Windows of one direction are closed for an anchor of another."""
    rows = np.array([[1000, 5], [1000, -5]])
    directions = np.eye(2, dtype=np.int64)
    at, norm = angles(rows, directions), norms(rows)
    anchor = np.array([[3, 1000]])
    low, high = score_bounds(angles(anchor, directions), norms(anchor), at.min(axis=0)[None], at.max(axis=0)[None], norm.min()[None], norm.max()[None])
    assert high[0, 0] < 1e5 and low[0, 0] > -1e5  # of 1e6 that parallel rows would have
