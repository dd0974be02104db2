"""Operator 11: repair of conversation structure by least-cost edits and prefix-doubling path ranking.

A node is (how many rows are done, state); the states are the start, after a
system turn, after a user turn and after an assistant turn, and a repaired
conversation ends at the start or after an assistant turn.  Arcs are the edits:
D delete, I insert, K keep, R rerole.  A backward pass gives each node its cost
to the end.  The arcs on cheapest paths are optimal.  Nodes are then ranked by
the first 1, 2, 4, ... edits of their least audit, a rank of twice the length
being the rank of the pair (own rank, rank of the node the doubled pointer
leads to); a letter fixes its arc, so the first ranks already choose each
node's pointer.  The path of a conversation is read through the pointers, from
every node of the path so far to as many nodes more.

Rows are ordered by one range shuffle on (conversation, turn, role, start of the
text), so a long conversation lies in many partitions.  Rows repeated in full
travel once, with a count.  A partition solves the conversations that lie in it
whole; of those that may go on in the next partition, or have more than a block
of rows, it writes blocks of up to ``BLOCK`` rows.  For these, rows that an
earlier block has are found by a minimum over (role and text, block); costs go
through the blocks from the last to the first and states from the first to the
last, 4 numbers at a time; every block then ranks its own paths.  A repaired
text is hashed piece by piece, because SHA-256 is sequential.

Cases: nulls are one space in the damage key, role and text; rows of one turn
are taken by role, then text; rows with a null conv_id are a conversation whose
id is null; a conversation without rows after damage has zeros, an empty audit
and the digest of the empty string; an empty table gives an empty one; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import arrow_batches
from lodestone.session import materialise

BLOCK = 512
BLOCK_BYTES = 4 << 20
REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
FAR = 1 << 60  # cost of what can't be
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([USER, USER, ASSISTANT, USER])  # where an inserted or reroled turn leads
LETTERS = "DIKR"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()

ROWS = "conv_id long, turn long, role string, text string, n long"
# whole = true: the results of a conversation; false: a block of one, with its rows.
SOLVED = (
    "whole boolean, conv_id long, block long, rows long, turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, "
    "illegal long, first_initial string, last_initial string, cost long, audit string, sha string, roles array<string>, texts array<string>, counts array<long>, faults binary, keys array<binary>"
)


# ---- rows ----------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): n copies of a row; a dropped row stays as one of n = 0, so that no conversation is lost."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    gone = lambda value, kept: F.when(kind == 0, value).otherwise(kept)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        gone(F.lit(None).cast("long"), F.col("turn").cast("long")).alias("turn"),
        gone(F.lit(""), F.when(kind == 4, "user").otherwise(shown("role"))).alias("role"),
        gone(F.lit(""), text).alias("text"),
        gone(F.lit(0), F.when(kind == 3, 2).otherwise(1)).cast("long").alias("n"),
    )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows repeated in full within a batch become one with the sum of their counts, before they are shuffled."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        alive = rows.group_by(["conv_id", "turn", "role", "text"], use_threads=False).aggregate([("n", "sum")])
        yield from alive.rename_columns(["conv_id", "turn", "role", "text", "n"]).to_batches()


def row_faults(text: Column) -> Column:
    """0 fine, 1 blank, 3 truncated; duplicates are for who sees a conversation's rows."""
    last = F.substring(F.regexp_replace(text, r"[\x20\x09-\x0D]+\z", ""), -1, 1)
    return F.when(last == "", BLANK).when(last.isin(".", "!", "?"), NONE).otherwise(TRUNCATED).cast("int")


# ---- cost and paths ------------------------------------------------------------------------------------------------


def _inserted(base: np.ndarray) -> np.ndarray:
    """Costs with inserts before going on; base: (..., 4)."""
    out = base.copy()
    out[..., USER] = np.minimum(base[..., USER], INSERT + base[..., ASSISTANT])
    out[..., ASSISTANT] = np.minimum(base[..., ASSISTANT], INSERT + base[..., USER])
    for state in (START, SYSTEM):
        out[..., state] = np.minimum(base[..., state], INSERT + out[..., USER])
    return out


def keep_states(initials: np.ndarray) -> np.ndarray:
    """(rows, 4): the state that keeping a row leads to, -1 if it may not be kept there.  initials: 0 other, 1 s, 2 u, 3 a."""
    out = np.full((len(initials), 4), -1)
    for state, initial in ((START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)):
        out[initials == initial, state] = initial
    return out


def _steps(initials: np.ndarray, faults: np.ndarray, counts: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For D, K and R the cost (rows, 4) of an edit of a row and its copies, and the state it leads to."""
    n = len(initials)
    fit = ((faults == NONE) | (faults == TRUNCATED))[:, None]
    stay = (np.where(faults == TRUNCATED, CUT_SHORT, 0) + DELETE * (counts - 1))[:, None]  # copies after the first are duplicates
    kept = keep_states(initials)
    return {
        "D": (np.broadcast_to((DELETE * counts)[:, None], (n, 4)), np.broadcast_to(np.arange(4), (n, 4))),
        "K": (np.where(fit & (kept >= 0), stay, FAR), np.maximum(kept, 0)),
        "R": (np.where(fit, np.broadcast_to(stay + REROLE, (n, 4)), FAR), np.broadcast_to(NEXT, (n, 4))),
    }


def costs(starts: np.ndarray, ends: np.ndarray, steps: dict, final: np.ndarray) -> np.ndarray:
    """Cost to the end of every node of many runs of rows; final: (runs, 4, ...) costs behind their last rows.

    Run r has nodes starts[r] + r .. ends[r] + r, one more than rows.  Runs are worked on
    together, row by row from their ends.
    """
    runs = len(starts)
    extra = final.ndim - 2
    out = np.zeros((int(ends[-1] if runs else 0) + runs, *final.shape[1:]), np.int64)
    last = np.moveaxis(_inserted(np.moveaxis(final, 1, -1)), -1, 1)
    out[ends + np.arange(runs)] = last
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    alive = len(order)
    for back in range(1, int(lengths.max(initial=0)) + 1):
        while alive and lengths[order[alive - 1]] < back:
            alive -= 1
        run = order[:alive]
        row, node = ends[run] - back, ends[run] - back + run
        after, base = out[node + 1], None
        for cost, to in steps.values():
            way = cost[row].reshape(alive, 4, *[1] * extra) + after[np.arange(alive)[:, None], to[row]]
            base = way if base is None else np.minimum(base, way)
        out[node] = np.minimum(np.moveaxis(_inserted(np.moveaxis(base, 1, -1)), -1, 1), FAR)
    return out


def rank_paths(starts: np.ndarray, ends: np.ndarray, steps: dict, togo: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(rank of every node by its whole least audit, its first letter or -1 at an end, pointers doubled again and again).

    Behind the last row of a run that is not closed nothing is inserted; that is for the block that follows.
    """
    runs, nodes = len(starts), len(togo)
    row_of = np.full(nodes, -1)
    rows = np.arange(int(ends[-1]) if runs else 0)
    run_of = np.repeat(np.arange(runs), ends - starts)
    row_of[rows + run_of] = rows
    letter = np.full((nodes, 4), -1)
    pointer = np.broadcast_to(np.arange(nodes)[:, None] * 4 + np.arange(4), (nodes, 4)).copy()
    at = rows + run_of
    # the least letter among a node's optimal arcs; each letter has one arc
    for code in (3, 2, 1, 0):
        if LETTERS[code] == "I":
            good = (INSERT + togo[:, NEXT] == togo) & (togo < FAR)
            good[(ends + np.arange(runs))[~closed]] = False
            to = np.broadcast_to(np.arange(nodes)[:, None] * 4 + NEXT, (nodes, 4))
            letter[good], pointer[good] = code, to[good]
        else:
            cost, to = steps[LETTERS[code]]
            good = (cost + togo[at + 1][np.arange(len(rows))[:, None], to] == togo[at]) & (togo[at] < FAR)
            node, state = np.nonzero(good)
            letter[at[node], state] = code
            pointer[at[node], state] = (at[node] + 1) * 4 + to[node, state]
    letter, pointer = letter.reshape(-1), pointer.reshape(-1)
    rank, jumps = letter + 1, [pointer]
    longest = 3 * int((ends - starts).max(initial=0)) + 3  # two inserts at most between rows
    for _ in range(max(1, longest.bit_length())):
        _, rank = np.unique(rank.astype(np.int64) * (len(rank) + 5) + rank[jumps[-1]], return_inverse=True)
        jumps.append(jumps[-1][jumps[-1]])
    return rank, letter, jumps


def path_nodes(entry: np.ndarray, jumps: list[np.ndarray]) -> np.ndarray:
    """(entries, 2^k): the nodes of each entry's least path; ends repeat."""
    found = entry[:, None]
    for jump in jumps:
        if (jumps[0][found[:, -1]] == found[:, -1]).all():
            break
        found = np.concatenate([found, jump[found]], axis=1)
    return found


def audits(starts: np.ndarray, ends: np.ndarray, counts: np.ndarray, steps: dict, togo: np.ndarray, entry_states: np.ndarray, closed: np.ndarray) -> tuple[list[str], list[list[tuple]], np.ndarray]:
    """Per run the least audit from its entry state, its edits (letter, row, new state), and the state behind its last row."""
    _, letter, jumps = rank_paths(starts, ends, steps, togo, closed)
    runs = len(starts)
    row_of = np.full(len(togo), -1)
    rows = np.arange(len(counts))
    row_of[rows + np.repeat(np.arange(runs), ends - starts)] = rows
    texts, edits, leave = [""] * runs, [[] for _ in range(runs)], np.zeros(runs, np.int64)
    lengths, counts = ends - starts, np.append(counts, 1)  # the last for nodes behind a run's rows
    for lo, hi in _bands(lengths):  # runs of about one length together, as their paths are held in one array
        some = np.flatnonzero((lengths >= lo) & (lengths < hi))
        for part in np.array_split(some, max(1, len(some) * hi * 4 // (1 << 21))):
            nodes = path_nodes((starts[part] + part) * 4 + entry_states[part], jumps)
            last = jumps[0][nodes] == nodes
            for i, run in enumerate(part.tolist()):
                path = nodes[i][~last[i]]
                what, row, to = letter[path].tolist(), row_of[path // 4].tolist(), (jumps[0][path] % 4).tolist()
                copies = counts[row_of[path // 4]].tolist()
                texts[run] = "".join("I" if c == 1 else "D" * n if c == 0 else LETTERS[c] + "D" * (n - 1) for c, n in zip(what, copies))
                edits[run] = list(zip(what, row, to))
                leave[run] = to[-1] if to else entry_states[run]
    return texts, edits, leave


def _bands(lengths: np.ndarray) -> list[tuple[int, int]]:
    top = int(lengths.max(initial=0))
    return [(0, 4)] + [(1 << k, 1 << (k + 1)) for k in range(2, max(3, top.bit_length()) + 1)]


def repaired(edits: list[tuple], roles: list[str], texts: list[str]) -> list[str]:
    """The ``role:text`` lines that are left after the edits."""
    names = {USER: "user", ASSISTANT: "assistant"}
    out = []
    for code, row, to in edits:
        if code == 1:
            out.append(names[to] + ":")
        elif code == 2:
            out.append(f"{roles[row]}:{texts[row]}")
        elif code == 3:
            out.append(f"{names[to]}:{texts[row]}")
    return out


def initials_of(roles: list[str]) -> np.ndarray:
    return np.array([{"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(r[:1], 0) for r in roles], np.int64)


ENDS_HERE = np.array([0, FAR, FAR, 0], np.int64)


# ---- partitions ----------------------------------------------------------------------------------------------------


class _Run:
    """Ordered rows of one conversation, or of a block of it."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.roles, self.texts, self.counts, self.faults, self.size = conv_id, [], [], [], [], [], 0
        self.seen: dict[tuple[str, str], int] = {}

    def add(self, turn, role: str, text: str, n: int, fault: int) -> None:
        if not n:
            return
        if self.roles and (self.turns[-1], self.roles[-1], self.texts[-1]) == (turn, role, text):
            self.counts[-1] += n
            return
        if fault != BLANK and (role, text) in self.seen:
            fault = DUPLICATE
        self.seen.setdefault((role, text), len(self.roles))
        for values, value in ((self.turns, turn), (self.roles, role), (self.texts, text), (self.counts, n), (self.faults, fault)):
            values.append(value)
        self.size += len(text) + 32


def _counted(run: _Run) -> dict:
    """What a run adds to its conversation's counts, as far as it can tell alone."""
    faults, counts = np.array(run.faults, np.int64), np.array(run.counts, np.int64)
    turns = [t for t in run.turns if t is not None]
    first = [r[:1] for r in run.roles]
    legal = sum(a + b in ("su", "ua", "au") for a, b in zip(first, first[1:]))
    extra = int((counts - 1).sum())
    return {
        "conv_id": run.conv_id, "rows": int(counts.sum()), "turns": len(set(turns)), "first_turn": min(turns, default=None), "last_turn": max(turns, default=None),
        "blank": int(counts[faults == BLANK].sum()), "duplicate": int(counts[faults == DUPLICATE].sum() + (counts - 1)[(faults == NONE) | (faults == TRUNCATED)].sum()),
        "truncated": int((faults == TRUNCATED).sum()), "illegal": max(0, len(first) - 1) - legal + extra,
        "first_initial": first[0] if first else None, "last_initial": first[-1] if first else None,
    }


def _arrays(runs: list[_Run]):
    lengths = np.array([len(r.roles) for r in runs], np.int64)
    ends = np.cumsum(lengths)
    joined = lambda name: np.array([x for r in runs for x in getattr(r, name)], np.int64)
    counts = joined("counts")
    return ends - lengths, ends, counts, _steps(initials_of([x for r in runs for x in r.roles]), joined("faults"), counts)


def _solve(runs: list[_Run]) -> list[dict]:
    """The results of whole conversations."""
    if not runs:
        return []
    starts, ends, counts, steps = _arrays(runs)
    togo = costs(starts, ends, steps, np.broadcast_to(ENDS_HERE, (len(runs), 4)))
    texts, edits, _ = audits(starts, ends, counts, steps, togo, np.zeros(len(runs), np.int64), np.ones(len(runs), bool))
    out = []
    for i, run in enumerate(runs):
        mine = [(c, row - int(starts[i]), to) for c, row, to in edits[i]]
        sha = hashlib.sha256("\n".join(repaired(mine, run.roles, run.texts)).encode("utf-8", "surrogatepass")).hexdigest()
        out.append({"whole": True, **_counted(run), "cost": int(togo[starts[i] + i, START]), "audit": texts[i], "sha": sha})
    return out


def _key(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _as_block(run: _Run, number: int) -> dict:
    keys = [_key(r, t) if f in (NONE, TRUNCATED) else b"" for r, t, f in zip(run.roles, run.texts, run.faults)]
    kept = [t if f in (NONE, TRUNCATED) else "" for t, f in zip(run.texts, run.faults)]
    return {"whole": False, **_counted(run), "block": number, "roles": run.roles, "texts": kept, "counts": run.counts, "faults": bytes(run.faults), "keys": keys}


def _partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations solved, and blocks of the others; rows come in order."""
    schema = _arrow(SOLVED)
    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 32
    run, whole, out, held, conversations = None, [], [], 0, 0
    cut = False  # the conversation at hand has blocks already

    for batch in batches:
        for conv_id, turn, role, text, n, fault in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "fault"))):
            if run is None or run.conv_id != conv_id:
                if run is not None:
                    if conversations == 1 or cut:  # the first may have begun in the partition before
                        out.append(_as_block(run, number))
                        number += 1
                    else:
                        whole.append(run)
                run, cut, conversations = _Run(conv_id), False, conversations + 1
            elif len(run.roles) >= BLOCK or run.size >= BLOCK_BYTES:
                out.append(_as_block(run, number))
                number, cut, run = number + 1, True, _Run(conv_id)
            run.add(turn, role, text, n, fault)
            held += len(text) + 64
        if held > BLOCK_BYTES:
            out += _solve(whole)
            yield pa.RecordBatch.from_pylist(out, schema)
            whole, out, held = [], [], 0
    if run is not None:  # the last may go on in the next partition
        out.append(_as_block(run, number))
    out += _solve(whole)
    yield pa.RecordBatch.from_pylist(out, schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"boolean": pa.bool_(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split(" ") for part in ddl.split(", "))])


# ---- conversations of several blocks -------------------------------------------------------------------------------

MATRIX = "name string, block long, matrix array<long>"
FOLDED = "name string, block long, final array<long>, closed boolean"
EXITS = "name string, block long, leaves array<long>"
ENTRIES = "name string, block long, entry long"
PIECES = (
    "name string, conv_id long, block long, rows long, turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, "
    "first_initial string, last_initial string, cost long, audit string, lines array<string>"
)
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _runs_of(batch: pa.RecordBatch) -> list[_Run]:
    """The runs of block rows; what an earlier block has is a duplicate here."""
    runs = []
    for x in batch.to_pylist():
        run, late = _Run(x["conv_id"]), set(x["late"] or ())
        run.roles, run.texts, run.counts = x["roles"], x["texts"], x["counts"]
        run.faults = [DUPLICATE if k and k in late else f for f, k in zip(x["faults"], x["keys"])]
        runs.append(run)
    return runs


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block the cost from each state before it (4) to each state behind it (4)."""
    final = np.full((4, 4), FAR, np.int64)
    final[np.arange(4), np.arange(4)] = 0
    for batch in batches:
        runs = _runs_of(batch)
        starts, ends, _, steps = _arrays(runs)
        togo = costs(starts, ends, steps, np.broadcast_to(final, (len(runs), 4, 4)))
        found = togo[starts + np.arange(len(runs))].reshape(len(runs), 16)
        yield pa.RecordBatch.from_arrays([batch["name"], batch["block"], pa.array(found.tolist(), pa.list_(pa.int64()))], ["name", "block", "matrix"])


def _costs_behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come from the last to the first; each gets the cost to the end from every state behind it."""
    name, after = None, ENDS_HERE
    for batch in batches:
        out = []
        for x in batch.to_pylist():
            closed = x["name"] != name
            name, after = x["name"], ENDS_HERE if closed else after
            out.append({"name": name, "block": x["block"], "final": after.tolist(), "closed": closed})
            after = np.minimum((np.array(x["matrix"], np.int64).reshape(4, 4) + after).min(axis=1), FAR)
        yield pa.RecordBatch.from_pylist(out, _arrow(FOLDED))


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each state before a block the one behind it on the least path."""
    for batch in batches:
        runs = [r for r in _runs_of(batch) for _ in range(4)]
        starts, ends, counts, steps = _arrays(runs)
        closed = np.repeat(np.array(batch["closed"].to_pylist(), bool), 4)
        togo = costs(starts, ends, steps, np.repeat(np.array(batch["final"].to_pylist(), np.int64).reshape(-1, 4), 4, axis=0))
        _, _, leave = audits(starts, ends, counts, steps, togo, np.tile(np.arange(4), batch.num_rows), closed)
        yield pa.RecordBatch.from_arrays([batch["name"], batch["block"], pa.array(leave.reshape(-1, 4).tolist(), pa.list_(pa.int64()))], ["name", "block", "leaves"])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come from the first to the last; each gets the state before it."""
    name, state = None, START
    for batch in batches:
        out = []
        for x in batch.to_pylist():
            state = START if x["name"] != name else state
            name = x["name"]
            out.append({"name": name, "block": x["block"], "entry": state})
            state = x["leaves"][state]
        yield pa.RecordBatch.from_pylist(out, _arrow(ENTRIES))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every block's share of the audit, the repaired text and the counts."""
    for batch in batches:
        runs, entry = _runs_of(batch), batch["entry"].to_numpy()
        starts, ends, counts, steps = _arrays(runs)
        closed = np.array(batch["closed"].to_pylist(), bool)
        togo = costs(starts, ends, steps, np.array(batch["final"].to_pylist(), np.int64).reshape(-1, 4))
        texts, edits, _ = audits(starts, ends, counts, steps, togo, entry, closed)
        out = []
        for i, (run, x) in enumerate(zip(runs, batch.select(["name", "block", "rows", "turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial", "faults"]).to_pylist())):
            late = [old for old, new in zip(x.pop("faults"), run.faults) if old != new]
            mine = [(c, row - int(starts[i]), to) for c, row, to in edits[i]]
            x |= {"duplicate": x["duplicate"] + len(late), "truncated": x["truncated"] - late.count(TRUNCATED)}
            out.append({**x, "conv_id": run.conv_id, "cost": int(togo[starts[i] + i, entry[i]]), "audit": texts[i], "lines": repaired(mine, run.roles, run.texts)})
        yield pa.RecordBatch.from_pylist(out, _arrow(PIECES))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces come in order; a conversation's text is hashed as it goes by, and only its audit is held."""
    schema, now, sha, last = _arrow(RESULT), None, None, None

    def done() -> dict:
        gaps = now["last_turn"] - now["first_turn"] + 1 - now["turns"] if now["turns"] else 0
        return {**{c: now[c] for c in ("conv_id", "blank", "duplicate", "truncated", "illegal", "cost")}, "gaps": gaps, "audit": "".join(now["audit"]), "repaired_sha256": sha.hexdigest()}

    for batch in batches:
        out = []
        for x in batch.to_pylist():
            if now is None or now["name"] != x["name"]:
                if now is not None:
                    out.append(done())
                now, sha, last, first = {**x, "audit": [x["audit"]]}, hashlib.sha256(), x["last_initial"], True
            else:
                if x["rows"] and last is not None:
                    now["illegal"] += last + x["first_initial"] not in ("su", "ua", "au")
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    now[c] += x[c]
                now["turns"] += x["turns"] - (x["turns"] > 0 and x["first_turn"] == now["last_turn"])
                now["first_turn"] = x["first_turn"] if now["first_turn"] is None else now["first_turn"]
                now["last_turn"] = now["last_turn"] if x["last_turn"] is None else x["last_turn"]
                now["audit"].append(x["audit"])
                last = x["last_initial"] if x["rows"] else last
            for line in x["lines"]:
                sha.update((line if first else "\n" + line).encode("utf-8", "surrogatepass"))
                first = False
        yield pa.RecordBatch.from_pylist(out, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([done()], schema)


def _in_order(rows: DataFrame, backward: bool = False) -> DataFrame:
    return rows.repartition("name").sortWithinPartitions("name", F.desc("block") if backward else "block")


def _long_conversations(blocks: DataFrame) -> DataFrame:
    """The results of conversations that were written in blocks; only their order is a matter of one task each."""
    blocks = blocks.withColumn("name", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    keys = blocks.select("name", "block", F.explode("keys").alias("key")).filter(F.length("key") > 0)
    first = keys.groupBy("name", "key").agg(F.min("block").alias("first"), F.max("block").alias("latest")).filter("first <> latest").drop("latest")
    late = keys.join(first, ["name", "key"]).filter("block > first").groupBy("name", "block").agg(F.collect_set("key").alias("late"))
    blocks = materialise(blocks.join(late, ["name", "block"], "left"), "conversation-blocks")
    matrices = materialise(blocks.mapInArrow(_matrices, MATRIX), "conversation-matrices")
    folded = materialise(_in_order(matrices, backward=True).mapInArrow(_costs_behind, FOLDED), "conversation-costs")
    blocks = blocks.join(folded, ["name", "block"])
    exits = materialise(blocks.mapInArrow(_leaves, EXITS), "conversation-exits")
    entries = materialise(_in_order(exits).mapInArrow(_entries, ENTRIES), "conversation-entries")
    pieces = materialise(blocks.join(entries, ["name", "block"]).mapInArrow(_pieces, PIECES), "conversation-pieces")
    return _in_order(pieces).mapInArrow(_joined, RESULT)


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of (conv_id, turn, role, text, n) rows. Runs jobs."""
    spark = rows.sparkSession
    with arrow_batches(spark, 2_000, 4 << 20):
        merged = rows.mapInArrow(_merged, ROWS).withColumn("start", F.substring("text", 1, 64))
        ordered = merged.repartitionByRange("conv_id", "turn", "role", "start").sortWithinPartitions("conv_id", "turn", "role", "text")
        solved = materialise(ordered.select("conv_id", "turn", "role", "text", "n", row_faults(F.col("text")).alias("fault")).mapInArrow(_partition, SOLVED), "conversations")
        long = materialise(_long_conversations(solved.filter("NOT whole")), "conversations-long")
    gaps = F.when(F.col("turns") > 0, F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")).otherwise(0)
    short = solved.filter("whole").select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha").alias("repaired_sha256"))
    return short.unionByName(long)
