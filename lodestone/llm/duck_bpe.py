"""Byte-pair merging as a recursive query of an in-process DuckDB.

A row is a token at a position of a piece.  Every round joins the rows, with
their right neighbours, to the merge table, finds each piece's leftmost pair of
the smallest rank, contracts it, and goes on with the pieces that had one.
A piece of more than LONG bytes is first cut where no token of the vocabulary
lies across, which no contraction can cross.  What stays longer would need a
round per token; there a round takes all contractions that follow one another at
the same rank, and a query runs a bounded number of rounds, as it keeps their rows.
"""

from __future__ import annotations

import base64
import gc

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from lodestone.llm.common import ranges, worker_memory
from lodestone.llm.units import UnitEncoder

PIECES_AT_ONCE = 20_000
LONG = 64
ROWS_KEPT = 2_000_000  # over the rounds of a query on long pieces
BASE = np.uint64(0x9E3779B97F4A7C15)  # of the hashes of byte runs

# key: piece * 4096 + pos.  best: rank * 4096 + pos of the pair to contract.  A merged token's id is its rank.
CONTRACT = """
WITH RECURSIVE rounds(key, id, again) AS (
    SELECT piece::BIGINT * 4096 + pos, id, true FROM tokens
  UNION ALL
    SELECT * FROM (
        WITH paired AS MATERIALIZED (
            SELECT r.key, r.id, m.rank
            FROM rounds r
            LEFT JOIN rounds n ON n.key = r.key + 1
            LEFT JOIN merges m ON m.pair = r.id::BIGINT * 4294967296 + n.id
            WHERE r.again
        ), leftmost AS MATERIALIZED (
            SELECT key >> 12 AS piece, min(rank::BIGINT * 4096 + (key & 4095)) AS best
            FROM paired WHERE rank IS NOT NULL GROUP BY 1
        )
        SELECT key - coalesce((key & 4095) > (best & 4095), false)::INT,
               CASE WHEN (key & 4095) = (best & 4095) THEN (best >> 12)::INT ELSE id END,
               best IS NOT NULL
        FROM paired LEFT JOIN leftmost ON piece = key >> 12
        WHERE best IS NULL OR (key & 4095) <> (best & 4095) + 1
    )
)
SELECT (key >> 12)::INT AS piece, id FROM rounds WHERE NOT again ORDER BY key
"""

# A round contracts the piece's pairs of the smallest rank from the left, in a run of equal tokens every other one, and
# stops behind the first contraction that makes a pair of a smaller rank still: that pair is next, as it is one by one.
CONTRACT_RUNS = """
WITH RECURSIVE rounds(round, piece, pos, id, again) AS (
    SELECT 0, piece, pos, id, true FROM tokens
  UNION ALL
    SELECT round + 1, piece, pos, CASE WHEN done THEN best ELSE id END, best IS NOT NULL
    FROM (
        SELECT *, coalesce(lag(done) OVER line, false) AS swallowed
        FROM (
            SELECT *, hit AND nr <= coalesce(min(CASE WHEN lower THEN nr END) OVER (PARTITION BY piece), nr) AS done
            FROM (
                SELECT h.round, h.piece, h.pos, h.id, h.nr, h.best, h.hit, coalesce(x.rank < best, false) OR coalesce(y.rank < best, false) AS lower
                FROM (
                    SELECT *, CASE WHEN hit THEN CASE WHEN lag(hit, 2) OVER line THEN best ELSE lag(id) OVER line END END AS left_id,
                           CASE WHEN hit THEN lead(id, 2) OVER line END AS right_id
                    FROM (
                        SELECT *, rank IS NOT NULL AND rank = best AND (nr - max(CASE WHEN run_starts THEN nr END) OVER line) % 2 = 0 AS hit
                        FROM (
                            SELECT *, rank = best AND NOT coalesce(lag(rank) OVER line = best, false) AS run_starts
                            FROM (
                                SELECT r.round, r.piece, r.pos, r.id, m.rank, r.nr, min(m.rank) OVER (PARTITION BY r.piece) AS best
                                FROM (
                                    SELECT *, lead(id) OVER line AS right_id, row_number() OVER line AS nr
                                    FROM rounds WHERE again AND round < $rounds WINDOW line AS (PARTITION BY piece ORDER BY pos)
                                ) r LEFT JOIN merges m ON m.pair = r.id::BIGINT * 4294967296 + r.right_id
                            ) WINDOW line AS (PARTITION BY piece ORDER BY pos)
                        ) WINDOW line AS (PARTITION BY piece ORDER BY pos)
                    ) WINDOW line AS (PARTITION BY piece ORDER BY pos)
                ) h LEFT JOIN merges x ON x.pair = h.left_id::BIGINT * 4294967296 + h.best
                    LEFT JOIN merges y ON y.pair = h.best::BIGINT * 4294967296 + h.right_id
            )
        ) WINDOW line AS (PARTITION BY piece ORDER BY pos)
    ) WHERE NOT swallowed
)
SELECT piece, pos, id, again FROM rounds WHERE NOT again OR round = $rounds
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """Every pair of tokens whose bytes together are a token; its rank is that token's."""
    rows = []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                rows.append(((left << 32) + right, rank))
    pair, rank = zip(*rows) if rows else ((), ())
    return pa.table({"pair": pa.array(pair, pa.int64()), "rank": pa.array(rank, pa.int32())})


def _run_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` bytes, by doubling the runs hashed so far."""
    with np.errstate(over="ignore"):
        out, power = np.zeros(len(data) - length + 1, np.uint64), np.uint64(1)
        doubled, size, done, step = data.astype(np.uint64) + np.uint64(1), 1, 0, BASE
        while size <= length:
            if length & size:  # this part of the run starts ``done`` bytes on
                out += doubled[done : done + len(out)] * power
                power, done = power * step, done + size
            if 2 * size <= length:
                doubled = doubled[:-size] + doubled[size:] * step
                step = step * step
            size *= 2
    return out


class Merger:
    """A database of this process only: the merge table and the vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": "", "preserve_insertion_order": False})
        self._table("merges", merge_table(ranks))
        by_id = sorted((rank, token) for token, rank in ranks.items())
        # A byte is written as the letter of its number, so that bytes can be joined as text.
        letters = [t.decode("latin-1") for _, t in by_id]
        self._table("vocabulary", pa.table({"id": pa.array([r for r, _ in by_id], pa.int32()), "letters": letters}))
        self.byte_id = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        by_length: dict[int, list[bytes]] = {}
        for token in ranks:
            by_length.setdefault(len(token), []).append(token)
        self.runs = {  # length -> sorted hashes of the tokens of that length
            n: np.unique(_run_hashes(np.frombuffer(b"".join(tokens), np.uint8), n)[::n]) for n, tokens in sorted(by_length.items()) if n > 1
        }

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("given", rows)
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per piece)."""
        size = np.array([len(p) for p in pieces], np.int64)
        order = np.argsort(size, kind="stable")  # pieces of like length end in like rounds
        ids, many = [np.zeros(0, np.uint32)], np.zeros(len(pieces), np.int64)
        short = int(np.searchsorted(size[order], LONG, side="right"))
        for lo in range(0, short, PIECES_AT_ONCE):
            some = order[lo : min(lo + PIECES_AT_ONCE, short)]
            got = self._contract([pieces[i] for i in some])
            ids.append(got["id"].astype(np.uint32))
            many[some] = np.bincount(got["piece"], minlength=len(some))
        for i in order[short:]:
            parts = self._cut(pieces[i])
            got = self._contract_long(parts[0]) if len(parts) == 1 else self.encode(parts)[0]
            ids.append(got)
            many[i] = len(got)
        at = np.empty(len(pieces), np.int64)
        at[order] = np.cumsum(many[order]) - many[order]
        return np.concatenate(ids)[ranges(at, many)], many

    def _cut(self, piece: bytes) -> list[bytes]:
        """The piece in parts that no token of the vocabulary crosses; equal hashes of other bytes only leave parts longer."""
        data, n = np.frombuffer(piece, np.uint8), len(piece)
        across = np.zeros(n + 1, np.int64)  # steps of the number of tokens over the border before each byte
        for length, known in self.runs.items():
            if length > n:
                break
            found = np.flatnonzero(np.isin(_run_hashes(data, length), known))
            across[found + 1] += 1
            across[found + length] -= 1
        cuts = np.flatnonzero(np.cumsum(across)[1:n] == 0) + 1
        return [piece[lo:hi] for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), n])]

    def _tokens(self, pieces: list[bytes]) -> pa.Table:
        sizes = np.array([len(p) for p in pieces], np.int64)
        ids = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        if (ids < 0).any():
            raise ValueError("the vocabulary lacks a byte of the text")
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        pos = (np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        return pa.table({"piece": piece, "pos": pos, "id": ids})

    def _contract(self, pieces: list[bytes]) -> dict[str, np.ndarray]:
        self._table("tokens", self._tokens(pieces))
        return self.db.execute(CONTRACT).fetchnumpy()

    def _contract_long(self, piece: bytes) -> np.ndarray:
        rows = self._tokens([piece])
        while True:
            self._table("tokens", rows)
            rounds = min(max(ROWS_KEPT // len(rows), 1), LONG)
            rows = pa.table(self.db.execute(CONTRACT_RUNS, {"rounds": rounds}).fetchnumpy())
            if not pc.any(rows["again"]).as_py():
                return rows.sort_by("pos")["id"].to_numpy().astype(np.uint32)
            rows = rows.drop_columns("again")

    def decode(self, ids: np.ndarray, row: np.ndarray, rows: int) -> list[bytes]:
        """The bytes of each row's ids, joined in their order."""
        self._table("tokens", pa.table({"row": row.astype(np.int32), "pos": np.arange(len(ids), dtype=np.int32), "id": ids.astype(np.int32)}))
        got = self.db.execute(
            "SELECT t.row, string_agg(v.letters, '' ORDER BY t.pos) AS letters FROM tokens t JOIN vocabulary v USING (id) GROUP BY t.row"
        ).fetchall()
        out = [b""] * rows
        for row_number, letters in got:
            out[row_number] = letters.encode("latin-1")
        return out


def merger(path: str) -> Merger:
    return worker_memory(f"merger:{path}", lambda: Merger(read_ranks(path)))


def encoder(path: str, pattern: str) -> UnitEncoder:
    """The worker's encoder for a rank file."""

    def make() -> UnitEncoder:
        split, merge = regex.compile(pattern).findall, merger(path)

        def encode(units: list[str]):
            gc.disable()
            number: dict[str, int] = {}
            flat, per_unit = [], []
            for unit in units:
                pieces = [unit] if (unit[1:] if unit[:1] == " " else unit).isalpha() else split(unit)
                per_unit.append(len(pieces))
                flat += [number.setdefault(p, len(number)) for p in pieces]
            gc.enable()
            ids, many = merge.encode([p.encode() for p in number])
            at = np.cumsum(many) - many
            order = np.array(flat, np.int64)
            sizes = many[order] if len(order) else np.zeros(0, np.int64)
            unit_of = np.repeat(np.arange(len(units)), per_unit)
            none = np.zeros(0, np.uint32)
            return ids[ranges(at[order], sizes)] if len(order) else none, np.bincount(unit_of, weights=sizes, minlength=len(units)).astype(np.int64), none, none

        return UnitEncoder(encode, split)

    return worker_memory(f"duck:{path}", make)
