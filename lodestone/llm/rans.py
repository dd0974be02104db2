"""Static range asymmetric numeral system over arrays of ids.

A table of frequencies (they sum to 2**bits) is shared by many blocks.  A block
is coded by interleaved lanes: symbol j belongs to lane j % lanes, and one array
operation advances all lanes by a symbol.  States are 63-bit and give off 32-bit
words.  A block keeps the lanes' states every few steps, with the place in the
words, so that decoding can begin at any such checkpoint.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

from lodestone.llm.common import ranges

LOW = 31  # a state is at least 2**LOW between symbols
MOST_LANES = 512
CHECK_STEPS = 256
MOST_LOOKED_UP = 1 << 20  # ids below it have their ranks in an array
AT_ONCE = 16  # spans decoded side by side


@dataclass
class Table:
    symbols: np.ndarray  # ascending ids
    freq: np.ndarray  # of each symbol, at least 1
    bits: int

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        symbols, counts = np.unique(ids, return_counts=True)
        bits = max(18, int(len(symbols)).bit_length() + 2)
        free = (1 << bits) - len(symbols)
        freq = counts * free // max(1, int(counts.sum())) + 1
        if len(freq):
            freq[int(np.argmax(counts))] += (1 << bits) - int(freq.sum())
        return cls(symbols.astype(np.uint32), freq.astype(np.uint32), bits)

    def to_bytes(self) -> bytes:
        gaps = np.diff(self.symbols, prepend=np.uint32(0)).astype("<u4")
        return bytes([self.bits]) + zlib.compress(gaps.tobytes() + self.freq.astype("<u4").tobytes(), 6)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Table:
        both = np.frombuffer(zlib.decompress(raw[1:]), "<u4")
        half = len(both) // 2
        return cls(np.cumsum(both[:half], dtype=np.uint32), both[half:], raw[0])

    def starts(self) -> np.ndarray:
        return (np.cumsum(self.freq, dtype=np.uint64) - self.freq).astype(np.uint64)

    def ranks(self, ids: np.ndarray) -> np.ndarray:
        most = int(self.symbols[-1]) if len(self.symbols) else 0
        if most >= MOST_LOOKED_UP:
            return np.searchsorted(self.symbols, ids)
        rank = np.zeros(most + 1, np.int64)
        rank[self.symbols] = np.arange(len(self.symbols))
        return rank[ids]


def _lanes(n: int) -> int:
    """Of a block of n ids."""
    lanes = 1
    while lanes < MOST_LANES and lanes * 64 < n:
        lanes *= 2
    return lanes


class Encoder:
    def __init__(self, table: Table):
        self.table, self.freq, self.start = table, table.freq.astype(np.uint64), table.starts()

    def block(self, ids: np.ndarray) -> dict:
        """A block of ids; the lanes' number follows from its size."""
        return self._side_by_side(ids[None])[0]

    def blocks(self, ids: np.ndarray, size: int) -> list[dict]:
        """Blocks of ``size`` ids, and a last one of the rest; blocks of equal size are coded side by side."""
        whole = len(ids) // size * size
        out = self._side_by_side(ids[:whole].reshape(-1, size)) if whole else []
        return out + ([self.block(ids[whole:])] if whole < len(ids) else [])

    def _side_by_side(self, ids: np.ndarray) -> list[dict]:
        """A block of each row.  An array operation advances all lanes of all rows by a symbol."""
        rows, n = ids.shape
        lanes = _lanes(n)
        steps, bits = -(-n // lanes), np.uint64(self.table.bits)
        room = np.uint64(LOW + 32 - self.table.bits)
        rank = self.table.ranks(ids)
        x = np.full((rows, lanes), 1 << LOW, np.uint64)
        words: list[np.ndarray] = []
        many = np.zeros((steps, rows), np.int64)  # words of each step and row
        marks: list[np.ndarray] = []
        for t in range(steps - 1, -1, -1):
            some = rank[:, t * lanes : (t + 1) * lanes]
            f, s = self.freq[some], self.start[some]
            y = x[:, : f.shape[1]]
            full = y >= (f << room)
            words.append(y[full].astype(np.uint32))
            many[t] = np.count_nonzero(full, axis=1)
            y = np.where(full, y >> np.uint64(32), y)
            q = y // f
            x[:, : f.shape[1]] = (q << bits) + (y - q * f) + s
            if t % CHECK_STEPS == 0:
                marks.append(x.copy())
        marks.reverse()
        given = np.concatenate(words[::-1]).astype("<u4") if words else np.zeros(0, "<u4")
        at = (np.cumsum(many) - many.ravel()).reshape(many.shape)
        before = np.cumsum(many, axis=0) - many  # words of a row before a step, as they are read
        return [
            {
                "n_ids": n,
                "lanes": lanes,
                "words": given[ranges(at[:, r], many[:, r])].tobytes(),
                "check_at": before[::CHECK_STEPS, r].tolist(),
                "check_states": b"".join(m[r].astype("<u8").tobytes() for m in marks),
                "crc32": zlib.crc32(np.ascontiguousarray(ids[r], "<u4").tobytes()),
            }
            for r in range(rows)
        ]


class Decoder:
    def __init__(self, table: Table):
        self.table, self.freq, self.start = table, table.freq.astype(np.uint64), table.starts()
        self.rank_of_slot = np.repeat(np.arange(len(table.freq)), table.freq)

    def span(self, block: dict, k: int) -> np.ndarray:
        """The ids from checkpoint k up to the next one; needs no other span."""
        return self._side_by_side([(block, k)])[0]

    def _side_by_side(self, spans: list[tuple[dict, int]]) -> np.ndarray:
        """The ids of each span, a row each; they must have as many ids and lanes."""
        first, last, lanes, size = _extent(*spans[0])
        n, bits = size + first * lanes, np.uint64(self.table.bits)
        mask = np.uint64((1 << self.table.bits) - 1)
        parts = [np.frombuffer(b["words"], "<u4")[b["check_at"][k] :][:size] for b, k in spans]  # an id takes a word at most
        at = np.cumsum([0, *map(len, parts)])[:-1]
        words = np.concatenate(parts)
        x = np.stack([np.frombuffer(b["check_states"], "<u8")[k * lanes : (k + 1) * lanes] for b, k in spans])
        out = np.empty((len(spans), size), np.uint32)
        for t in range(first, last):
            width = min(lanes, n - t * lanes)
            y = x[:, :width]
            slot = y & mask
            rank = self.rank_of_slot[slot]
            out[:, (t - first) * lanes : (t - first) * lanes + width] = self.table.symbols[rank]
            y = self.freq[rank] * (y >> bits) + slot - self.start[rank]
            low = y < np.uint64(1 << LOW)
            need = np.count_nonzero(low, axis=1)
            y[low] = (y[low] << np.uint64(32)) | words[ranges(at, need)]
            at += need
            x[:, :width] = y
        return out

    def block(self, block: dict) -> np.ndarray:
        return self.blocks([block])

    def blocks(self, blocks: list[dict]) -> np.ndarray:
        """The ids of some blocks, one after another; spans of equal size are decoded side by side."""
        alike: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for i, b in enumerate(blocks):
            for k in range(len(b["check_at"])):
                first, last, lanes, size = _extent(b, k)
                alike.setdefault((last - first, lanes, size), []).append((i, k))
        found = {}
        for places in alike.values():
            for lo in range(0, len(places), AT_ONCE):
                some = places[lo : lo + AT_ONCE]
                found.update(zip(some, self._side_by_side([(blocks[i], k) for i, k in some])))
        out = [np.zeros(0, np.uint32)]
        for i, b in enumerate(blocks):
            ids = np.concatenate([np.zeros(0, np.uint32), *(found.pop((i, k)) for k in range(len(b["check_at"])))])
            if zlib.crc32(ids.astype("<u4").tobytes()) != b["crc32"]:
                raise ValueError("a block's ids don't agree with its checksum")
            out.append(ids)
        return np.concatenate(out)


def _extent(block: dict, k: int) -> tuple[int, int, int, int]:
    """(first step, the one behind the last, lanes, ids) of a block's span."""
    n, lanes = block["n_ids"], block["lanes"]
    first, last = k * CHECK_STEPS, min((k + 1) * CHECK_STEPS, -(-n // lanes))
    return first, last, lanes, min(last * lanes, n) - first * lanes
