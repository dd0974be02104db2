"""Byte-pair encoding of whole texts through their distinct units.

The pattern that cuts texts into pieces never joins a non-blank with a blank
behind it, and a blank run gives its last space to the word that follows.  A
text can therefore be cut before a space, except where that space stands
between two blanks, and each unit encoded by itself.  A unit is encoded once in
a worker's life, however often it occurs; the ids of a text are put together
by array operations.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lodestone.llm.common import ranges

# A space that can't be cut at: behind a blank and before a blank or the end.
NO_CUT = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}] (?:[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]|$)"
LONG_UNIT = 200  # characters; longer units are encoded but not remembered
MOST_UNITS = 700_000  # remembered at once in a worker

# distinct units -> (ids of all, ids per unit, characters per token: start and end within the unit)
Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


class UnitEncoder:
    """``encode`` gets the units not seen before; ``split`` cuts a text whose spaces can't be trusted, or that matches ``marks``."""

    def __init__(self, encode: Encode, split: Callable[[str], list[str]], offsets: bool = False, marks: str = ""):
        self.encode, self.split, self.offsets, self.marks = encode, split, offsets, marks
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.size = 0
        self.ids, self.begin, self.end = (np.zeros(1 << 16, np.uint32) for _ in range(3))
        self.at, self.many, self.chars = (np.zeros(1 << 14, np.int64) for _ in range(3))
        self.used = 0

    def _room(self, names: tuple[str, ...], need: int) -> None:
        for name in names:
            have = getattr(self, name)
            if need > len(have):
                more = np.zeros(max(need, 2 * len(have)), have.dtype)
                more[: len(have)] = have
                setattr(self, name, more)

    def _add(self, units: list[str]) -> np.ndarray:
        """Numbers of units; unseen ones are encoded first."""
        numbers = self.number
        found = np.fromiter(map(numbers.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            names = [units[k] for k in missing.tolist()]
            new = list(dict.fromkeys(names))
            ids, many, begin, end = self.encode(new)
            n, used = self.size, self.used
            self._room(("ids",) + (("begin", "end") if self.offsets else ()), used + len(ids))
            self._room(("at", "many", "chars"), n + len(new))
            self.ids[used : used + len(ids)] = ids
            if self.offsets:
                self.begin[used : used + len(ids)], self.end[used : used + len(ids)] = begin, end
            self.many[n : n + len(new)] = many
            self.chars[n : n + len(new)] = [len(u) for u in new]
            self.at[n : n + len(new)] = used + np.cumsum(many) - many
            numbers.update(zip(new, range(n, n + len(new))))
            self.size, self.used = n + len(new), used + len(ids)
            found[missing] = np.fromiter(map(numbers.__getitem__, names), np.int64, len(names))
        return found

    def rows(self, texts: pa.Array):
        """(ids, ids per row) of a column of texts; with offsets also the characters each token covers."""
        if self.size > MOST_UNITS:
            self.forget()
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, NO_CUT)
        if self.marks:
            odd = pc.or_(odd, pc.match_substring_regex(texts, self.marks))
        easy = pc.if_else(odd, "", texts)
        cut = pc.split_pattern(easy, " ")
        flat = cut.flatten()
        lengths = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.zeros(len(flat), bool)
        first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True  # has no space before it
        coded = flat.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + first
        seen = np.flatnonzero(np.bincount(code, minlength=2 * len(coded.dictionary)))
        names = coded.dictionary.take(pa.array(seen >> 1)).to_numpy(zero_copy_only=False).tolist()
        units = [w if f else " " + w for w, f in zip(names, seen & 1)]
        number = np.zeros(2 * len(coded.dictionary), np.int64)
        number[seen] = known = self._add(units)
        unit = number[code]
        row = np.repeat(np.arange(len(lengths)), lengths)
        strange = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(strange):  # in place of their single empty unit
            pieces = [self.split(texts[int(i)].as_py()) for i in strange]
            more = self._add([p for ps in pieces for p in ps])
            unit = np.concatenate([unit, more])
            row = np.concatenate([row, np.repeat(strange, [len(p) for p in pieces])])
            order = np.argsort(row, kind="stable")
            unit, row = unit[order], row[order]
        many = self.many[unit]
        where = ranges(self.at[unit], many)
        per_row = np.bincount(row, weights=many, minlength=len(texts)).astype(np.int64)
        out = self.ids[where], per_row
        if self.offsets:
            size = self.chars[unit]
            ends = np.cumsum(size)
            base = np.cumsum(np.bincount(row, weights=size, minlength=len(texts)).astype(np.int64))
            before = np.concatenate([[0], base])[row]
            shift = np.repeat(ends - size - before, many)
            out += (self.begin[where] + shift, self.end[where] + shift)
        for k in np.flatnonzero(self.chars[known] > LONG_UNIT).tolist():  # the ids of long ones stay until the next forget(), their names don't
            del self.number[units[k]]
        return out
