"""The byte-level vocabulary of the tokenizers library, unit by unit."""

from __future__ import annotations

import gc
import os
from itertools import chain, repeat

import numpy as np
import regex

from lodestone.llm.common import ranges, worker_memory
from lodestone.llm.units import UnitEncoder

MOST_PIECES = 300_000  # remembered at once in a worker
PIECES_AT_ONCE = 20_000  # in a call of the library
CLOSING = ".,;:!?\"#$%&()*+-/<=>@[]^_`{|}~\\"  # ASCII marks but the apostrophe, which can begin a piece with letters behind it


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others as letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _pieces(unit: str, split) -> list[str] | tuple[str, ...]:
    """The pattern's pieces of a unit; the pattern itself is only asked where a unit isn't letters and then marks."""
    word = unit[1:] if unit[:1] == " " else unit
    if word.isalpha():
        return (unit,)
    core = word.rstrip(CLOSING)
    if core.isalpha():
        n = len(unit) - len(word) + len(core)
        return unit[:n], unit[n:]
    return split(unit)


def _places(piece: str, sizes: list[int]) -> tuple[list[int], list[int]]:
    """The characters each token covers: every one it has bytes of."""
    char = range(len(piece)) if piece.isascii() else [i for i, c in enumerate(piece) for _ in c.encode()]
    begin, end, at = [], [], 0
    for n in sizes:
        begin.append(char[at])
        at += n
        end.append(char[at - 1] + 1)
    return begin, end


def _cutter(tokens: list, split):
    """Cuts texts at added tokens first, the longest of those that begin together, then what lies between by ``split``."""
    passes = []
    for normalized in (False, True):  # the library's order
        names = sorted((t for t in tokens if t.normalized == normalized), key=lambda t: -len(t.content))
        if names:
            passes.append(regex.compile("(" + "|".join(r"\s*" * t.lstrip + regex.escape(t.content) + r"\s*" * t.rstrip for t in names) + ")").split)

    def cut(text: str) -> list[str]:
        between, found = [text], [False]
        for at_tokens in passes:
            parts = [[x] if f else at_tokens(x) for x, f in zip(between, found)]
            found = [f or i % 2 == 1 for p, f in zip(parts, found) for i in range(len(p))]
            between = [x for p in parts for x in p]
        return [x for part, f in zip(between, found) for x in ([part] if f else split(part))]

    return cut


class Held:
    """The tokens of pieces: ids and, with offsets, the characters each covers; ``at`` and ``many`` say which are of a piece."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.ids, self.begin, self.end = (np.zeros(1 << 12, np.uint32) for _ in range(3))
        self.at, self.many = (np.zeros(1 << 12, np.int64) for _ in range(2))
        self.used = self.size = 0

    def _put(self, names: tuple[str, ...], at: int, values) -> int:
        """Where the next values go."""
        for name, x in zip(names, values):
            have = getattr(self, name)
            if at + len(x) > len(have):
                have = np.concatenate([have, np.zeros(max(len(have), at + len(x) - len(have)), have.dtype)])
                setattr(self, name, have)
            have[at : at + len(x)] = x
        return at + len(values[0])

    def add(self, ids, many, *places) -> None:
        """Some pieces, in order: ids of all, ids of each and, with offsets, the tokens' first and last characters."""
        self.size = self._put(("at", "many"), self.size, (self.used + np.cumsum(many) - many, many))
        self.used = self._put(("ids", "begin", "end"), self.used, (ids, *places))


def encoder(path: str, pattern: str, offsets: bool = False, encode_special_tokens: bool = True) -> UnitEncoder:
    """The worker's encoder for a vocabulary file.

    encode_special_tokens: as the library has it; special tokens in a text are spelled out, else each has its own id.
    """

    def make() -> UnitEncoder:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        tokenizer = Tokenizer.from_file(path)
        added = {t.content: (i, t) for i, t in tokenizer.get_added_tokens_decoder().items() if not (t.special and encode_special_tokens)}
        if any(t.single_word for _, t in added.values()):
            raise ValueError("added tokens that must be whole words aren't supported")
        letters, split = byte_letters() | {0xFF: " "}, regex.compile(pattern).findall
        model = Tokenizer(tokenizer.model)  # nothing but the model: pieces come cut, and marks of the text aren't looked for
        model.pre_tokenizer = WhitespaceSplit()

        sizes = np.zeros(max(tokenizer.get_vocab().values(), default=0) + 1, np.int64)  # bytes of each token: its letters
        for token, i in tokenizer.get_vocab().items():
            sizes[i] = len(token)

        def encode_pieces(pieces: list[str]) -> None:
            """One call of the library for some pieces; the tokens' sizes say which piece they are of."""
            raw = [p.encode() for p in pieces]
            ids = np.array(model.encode_batch_fast([b"\xff".join(raw).decode("latin-1").translate(letters)], add_special_tokens=False)[0].ids, np.int64)  # no UTF-8 has that byte
            covered, stops = sizes[ids], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
            if int(covered.sum()) != int(stops[-1]):  # the vocabulary lacks a byte, which the library leaves out
                got = [model.model.tokenize(x.decode("latin-1").translate(letters)) for x in raw]
                ids, many = np.array([t.id for g in got for t in g], np.int64), np.array([len(g) for g in got], np.int64)
                covered = np.array([len(t.value) for g in got for t in g], np.int64)
            else:
                many = np.diff(np.searchsorted(np.cumsum(covered), stops, side="right"), prepend=0)
            if offsets:
                each, ends = covered.tolist(), np.cumsum(many).tolist()
                places = [_places(p, each[a:b]) for p, a, b in zip(pieces, [0, *ends], ends)]
                held.add(ids, many, *(list(chain.from_iterable(x[k] for x in places)) for k in (0, 1)))
            else:
                held.add(ids, many)
            known.update(zip(pieces, range(len(known), len(known) + len(pieces))))

        known: dict = {}  # a piece's number in ``held``
        held = Held()

        def encode(units: list[str]):
            if len(known) > MOST_PIECES:
                known.clear()
                held.forget()
            gc.disable()  # hundreds of thousands of small lists, none of them in a cycle
            cut = [_pieces(unit, split) for unit in units]
            for k in [k for k, unit in enumerate(units) if unit.strip() in added] if added else ():
                cut[k] = (piece,) = ((added[units[k].strip()][0], len(units[k])),)
                if piece not in known:
                    held.add([piece[0]], [1], *([0], [piece[1]]) if offsets else ())
                    known[piece] = len(known)
            flat, pieces = list(chain.from_iterable(cut)), np.fromiter(map(len, cut), np.int64, len(cut))
            number = np.fromiter(map(known.get, flat, repeat(-1)), np.int64, len(flat))
            missing = np.flatnonzero(number < 0)
            names = [flat[k] for k in missing.tolist()]
            new = list(dict.fromkeys(names))
            for lo in range(0, len(new), PIECES_AT_ONCE):
                encode_pieces(new[lo : lo + PIECES_AT_ONCE])
            number[missing] = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
            tokens = held.many[number]
            where = ranges(held.at[number], tokens)
            row = np.repeat(np.arange(len(cut)), pieces)
            many = np.bincount(row, weights=tokens, minlength=len(cut)).astype(np.int64)
            out = [held.ids[where]]
            if offsets:
                size = np.fromiter(map(len, flat), np.int64, len(flat))
                before = np.cumsum(size) - size
                shift = np.repeat(before - before[(np.cumsum(pieces) - pieces)[row]], tokens) if len(flat) else tokens
                out += [(x[where] + shift).astype(np.uint32) for x in (held.begin, held.end)]
            gc.enable()
            return out[0], many, *(out[1:] or [np.zeros(0, np.uint32)] * 2)

        if not added:
            return UnitEncoder(encode, split, offsets)
        marks = "|".join(r"\Q" + content + r"\E" for content in added)
        return UnitEncoder(encode, _cutter([t for _, t in added.values()], split), offsets, marks)

    return worker_memory(f"hf:{path}:{offsets}:{encode_special_tokens}", make)
