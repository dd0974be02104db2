import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.constants import RECURSIVE_SEPARATORS, SENTENCE_SEPARATORS
from lodestone.functions.splitters import split_recursive


def naive(text, size, overlap, seps):
    """The contract on plain strings: cut, pack, carry a tail, recurse."""
    found = [s for s in seps if s in text]
    if not found:
        return [text]
    sep, later = found[0], seps[seps.index(found[0]) + 1 :]
    head, *tails = text.split(sep)
    pieces = [p for p in [head] + [sep + t for t in tails] if p]
    out, window = [], []

    def flush():
        if window:
            out.append("".join(window))

    for piece in pieces:
        if len(piece) >= size:
            flush()
            window.clear()
            out.extend(naive(piece, size, overlap, later) if later else [piece])
            continue
        if sum(map(len, window)) + len(piece) > size:
            flush()
            while window and (sum(map(len, window)) > overlap or sum(map(len, window)) + len(piece) > size):
                window.pop(0)
        window.append(piece)
    flush()
    return out


def expected(text, size, overlap, seps):
    return [c for c in (c.strip() for c in naive(text, size, overlap, seps)) if c] if text else []


TEXT = st.text(alphabet="ab.!? \n", max_size=120)


@settings(max_examples=600, deadline=None)
@given(TEXT, st.integers(1, 30), st.integers(0, 12), st.sampled_from([RECURSIVE_SEPARATORS, SENTENCE_SEPARATORS]))
def test_agrees_with_plain_string_version(text, size, overlap, seps):
    overlap = min(overlap, size - 1)
    assert split_recursive(text, size, overlap, seps) == expected(text, size, overlap, seps)


@pytest.mark.parametrize("size,overlap", [(800, 80), (450, 50), (200, 30), (900, 90)])
def test_long_texts(size, overlap):
    rng = random.Random(size)
    for _ in range(20):
        words = ["".join(rng.choices("abcdef", k=rng.randint(1, 12))) for _ in range(rng.randint(1, 2000))]
        text = "".join(w + rng.choice([" ", " ", " ", ". ", "\n", "\n\n"]) for w in words)
        got = split_recursive(text, size, overlap, RECURSIVE_SEPARATORS)
        assert got == expected(text, size, overlap, RECURSIVE_SEPARATORS)
        assert all(len(c) <= size for c in got)
        at = 0  # chunks come in order and lie in the text
        for c in got:
            at = text.index(c, max(0, at - overlap))


def test_edges():
    assert split_recursive("", 10, 2, RECURSIVE_SEPARATORS) == []
    assert split_recursive(None, 10, 2, RECURSIVE_SEPARATORS) == []
    assert split_recursive("x" * 50, 10, 2, RECURSIVE_SEPARATORS) == ["x" * 50]
    assert split_recursive("a" * 10, 10, 0, RECURSIVE_SEPARATORS) == ["a" * 10]
    assert split_recursive("aaaa bbbb cc", 9, 0, RECURSIVE_SEPARATORS) == ["aaaa bbbb", "cc"]
    assert split_recursive("aaa bbb ccc", 8, 4, [" "]) == ["aaa bbb", "bbb ccc"]
