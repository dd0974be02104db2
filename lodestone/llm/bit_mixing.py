"""The bit predictor of operator 5: hashed contexts, gated mixing, adaptive refinement.

A unit is a run of blanks with the word behind it and an end mark.  Its bytes are
predicted bit by bit, each bit by several contexts: the bytes before it (one,
two, three, four) and all of the unit so far.  A context's slot, found by a hash, holds
counts of zeros and ones.  The contexts' logits are added with weights that a
gate picks by bit, place and the evidence of the longest context; weights follow
the prediction error, online.  Last a table indexed by the bit's node and the
mixed logit, itself made of outcomes, refines the probability.
"""

from __future__ import annotations

import numpy as np

from lodestone.llm.words import mix

TABLE_BITS = (15, 17, 18, 18, 18)  # per context: 1, 2, 3, 4 bytes, the unit so far; all sizes are fixed
ORDERS = (1, 2, 3, 4)
OFFSETS = np.cumsum([0, *(1 << b for b in TABLE_BITS)])
SLOTS = int(OFFSETS[-1])
INPUTS = len(TABLE_BITS) + 1
PLACES, EVIDENCE = 4, 12
GATES = 8 * PLACES * EVIDENCE
BUCKETS = 33  # of the mixed logit, from -8 to 8
RATE, DAMPING = 0.25, 20.0  # of a weight's step, which its curvature scales
UNITS_AT_ONCE = 1 << 13


class Walk:
    """Steps through the bits of many units at once; per step the units still going on, their slots, bits and gate parts."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.data, self.starts, self.lengths = data, starts, lengths

    def __iter__(self):
        order = np.argsort(-self.lengths, kind="stable")
        starts, lengths = self.starts[order], self.lengths[order]
        near = np.zeros(len(order), np.uint64)  # the last bytes
        whole = np.full(len(order), 0x1234567, np.uint64)
        salts = [np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1) for k in range(len(TABLE_BITS))]
        for place in range(int(lengths[0]) if len(lengths) else 0):
            n = int(np.searchsorted(-lengths, -place, side="left"))  # longer than ``place``
            byte = self.data[starts[:n] + place]
            near, whole = near[:n], whole[:n]
            contexts = [near & np.uint64((1 << 8 * k) - 1) for k in ORDERS] + [whole]
            seeds = [mix(c + salt) for c, salt in zip(contexts, salts)]
            node = np.ones(n, np.uint64)
            for bit in range(7, -1, -1):
                spread = node * np.uint64(0xD6E8FEB86659FD93)
                slots = [((s ^ spread) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - b)).astype(np.int64) + int(o) for s, b, o in zip(seeds, TABLE_BITS, OFFSETS)]
                y = (byte >> bit) & 1
                yield order[:n], slots, y, bit, min(place, PLACES - 1), node.astype(np.int64)
                node = node * np.uint64(2) + y
            near = near << np.uint64(8) | byte
            whole = mix(whole ^ (byte.astype(np.uint64) + np.uint64(0x100)) * np.uint64(0x2545F4914F6CDD1D))


def logit(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4)))  # of whole numbers, at least 0


def evidence(total: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(total, 0) + 1), EVIDENCE - 1).astype(np.int64)


def gate(bit: int, place: int, level: int) -> int:
    return (bit * PLACES + place) * EVIDENCE + level


def bucket(mixed: np.ndarray) -> np.ndarray:
    return np.rint((np.clip(mixed, -8, 8) + 8) * ((BUCKETS - 1) / 16)).astype(np.int64)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -15, 15)))


def count(counts: np.ndarray, walk: Walk, times: np.ndarray) -> None:
    """Adds outcomes to counts: zeros and ones of each slot side by side, 2 * SLOTS numbers."""
    for rows, slots, y, *_ in walk:
        many = times[rows]
        for slot in slots:
            np.add.at(counts, 2 * slot + y, many)


def start_weights() -> np.ndarray:
    weights = np.zeros((INPUTS, GATES), np.float32)
    weights[: INPUTS - 1] = 0.3
    return weights


def learn(counts: np.ndarray, weights: np.ndarray, outcomes: np.ndarray, walk: Walk, times: np.ndarray, slower: float = 1.0) -> None:
    """Online: predicts each bit without the unit's own occurrences, as it is new units that are spelled, moves the gate's weights by the error, notes the outcome.

    outcomes: 2 * 256 * BUCKETS numbers of zeros and ones by the bit's node and the mixed logit.
    """
    zeros, ones = counts[0::2].copy(), counts[1::2].copy()
    for rows, slots, y, bit, place, node in walk:
        x = np.empty((INPUTS, len(rows)), np.float32)
        one = y.astype(np.float32)
        own = times[rows].astype(np.float32)
        for k, slot in enumerate(slots):
            before = np.maximum(zeros[slot] - (1 - one) * own, 0), np.maximum(ones[slot] - one * own, 0)
            x[k] = logit(*before)
        x[-1] = 0.3
        level = evidence(before[0] + before[1])
        here = weights[:, gate(bit, place, 0) : gate(bit, place, EVIDENCE)]
        mixed = (x * here[:, level]).sum(axis=0)
        p = squash(mixed)
        error, slope = y - p, p * (1 - p)
        for k in range(INPUTS):
            pull = error * x[k]
            bend = slope * x[k] * x[k]
            here[k] += RATE / slower * np.bincount(level, pull, EVIDENCE) / (np.bincount(level, bend, EVIDENCE) + DAMPING)
        np.clip(here, -1, 4, out=here)
        outcomes += np.bincount((y * np.int64(256) + node) * BUCKETS + bucket(mixed), None, len(outcomes))


def refinement(outcomes: np.ndarray) -> np.ndarray:
    """256 * BUCKETS probabilities of a one."""
    zeros, ones = outcomes.reshape(2, -1)
    middle = np.tile(squash(np.arange(BUCKETS, dtype=np.float32) * (16 / (BUCKETS - 1)) - 8), 256)
    return ((ones + 8 * middle) / (zeros + ones + 8)).astype(np.float32)


class Scorer:
    def __init__(self, counts: np.ndarray, weights: np.ndarray, refined: np.ndarray):
        pairs = counts.reshape(-1, 2)
        self.logits = logit(pairs[:, 0], pairs[:, 1]).astype(np.float32)
        self.level = evidence(pairs[OFFSETS[-2] :].sum(axis=1)).astype(np.uint8)
        self.weights, self.refined = weights, refined

    def log10(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 of each unit's probability."""
        out = np.zeros(len(starts))
        for rows, slots, y, bit, place, node in Walk(data, starts, lengths):
            here = self.weights[:, gate(bit, place, 0) : gate(bit, place, EVIDENCE)]
            level = self.level[slots[-1] - OFFSETS[-2]]
            mixed = here[-1][level] * np.float32(0.3)
            for k, slot in enumerate(slots):
                mixed += self.logits[slot] * here[k][level]
            one = 0.25 * squash(mixed) + 0.75 * self.refined[node * BUCKETS + bucket(mixed)]
            out[rows] += np.log10(np.clip(np.where(y == 1, one, 1 - one), 1e-7, 1))
        return out
