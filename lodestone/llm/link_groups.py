"""Links between sets of a group, for groups of any size: tiles of bounded size meet two by two with whole sets.

A tile pair gives back only links that join components, at most one per
component joined, so what is written grows with the sets and not with pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.components import relabel
from lodestone.session import materialise

TILE_SETS, TILE_KEYS = 1000, 1 << 20


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def tile_links(n: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], side: np.ndarray, same: bool, similar: int) -> list[tuple[int, int]]:
    """Links between sets of different labels, of two tiles (or within one); only as many as join the labels."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keys = np.concatenate([np.zeros(0, np.uint64), *sets])
    order = np.argsort(keys, kind="stable")
    keys, row = keys[order], row[order]
    at = runs(keys)
    many = np.diff(np.append(at, len(keys)))
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))
    place = np.zeros(len(sets), np.int64)
    place[left] = np.arange(len(left))
    if not same:
        place[right] = np.arange(len(right))
    both = np.zeros((len(left), len(right)), np.int32)
    wide = at[many >= 32]
    for some in np.array_split(wide, max(1, -(-len(wide) // 2048))):  # shingles of many sets, as a product of 0/1 matrices
        has = np.zeros((len(sets), len(some)), np.float32)
        for k, (a, c) in enumerate(zip(some.tolist(), many[np.searchsorted(at, some)].tolist())):
            has[row[a : a + c], k] = 1
        both += (has[left] @ has[right].T).astype(np.int32)
    for a, c in zip(at[(many > 1) & (many < 32)].tolist(), many[(many > 1) & (many < 32)].tolist()):
        who = row[a : a + c]
        l, r = (who, who) if same else (who[side[who] == 0], who[side[who] == 1])
        both[np.ix_(place[l], place[r])] += 1
    good = (100 * both >= similar * (n[left][:, None] + n[right][None, :] - both)) & (both > 0) & (labels[left][:, None] != labels[right][None, :])
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(good)):
        a, b = int(left[i]), int(right[j])
        p, q = top(int(labels[a])), top(int(labels[b]))
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((a, b))
    return out


def links_in_groups(nodes: DataFrame, groups: DataFrame | None, sets: DataFrame, similar: int) -> DataFrame | None:
    """(a, b): links of at least ``similar`` per cent that join the components of each group; None if there is no group.

    nodes: node, label (its component so far).  groups: node, label (of its group).  sets: node, n (size), keys
    (ascending 64-bit hashes; shingles that no other set has may be left out).
    """
    if groups is None:
        return None
    rows = relabel(nodes.withColumn("grp", F.col("node")), "grp", groups)
    rows = materialise(rows.join(sets, "node"), "group-sets")
    tiles = rows.groupBy("grp").agg(F.greatest(F.ceil(F.count("*") / TILE_SETS), F.ceil(F.sum(F.length("keys")) / (8 * TILE_KEYS))).cast("int").alias("tiles"))
    rows = rows.join(materialise(tiles, "group-tiles"), "grp")
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.withColumns({"t1": F.least("own", "other"), "t2": F.greatest("own", "other")}).drop("tiles", "other")

    def compare(group: pa.Table) -> pa.Table:
        t1, t2 = group["t1"][0].as_py(), group["t2"][0].as_py()
        group = group.sort_by("node")
        ids, side = group["node"].to_numpy(), (group["own"].to_numpy() != t1).astype(np.int8)
        sets = [np.frombuffer(k, np.uint64) for k in group["keys"].to_pylist()]
        found = tile_links(group["n"].to_numpy(), group["label"].to_numpy(), sets, side, t1 == t2, similar)
        return pa.table({"a": pa.array([ids[a] for a, _ in found], pa.int64()), "b": pa.array([ids[b] for _, b in found], pa.int64())})

    return rows.groupBy("grp", "t1", "t2").applyInArrow(compare, "a long, b long")
