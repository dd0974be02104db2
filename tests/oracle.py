"""Runs registered queries next to their SQL and compares rows.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float) and not math.isnan(v):
        return round(v, 6) + 0.0
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr), [columns[i] for i in order]


def compare(spark, con, sf_dir, fn, sql):
    """None when equal, else a short account of the difference."""
    t0 = time.perf_counter()
    df = fn(spark, sf_dir)
    got, got_cols = _rows(df.columns, df.collect())
    t1 = time.perf_counter()
    rel = con.execute(sql)
    want, want_cols = _rows([d[0] for d in rel.description], rel.fetchall())
    t2 = time.perf_counter()
    times = f"spark {t1 - t0:.2f}s, sql {t2 - t1:.2f}s"
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}", times
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", times
    diff = [(g, w) for g, w in zip(got, want) if g != w]
    if diff:
        return f"{len(diff)}/{len(got)} rows differ, first:\n   {str(diff[0][0])[:600]}\n   {str(diff[0][1])[:600]}", times
    types = [(f.name, f.dataType.simpleString()) for f in df.schema]
    return None, f"{len(got)} rows, {times}" + (f" {types}" if os.environ.get("TYPES") else "")


if __name__ == "__main__":
    import __spark_entry__ as entry
    from lodestone.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g", spark__ui__enabled="false")
    con = connect(sf)
    names = sys.argv[2:] or list(entry.queries())
    bad = 0
    for name in names:
        fn, sql = entry.queries()[name], entry.oracle_sql().get(name)
        try:
            if sql is None:
                t = time.perf_counter()
                print(f"rows {name}: {fn(spark, sf).count()} in {time.perf_counter() - t:.2f}s", flush=True)
                continue
            problem, times = compare(spark, con, sf, fn, sql)
            bad += problem is not None
            print(f"{'ok  ' if problem is None else 'FAIL'} {name}: {problem or ''} {times}", flush=True)
        except Exception as e:
            bad += 1
            print(f"ERR  {name}: {type(e).__name__} {str(e)[:900]}", flush=True)
    print(f"{bad} bad of {len(names)}")
