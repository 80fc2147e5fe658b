"""Compare a registered query with its DuckDB oracle on one folder.

Usage: python -m tests.oracle_util [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


#: floats are compared as they are, but for the last bits of sums whose order differs
DIGITS = 12


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.{DIGITS}g}") + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def compare(spark, con, name: str, build, sql: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = build(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    t2 = time.time()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark-only={sorted(set(s_cols)-set(d_cols))} duck-only={sorted(set(d_cols)-set(s_cols))}"
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_norm = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    d_norm = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    if len(s_norm) != len(d_norm):
        return False, f"row count spark={len(s_norm)} duck={len(d_norm)}"
    for a, b in zip(s_norm, d_norm):
        if a != b:
            diffs = [(order[i], a[i], b[i]) for i in range(len(order)) if a[i] != b[i]]
            return False, f"first differing row: {diffs[:6]}"
    return True, f"{len(s_norm)} rows ok (spark {t1-t0:.1f}s, duck {t2-t1:.2f}s)"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    sys.path.insert(0, ".")
    from duelframe.plans.registry import load_all
    from duelframe.session import get_session
    spark = get_session("local[8]")
    con = duck(sf_dir)
    reg = load_all()
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        if q.sql is None:
            t0 = time.time()
            n = q.build(spark, sf_dir).count()
            print(f"{name:40s} NO-ORACLE rows={n} ({time.time()-t0:.1f}s)")
            continue
        try:
            ok, msg = compare(spark, con, name, q.build, q.sql, sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:40s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
