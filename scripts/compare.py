"""Run registered queries in Spark and their SQL oracles in DuckDB, compare.

    python scripts/compare.py [sf_dir] [name ...]

Prints one line per query: rows on both sides, column names, and whether the
order-insensitive value multisets are equal.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from filingflow.plans.catalog import ORACLE, QUERIES  # noqa: E402
from filingflow.session import build_session  # noqa: E402
from filingflow.sources.tables import TABLE_NAMES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if a != sf] or list(QUERIES)
    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ORACLE:
            print(f"{name:28s} spark={len(srows):7d} rows {ts:5.1f}s  (no oracle)")
            continue
        try:
            rel = con.sql(ORACLE[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        same_cols = sorted(scols) == sorted(dcols)
        same_vals = same_cols and rows_key(scols, srows) == rows_key(dcols, drows)
        ok = same_cols and same_vals and len(srows) == len(drows)
        bad += not ok
        print(
            f"{name:28s} spark={len(srows):7d} duck={len(drows):7d} {ts:5.1f}s "
            f"{'OK' if ok else 'MISMATCH'}"
            + ("" if same_cols else f" cols spark={sorted(scols)} duck={sorted(dcols)}")
        )
        if not ok and same_cols:
            a, b = rows_key(scols, srows), rows_key(dcols, drows)
            sa, sb = set(a), set(b)
            print("   spark-only:", list(sa - sb)[:3])
            print("   duck-only: ", list(sb - sa)[:3])
    print(f"{len(names) - bad}/{len(names)} ok")
    spark.stop()


if __name__ == "__main__":
    main()
