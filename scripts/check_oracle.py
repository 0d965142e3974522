"""Run every registered query in Spark and its SQL in DuckDB; compare row
count, column names and (rounded, order-insensitive) values.

usage: python scripts/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from knnrec.plans.oracle import oracle_queries  # noqa: E402
from knnrec.plans.queries import QUERIES  # noqa: E402
from knnrec.session import build_session  # noqa: E402
from knnrec.sources.tables import TABLES, table_path  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def rows_key(rows, cols):
    order = sorted(range(len(cols)), key=lambda j: cols[j])
    out = [tuple(norm(r[j]) for j in order) for r in rows]
    return sorted(out, key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(QUERIES)
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf, t)}')")
    oracle = oracle_queries()
    bad = 0
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf)
        srows = df.collect()
        t1 = time.time()
        scols = df.columns
        if name not in oracle:
            print(f"{name:24s} rows-only {len(srows)} rows  spark {t1 - t0:.1f}s", flush=True)
            continue
        res = con.execute(oracle[name])
        dcols = [d[0] for d in res.description]
        drows = res.fetchall()
        t2 = time.time()
        status = "OK"
        if sorted(scols) != sorted(dcols):
            status = f"COLS spark={scols} duck={dcols}"
        elif len(srows) != len(drows):
            status = f"ROWS spark={len(srows)} duck={len(drows)}"
        else:
            a, b = rows_key(srows, scols), rows_key(drows, dcols)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y]
                status = f"VALUES {len(diff)} differ, e.g. {diff[:2]}"
        bad += status != "OK"
        print(f"{name:24s} {status}  rows={len(srows)} spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s",
              flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
