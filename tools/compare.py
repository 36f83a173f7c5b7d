"""Run each registered query on Spark and its SQL twin on DuckDB; compare rows, names and values.

    python tools/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from admart.oracle import ORACLE_SQL  # noqa: E402
from admart.queries import QUERIES  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v, digits: int | None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits is None:
            return repr(v)
        return f"{v:.{digits}g}"
    if isinstance(v, Decimal):
        return norm(float(v), digits)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(float(v)) if digits is None else f"{float(v):.{digits}g}"
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return str([norm(x, digits) for x in v])
    return str(v)


def bag(rows, cols, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i], digits) for i in order) for r in rows)


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    from admart.session import build_session
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
            t1 = time.time()
            rel = con.sql(ORACLE_SQL[name])
            dcols = rel.columns
            drows = rel.fetchall()
            t2 = time.time()
        except Exception as e:  # noqa: BLE001
            print(f"{name:24s} ERROR {type(e).__name__}: {str(e)[:800]}")
            bad += 1
            continue
        names_ok = sorted(scols) == sorted(dcols)
        exact = names_ok and bag(srows, scols, None) == bag(drows, dcols, None)
        close = names_ok and bag(srows, scols, 12) == bag(drows, dcols, 12)
        status = "EXACT" if exact else ("CLOSE" if close else "DIFF")
        if not close:
            bad += 1
        print(f"{name:24s} {status:5s} rows spark={len(srows)} duck={len(drows)} names_ok={names_ok} "
              f"spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s", flush=True)
        if not names_ok:
            print("   spark-only:", sorted(set(scols) - set(dcols)), "duck-only:", sorted(set(dcols) - set(scols)))
        elif not close:
            a, b = bag(srows, scols, 12), bag(drows, dcols, 12)
            only_s, only_d = list((a - b).items())[:3], list((b - a).items())[:3]
            print("   cols:", sorted(scols))
            print("   spark-only:", only_s)
            print("   duck-only :", only_d)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
