"""Run named queries in Spark and their SQL oracle in DuckDB; compare.

Mirrors the driver's gate: row count, column names (sorted), and an
order-insensitive comparison of the values.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: The small fixture the tests run on.
SF_SMALL = "/root/testdata/sf0.001"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    import datetime
    import decimal
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, repr(v))
    if isinstance(v, decimal.Decimal):
        return (2, repr(float(v)))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return (3, v.isoformat())
    if isinstance(v, bool):
        return (4, str(v))
    if isinstance(v, int):
        return (2, repr(float(v))) if False else (5, str(v))
    return (6, str(v))


def rows_of(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_n = len(s_rows) == len(d_rows)
    ok_v = ok_cols and ok_n and rows_of(s_rows, s_cols) == rows_of(d_rows, d_cols)
    status = "OK " if (ok_cols and ok_n and ok_v) else "BAD"
    print(f"{status} {name:28s} rows={len(s_rows)}/{len(d_rows)} cols={ok_cols} "
          f"vals={ok_v} spark={t1 - t0:.1f}s", flush=True)
    if not ok_cols:
        print("   spark cols", s_cols, "\n   duck  cols", d_cols)
    elif not ok_v:
        a = rows_of(s_rows, s_cols)
        b = rows_of(d_rows, d_cols)
        sa, sb = set(a), set(b)
        print("   only spark:", [x for x in a if x not in sb][:3])
        print("   only duck :", [x for x in b if x not in sa][:3])
    return status == "OK "


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir = args.pop(0)
    import __spark_entry__ as E
    from starledger.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs = E.queries()
    oracles = E.oracle_sql()
    names = args or sorted(qs)
    bad = []
    for n in names:
        if n not in oracles:
            print(f"--  {n:28s} (no oracle)")
            continue
        try:
            if not compare(spark, con, n, qs[n], oracles[n], sf_dir):
                bad.append(n)
        except Exception as e:  # report and go on
            print(f"ERR {n}: {type(e).__name__}: {str(e)[:400]}")
            bad.append(n)
    print("FAILED:", bad)


if __name__ == "__main__":
    main()
