"""Run every registered query in Spark and its oracle SQL in DuckDB and
compare like the driver does: sorted column names, row count, and an
order-insensitive comparison of the values.

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in rows]


def key(r):
    return tuple((0, "") if x is None else (1, str(x)) for x in r)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    from __spark_entry__ import oracle_sql, queries
    from daybook.session import build_session
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"NOSQL {name}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        problems = []
        if sorted(scols) != sorted(dcols):
            problems.append(f"cols spark={sorted(scols)} duck={sorted(dcols)}")
        if len(srows) != len(drows):
            problems.append(f"rows spark={len(srows)} duck={len(drows)}")
        if not problems:
            a = sorted(rows_of(scols, srows), key=key)
            b = sorted(rows_of(dcols, drows), key=key)
            diff = [(x, y) for x, y in zip(a, b) if x != y]
            if diff:
                problems.append(f"{len(diff)} value diffs, e.g. spark={diff[0][0]} duck={diff[0][1]}")
        if problems:
            bad += 1
            print(f"FAIL {name} ({ts:.1f}s): " + "; ".join(problems))
        else:
            print(f"OK   {name}: {len(srows)} rows ({ts:.1f}s)")
    print(f"done, {bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
