"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Comparison is order-insensitive and exact: both results are normalised
(dates/timestamps to ISO text, decimals to float, arrays to tuples) and
compared as sorted row lists, after checking column names and row counts.
Queries round their own float outputs where the engines could differ in
summation order, so no tolerance is applied here.

CLI: ``python tests/oracle_harness.py [sf_dir] [key ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), x if x is not None else 0) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return False, f"columns differ: spark={spark_cols} duck={duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return False, f"row count spark={len(spark_rows)} duck={len(duck_rows)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first differing row: spark={x} duck={y} (cols {order})"
    return True, f"{len(a)} rows"


def check(spark, sf_dir: str, keys=None, verbose=True):
    sys.path.insert(0, ".")
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
            if k not in sql:
                results[k] = (None, f"no oracle; {len(srows)} rows")
            else:
                cur = con.execute(sql[k])
                dcols = [d[0] for d in cur.description]
                drows = cur.fetchall()
                results[k] = compare(srows, scols, drows, dcols)
        except Exception as e:  # noqa: BLE001 - report and continue
            results[k] = (False, f"error: {type(e).__name__}: {str(e)[:400]}")
        if verbose:
            ok, msg = results[k]
            print(f"{'PASS' if ok else ('----' if ok is None else 'FAIL')} {k:40s} {time.time()-t0:6.2f}s {msg}",
                  flush=True)
    return results


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from riskspark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = local_session()
    res = check(spark, sf, keys)
    bad = [k for k, (ok, _) in res.items() if ok is False]
    print(f"{len(res) - len(bad)}/{len(res)} ok; failing: {bad}")
