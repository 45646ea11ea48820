"""Run each registered query in Spark and its SQL in DuckDB and compare.

Comparison: same column names (sorted), same row count, and the same
multiset of rows after normalising numbers (floats to 6 places).
Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from tabspark.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, int):
        return float(v)
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def kind(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    if isinstance(v, float):
        return "float"
    return type(v).__name__


def kinds(cols, rows):
    out = {}
    for r in rows:
        for c, v in zip(cols, r):
            k = kind(v)
            if k is not None:
                out.setdefault(c, set()).add(k)
    return out


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return f"{name}: rows-only {len(srows)} rows ({t1 - t0:.1f}s)", True
    res = con.sql(sql)
    dcols = res.columns
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return f"{name}: COLUMNS differ spark={sorted(scols)} duck={sorted(dcols)}", False
    ks, kd = kinds(scols, srows), kinds(dcols, drows)
    type_diff = {c: (ks.get(c), kd.get(c)) for c in scols if ks.get(c) != kd.get(c)}
    if type_diff:
        return f"{name}: TYPES differ {type_diff}", False
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if len(a) != len(b):
        return f"{name}: ROWCOUNT spark={len(a)} duck={len(b)}", False
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return f"{name}: VALUES differ, e.g. {diff}", False
    return f"{name}: ok {len(a)} rows ({t1 - t0:.1f}s)", True


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            msg, ok = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as exc:  # report and go on
            msg, ok = f"{name}: ERROR {type(exc).__name__}: {str(exc)[:400]}", False
        bad += not ok
        print(msg, flush=True)
    print(f"failures: {bad}")


if __name__ == "__main__":
    main()
