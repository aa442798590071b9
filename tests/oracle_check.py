"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Mirrors the driver's check: row count, column names, order-insensitive values.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, status="rows-only", rows=len(s_rows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    status = "ok"
    detail = ""
    if sorted(s_cols) != sorted(d_cols):
        status, detail = "schema", f"spark={sorted(s_cols)} duck={sorted(d_cols)}"
    elif len(s_rows) != len(d_rows):
        status, detail = "rowcount", f"spark={len(s_rows)} duck={len(d_rows)}"
    else:
        a, b = canon(s_rows, s_cols), canon(d_rows, d_cols)
        diffs = [(x, y) for x, y in zip(a, b) if x != y]
        if diffs:
            status, detail = "values", f"{len(diffs)} diffs, first: {diffs[0]}"
    return dict(name=name, status=status, rows=len(s_rows), spark_s=round(t1 - t0, 2), detail=detail)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from daybook.session import local_session
    import __spark_entry__ as E

    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as ex:  # report and continue
            r = dict(name=name, status="error", detail=str(ex).splitlines()[0][:300])
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
