"""Run registered queries in Spark and their oracle SQL in DuckDB and
compare row count, column names and order-insensitive values.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    info = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
            "cols_match": sorted(s_cols) == sorted(d_cols), "spark_s": round(t1 - t0, 2),
            "duck_s": round(t2 - t1, 2)}
    if info["cols_match"]:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        info["values_match"] = a == b
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            info["first_diffs"] = diff
    else:
        info["values_match"] = False
        info["spark_cols"], info["duck_cols"] = s_cols, d_cols
    return info


def main(argv):
    from bench import local_session
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            print({"name": n, "oracle": "none"})
            continue
        try:
            info = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # report and continue
            info = {"name": n, "error": repr(e)[:600]}
        ok = info.get("values_match") and info.get("spark_rows") == info.get("duck_rows")
        bad += not ok
        print(("OK  " if ok else "BAD ") + repr(info), flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
