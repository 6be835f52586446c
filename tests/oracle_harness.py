"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Compares row count, column names and the multiset of rows (exact values), the
way the driver's correctness gate does. Usable as a script:
``python tests/oracle_harness.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from gpsweave.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    t2 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    res["cols_ok"] = sorted(s_cols) == sorted(d_cols)
    if not res["cols_ok"]:
        res["cols"] = (sorted(s_cols), sorted(d_cols))
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    res["values_ok"] = res["cols_ok"] and a == b
    if res["cols_ok"] and not res["values_ok"]:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["only_spark"], res["only_duck"] = diff_a, diff_b
    return res


def main(argv):
    from gpsweave.session import build_session
    import __spark_entry__ as E
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, ors = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        if n not in ors:
            df = qs[n](spark, sf_dir)
            print(f"{n}: rows-only {df.count()}")
            continue
        r = compare(spark, con, n, qs[n], ors[n], sf_dir)
        ok = r["values_ok"] and r["spark_rows"] == r["duck_rows"]
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
