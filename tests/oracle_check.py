"""Run every registered query in Spark and its oracle SQL in DuckDB on the
same parquet tables, and compare rows (order-insensitive, doubles rounded).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tablewright.session import build_session  # noqa: E402
from tablewright.workloads import TABLES  # noqa: E402


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    dt = time.time() - t0
    if sql is None:
        return dict(name=name, ok=None, rows=len(rows), sec=round(dt, 2))
    o = con.execute(sql)
    ocols = [d[0] for d in o.description]
    orows = o.fetchall()
    oidx = {c: i for i, c in enumerate(ocols)}
    if sorted(ocols) != cols:
        return dict(name=name, ok=False, why=f"columns {cols} vs {sorted(ocols)}", sec=round(dt, 2))
    orows = [tuple(_norm(r[oidx[c]]) for c in cols) for r in orows]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a, b = sorted(rows, key=key), sorted(orows, key=key)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return dict(name=name, ok=False, why=f"rows {len(a)} vs {len(b)}; first diffs {diff}", sec=round(dt, 2))
    return dict(name=name, ok=True, rows=len(a), sec=round(dt, 2))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session(shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            res = compare(spark, con, sf_dir, name, fn, sqls.get(name))
        except Exception as e:  # report and continue
            res = dict(name=name, ok=False, why=f"{type(e).__name__}: {str(e)[:600]}")
        bad += res.get("ok") is False
        print(res, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
