"""Compare registered Spark queries with their DuckDB oracles.

Usable from pytest (``compare``) and as a script:
``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_canon(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries
    t0 = time.time()
    df = queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    sql = oracle_sql().get(name)
    if sql is None:
        return True, f"{name}: spark rows={len(srows)} (no oracle) {t1 - t0:.1f}s"
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    scols, s = _rows(df.columns, srows)
    dcols2, d = _rows(dcols, drows)
    if scols != dcols2:
        return False, f"{name}: columns differ spark={scols} duck={dcols2}"
    if s != d:
        diff = [(a, b) for a, b in zip(s, d) if a != b][:3]
        return False, (f"{name}: values differ rows spark={len(s)} duck={len(d)} "
                       f"first diffs={diff}")
    return True, f"{name}: OK rows={len(s)} {t1 - t0:.1f}s"


def main(argv):
    from riskview.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    from __spark_entry__ import queries
    names = argv[2:] or list(queries())
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
