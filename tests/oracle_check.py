"""Compare ``queries()`` with ``oracle_sql()`` the way the driver does:
row count, column names, and an order-insensitive multiset of values,
compared exactly (doubles are rounded inside both queries, not here).

Script use:  python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):  # exact: both sides round in the query itself
        if math.isnan(v):
            return "nan"
        return v + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], sorted(cols)


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = sdf.columns
    s_norm, s_cols = _rows(scols, srows)
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    d_norm, d_cols = _rows(dcols, drows)
    out["oracle_rows"] = len(drows)
    if s_cols != d_cols:
        out["status"] = f"COLUMNS {s_cols} vs {d_cols}"
    elif Counter(s_norm) != Counter(d_norm):
        a, b = Counter(s_norm), Counter(d_norm)
        out["status"] = "VALUES"
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_oracle"] = list((b - a).elements())[:3]
    else:
        out["status"] = "ok"
    return out


def main(argv):
    from pyspark.sql import SparkSession
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", os.environ.get("CHECK_TZ", "UTC"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, sf_dir, name, fn, sqls.get(name), con)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(qs) if not names else len(names)} checked, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
