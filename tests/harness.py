"""Spark-vs-DuckDB comparison used by the tests and by ``python -m tests.harness``.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of values (floats rounded to 6 decimals, dates as ISO text).
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_names = sdf.columns
    t1 = time.time()
    cur = con.execute(sql)
    d_names = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    t2 = time.time()
    res = {"name": name, "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2),
           "rows": (len(s_rows), len(d_rows))}
    if sorted(s_names) != sorted(d_names):
        res["ok"] = False
        res["why"] = f"columns differ: {sorted(s_names)} vs {sorted(d_names)}"
        return res
    a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
    if a == b:
        res["ok"] = True
        return res
    res["ok"] = False
    diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
    res["why"] = f"values differ, first: {diffs}" if len(a) == len(b) else "row count differs"
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tempolith.session import get_spark
    sf_dir = "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROWS  {name}: {n} rows ({time.time() - t0:.1f}s, no oracle)")
            continue
        try:
            r = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        tag = "OK  " if r["ok"] else "FAIL"
        print(f"{tag}  {name}: {r.get('rows')} {r.get('spark_s')}s/{r.get('duck_s')}s {r.get('why', '')}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
