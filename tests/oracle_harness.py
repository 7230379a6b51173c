"""Run registered Spark queries and their DuckDB oracle side by side.

Mimics the driver's check: row count, column names, and an order-insensitive hash
of the values with columns sorted by name. Also reports an approximate match
(floats rounded) to tell float noise from real differences.

    python tests/oracle_harness.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v, approx=False):
    if v is None:
        return None
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, (int,)):
        return int(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if v != v:
            return "nan"
        return round(v, 6) if approx else float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, approx) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, approx)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), approx)
    return str(v)


def digest(cols, rows, approx=False):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    c = Counter()
    for r in rows:
        c[repr(tuple(_norm(r[i], approx) for i in order))] += 1
    h = hashlib.sha256()
    for k in sorted(c):
        h.update(("%s:%d\n" % (k, c[k])).encode())
    return h.hexdigest()[:16], c


TYPE_MAP = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
            "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "DECIMAL": "decimal", "FLOAT": "float",
            "SMALLINT": "smallint", "TINYINT": "tinyint"}


def duck_conn(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute("CREATE VIEW %s AS SELECT * FROM read_parquet('%s/%s.parquet')" % (t, sf_dir, t))
    return con


def compare(spark, con, key, fn, sql):
    t0 = time.time()
    df = fn(spark, SF)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return {"key": key, "status": "no-oracle", "rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"key": key, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = "COLS"
        out["detail"] = (sorted(s_cols), sorted(d_cols))
        return out
    duck_types = dict(zip(d_cols, [str(d[1]) for d in res.description]))
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    tmis = {c: (spark_types[c], duck_types[c]) for c in s_cols
            if TYPE_MAP.get(duck_types[c].split("(")[0], duck_types[c]) != spark_types[c].split("(")[0]}
    if tmis:
        out["types"] = tmis
    hs, cs = digest(s_cols, s_rows)
    hd, cd = digest(d_cols, d_rows)
    if hs == hd and len(s_rows) == len(d_rows):
        out["status"] = "ok"
        return out
    ha, ca = digest(s_cols, s_rows, True)
    hb, cb = digest(d_cols, d_rows, True)
    out["status"] = "approx" if ha == hb else "DIFF"
    if out["status"] == "DIFF":
        only_s = list((ca - cb).elements())[:3]
        only_d = list((cb - ca).elements())[:3]
        out["detail"] = {"cols": sorted(s_cols), "only_spark": only_s, "only_duck": only_d}
    return out


if __name__ == "__main__":
    SF = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    from tidemark.session import build_session
    import __spark_entry__ as E
    spark = build_session(master="local[8]", shuffle_partitions=8)
    qs, ors = E.queries(), E.oracle_sql()
    con = duck_conn(SF)
    bad = 0
    for k in (keys or list(qs)):
        try:
            r = compare(spark, con, k, qs[k], ors.get(k))
        except Exception as e:  # report and continue
            r = {"key": k, "status": "ERROR", "detail": repr(e)[:600]}
        if r["status"] not in ("ok", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print("BAD", bad, "OF", len(keys or qs))
