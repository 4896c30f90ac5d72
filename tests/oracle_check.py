"""Side-by-side check of ``queries()`` against ``oracle_sql()`` on DuckDB.

Compares row count, column names and an order-insensitive hash of the values (floats rounded
to 6 places, timestamps as ISO text). Usable from pytest and as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, int):
        return v
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def check(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E
    con = con or duck(sf_dir)
    t0 = time.time()
    df = E.queries()[name](spark, sf_dir)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    sql = E.oracle_sql().get(name)
    if sql is None:
        res["oracle"] = "none"
        return res
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    res.update(oracle_rows=len(orows), cols_match=sorted(cols) == sorted(ocols),
               rows_match=len(orows) == len(srows))
    res["hash_match"] = res["cols_match"] and digest(cols, srows) == digest(ocols, orows)
    if not res["cols_match"]:
        res["cols"] = (sorted(cols), sorted(ocols))
    return res


if __name__ == "__main__":
    from listinglake.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    import __spark_entry__ as E
    names = sys.argv[2:] or list(E.queries())
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = check(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:600]}"}
        ok = r.get("hash_match", r.get("oracle") == "none")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + repr(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
