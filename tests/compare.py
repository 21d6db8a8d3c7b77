"""Run queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


# DuckDB type of each Spark type in results.
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE",
}


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def canonical(columns: list[str], rows) -> list[tuple]:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in at) for r in rows),
        key=lambda t: tuple((v is None, str(type(v)), str(v)) for v in t),
    )


def compare(spark, con, name, fn, sql, sf_dir) -> dict:
    start = time.time()
    df = fn(spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    out = {"query": name, "rows": len(got), "sec": round(time.time() - start, 2)}
    if sql is None:
        return out | {"ok": None}
    start = time.time()
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = canonical(columns, cur.fetchall())
    out["sql_sec"] = round(time.time() - start, 2)
    if sorted(columns) != sorted(df.columns):
        return out | {"ok": False, "why": f"columns {sorted(df.columns)} != {sorted(columns)}"}
    sql_types = {d[0]: str(d[1]) for d in cur.description}
    differ = {
        c: (t, sql_types[c]) for c, t in df.dtypes if TYPES.get(t) != sql_types[c]
    }
    if differ:
        return out | {"ok": False, "why": f"types {differ}"}
    if got != want:
        extra = [r for r in got if r not in set(want)][:2] if len(got) < 200000 else []
        missing = [r for r in want if r not in set(got)][:2] if len(got) < 200000 else []
        return out | {"ok": False, "why": f"rows {len(got)} != {len(want)}: extra {extra} missing {missing}"}
    return out | {"ok": True}


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from coinsieve.session import build_session

    folder = sys.argv[1]
    chosen = sys.argv[2:]
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(folder), oracle_sql()
    for name, fn in queries().items():
        if chosen and name not in chosen:
            continue
        try:
            result = compare(spark, con, name, fn, oracles.get(name), folder)
        except Exception as error:  # report and go on with the next query
            result = {"query": name, "ok": False, "why": str(error)[:600]}
        print({True: "ok  ", False: "FAIL", None: "rows"}[result["ok"]], result, flush=True)
