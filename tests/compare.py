"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

Usage: python tests/compare.py [sf] [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v: object) -> object:
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def normalized(rows: list, names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, fn, sql: str | None, sf_dir: str) -> tuple[int, str | None]:
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return len(rows), None
    got = normalized(rows, df.columns)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = normalized(cur.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return len(rows), f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return len(rows), f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return len(rows), f"{g} != {w}"
    return len(rows), None


def main() -> None:
    import __spark_entry__ as e
    from millrace.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    prefixes = tuple(sys.argv[2:])
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = e.oracle_sql()
    for name, fn in e.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            n, diff = differences(spark, con, fn, oracles.get(name), sf_dir)
        except Exception as ex:  # report and go on
            n, diff = -1, f"{type(ex).__name__}: {str(ex)[:600]}"
        state = "ok" if diff is None else "DIFF"
        if diff is None and name not in oracles:
            state = "rows-only"
        print(f"@@ {name:36s} {state:9s} {n:7d} {time.time() - start:6.2f}s {(diff or '')[:700]}", flush=True)


if __name__ == "__main__":
    main()
