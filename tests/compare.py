"""Run queries against their SQL counterparts: ``python tests/compare.py [folder] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, float) and value == 0:
        return "0.0"
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str:
    """Empty if both sides agree, otherwise what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want[0] != got[0]:
        return f"columns {got[0]} instead of {want[0]}"
    if len(want[1]) != len(got[1]):
        return f"{len(got[1])} rows instead of {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(bad)} of {len(want[1])} rows differ, e.g. {bad[0]}" if bad else ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from roadloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in sqls:
                verdict = compare(df, con, sqls[name]) or "ok"
            else:
                verdict = f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict = "FAILED " + str(error)[:600].replace("\n", " ")
        print(f"{name:34s} {time.time() - start:6.1f}s  {verdict}", flush=True)
