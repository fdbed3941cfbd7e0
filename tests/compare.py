"""Run registered queries and their SQL side by side; also usable as a script:

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET enable_progress_bar = false")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _canon(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


# Operators that must not occur in a plan: all pairs, or rows through Python.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "ExistingRDD")


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, int, float]:
    """("ok" or what differs, rows, seconds)."""
    begin = time.time()
    df = contract.queries()[name](spark, sf_dir)
    got = df.collect()
    took = time.time() - begin
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [u for u in UNWANTED if u in plan]
    if found:
        return f"plan has {found}", len(got), took
    res = con.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in res.description]
    want = res.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}", len(got), took
    a, b = _canon(df.columns, got), _canon(columns, want)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}", len(got), took
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0]}", len(got), took
    if any(type(u) is not type(v) for x, y in zip(a[:50], b[:50]) for u, v in zip(x, y)):
        return "types differ", len(got), took
    return "ok", len(got), took


if __name__ == "__main__":
    from rosterline.session import local_session

    where = sys.argv[1]
    session, db = local_session(8), connect(where)
    for query in sys.argv[2:] or contract.queries():
        try:
            state, rows, took = compare(session, db, query, where)
        except Exception as error:
            state, rows, took = f"ERROR {type(error).__name__}: {str(error)[:600]}", 0, 0.0
        print(f"{query:26s} {rows:8d} {took:6.2f}s {state[:700]}", flush=True)
