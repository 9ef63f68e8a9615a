"""Runs queries next to their SQL and reports differences: python -m tests.parity [sf] [names...]"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return con


def _cell(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, Decimal):
        return f"DECIMAL {value}"
    return f"{type(value).__name__} {value}"


def differences(spark, folder: str, fn, sql: str, con: duckdb.DuckDBPyConnection) -> tuple[int, list[str]]:
    df = fn(spark, folder)
    names = sorted(df.columns)
    ours = sorted(tuple(_cell(r[c]) for c in names) for r in df.collect())
    rel = con.execute(sql)
    theirs_names = [d[0] for d in rel.description]
    if sorted(theirs_names) != names:
        return len(ours), [f"columns {names} vs {sorted(theirs_names)}"]
    order = [theirs_names.index(c) for c in names]
    theirs = sorted(tuple(_cell(row[i]) for i in order) for row in rel.fetchall())
    problems = []
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows vs {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(c, x, y) for c, x, y in zip(names, a, b) if x != y]
        problems.append(f"{len(wrong)} rows differ, first {cells[:3]}")
    return len(ours), problems


def main() -> int:
    from fleetlens.catalog import all_queries, all_sql
    from fleetlens.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = str(TESTDATA / f"sf{sf}")
    chosen = sys.argv[2:] or list(all_queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), all_sql(), 0
    for name in chosen:
        start = time.time()
        try:
            if name in sqls:
                rows, problems = differences(spark, folder, all_queries()[name], sqls[name], con)
            else:
                rows, problems = len(all_queries()[name](spark, folder).collect()), []
        except Exception as error:  # report and go on with the next query
            rows, problems = -1, [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:28s} {rows:8d} rows {time.time() - start:6.2f}s {problems or ''}", flush=True)
        spark.catalog.clearCache()
    print(f"{len(chosen) - bad} of {len(chosen)} agree", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
