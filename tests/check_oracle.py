"""Compare registered queries with their SQL: `python tests/check_oracle.py [sf] [name ...]`."""

from __future__ import annotations

import math
import sys
import time

import duckdb

import __spark_entry__ as entry_points
from labelloom.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float)):
        return round(float(x), 9) + 0.0
    return str(x)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_cell(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, name, sf_dir):
    started = time.time()
    df = entry_points.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return f"rows-only {len(got)}", seconds, bool(got)
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    want = rel.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} vs {sorted(columns)}", seconds, False
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if a == b:
        return f"ok {len(a)}", seconds, bool(a)
    extra = [x for x in a if x not in set(b)][:3]
    lacking = [x for x in b if x not in set(a)][:3]
    return f"DIFF rows {len(a)} vs {len(b)} spark-only {extra} sql-only {lacking}", seconds, False


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(entry_points.queries())
    spark, con = local_session(8), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        try:
            message, seconds, good = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the other queries
            message, seconds, good = f"ERROR {type(error).__name__} {str(error)[:700]}", 0.0, False
        bad += not good
        print(f"{'  ' if good else '! '}{name:28s} {seconds:6.2f}s {message}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
