"""Run registered queries against their check SQL: python tests/check.py [sf] [name...]"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = "/root/testdata"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, fn, sql, sf_dir) -> str:
    df = fn(spark, sf_dir)
    began = time.time()
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows-only {len(got)}"
    spark_seconds, began = time.time() - began, time.time()
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"FAIL columns {sorted(df.columns)} vs {sorted(rel.columns)}"
    if got != want:
        odd = [(a, b) for a, b in zip(got, want) if a != b][:1]
        return f"FAIL {len(got)} vs {len(want)} rows, first {odd}"
    odd_types = {"interval", "struct", "timestamp"}
    bad = [f.name for f in df.schema.fields if f.dataType.typeName() in odd_types]
    return f"ok {len(got)} (collect {spark_seconds:.2f}s, check {time.time() - began:.2f}s)" + (f" (types: {bad})" if bad else "")


def main(argv) -> int:
    from __spark_entry__ import oracle_sql, queries
    from logloom.session import local_session
    sf = argv[0] if argv else "0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, failures = duck(f"{DATA}/sf{sf}"), 0
    for name, fn in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            result = compare(spark, con, fn, oracle_sql().get(name), f"{DATA}/sf{sf}")
        except Exception as e:  # noqa: BLE001
            result = f"FAIL {type(e).__name__}: {str(e)[:400]}"
        failures += result.startswith("FAIL")
        print(f"{name:28s} {time.time() - start:6.2f}s {result}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
