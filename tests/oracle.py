"""Compares registered queries with their SQL on the given tables.

``python -m tests.oracle [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

from shiplens.sources.readers import TABLES


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def kind(v) -> str:
    return type(v).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple(repr(x) for x in r)
    )


def compare(spark, folder: str, name: str, con=None):
    """None where equal, else a message; also the seconds Spark took and the row count."""
    from __spark_entry__ import oracle_sql, queries

    start = time.time()
    df = queries()[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    sql = oracle_sql().get(name)
    if sql is None:
        return None, took, len(got)
    con = con or connect(folder)
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}", took, len(got)
    a, b = rows_of(df.columns, got), rows_of(want_cols, want)
    if len(a) != len(b):
        return f"{len(a)} rows, SQL has {len(b)}", took, len(got)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0][0]} != {bad[0][1]}", took, len(got)
    for x, y in zip(a[:50], b[:50]):
        for i, (p, q) in enumerate(zip(x, y)):
            if p is not None and q is not None and kind(p) != kind(q):
                return f"type of {sorted(want_cols)[i]}: {kind(p)} != {kind(q)}", took, len(got)
    return None, took, len(got)


def main(argv):
    from shiplens.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    from __spark_entry__ import oracle_sql, queries

    names = argv[1:] or list(queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for n in names:
        try:
            message, took, rows = compare(spark, folder, n, con)
        except Exception as e:  # noqa: BLE001
            message, took, rows = f"{type(e).__name__}: {str(e)[:700]}", 0.0, -1
        how = "sql" if n in oracle_sql() else "rows"
        print(f"{'ok  ' if message is None else 'FAIL'} {n:32s} {how:4s} {rows:8d} rows {took:6.2f}s {message or ''}", flush=True)
        failed += message is not None
    print(f"{failed} of {len(names)} failed")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
