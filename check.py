"""Run registered queries against their SQL texts in DuckDB and report differences.

    python check.py [--sf DIR] [--only NAME ...] [--modules NAME ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import importlib
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(round(float(value), 9) + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def table_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


def compare(spark, connection, sf, query, sql):
    frame = query(spark, sf)
    got = table_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return f"no SQL, {len(got[1])} rows", True
    cursor = connection.execute(sql)
    want = table_of([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", False
    if got[1] == want[1]:
        return f"{len(got[1])} rows", True
    extra, lost = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
    return f"{len(got[1])}/{len(want[1])} rows; spark {sorted(extra)[:3]} sql {sorted(lost)[:3]}", False


def connect(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--only", nargs="*")
    parser.add_argument("--modules", nargs="*")
    args = parser.parse_args()
    from talweg import local_session, ship_package

    spark = local_session()
    ship_package(spark)
    if args.modules:
        modules = [importlib.import_module(f"workload.{m}") for m in args.modules]
        queries = {n: q for m in modules for n, q in m.QUERIES.items()}
        sqls = {n: s for m in modules for n, s in m.ORACLES.items()}
    else:
        import workload

        queries, sqls = workload.queries(), workload.oracle_sql()
    connection, failed = connect(args.sf), []
    for name, query in queries.items():
        if args.only and name not in args.only:
            continue
        start = time.time()
        try:
            note, good = compare(spark, connection, args.sf, query, sqls.get(name))
        except Exception as error:  # report and go on with the next query
            note, good = f"{type(error).__name__}: {str(error)[:1500]}", False
        print(f"{'ok  ' if good else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
        if not good:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
