"""Compare registered queries with their SQL on the same tables: python -m tests.oracle_check [folder] [names...]"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def oracle_rows(folder: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())


def compare(spark, folder: str, name: str) -> str:
    began = time.time()
    columns, got = spark_rows(entry.queries()[name](spark, folder))
    took = time.time() - began
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"ROWS  {name} {len(got)} rows {took:.1f}s"
    wanted_columns, wanted = oracle_rows(folder, sql)
    if columns != wanted_columns:
        return f"FAIL  {name} columns {columns} != {wanted_columns}"
    if got != wanted:
        extra = [r for r in got if r not in set(wanted)][:2]
        missing = [r for r in wanted if r not in set(got)][:2]
        return f"FAIL  {name} {len(got)} vs {len(wanted)} rows\n   spark only {extra}\n   sql only   {missing}"
    return f"OK    {name} {len(got)} rows {took:.1f}s"


def main() -> None:
    from tidewire.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session("8")
    for name in names:
        try:
            print(compare(spark, folder, name), flush=True)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            print(f"ERROR {name} {type(error).__name__}: {str(error)[:600]}", flush=True)


if __name__ == "__main__":
    main()
