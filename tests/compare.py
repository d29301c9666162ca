"""Run the catalog against its SQL: ``python tests/compare.py [folder] [query ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{folder}/{name}.parquet"):
            connection.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _value(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9) + 0.0
    return x.isoformat() if isinstance(x, (datetime.datetime, datetime.date)) else x


def rows_of_sql(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(
        tuple(_value(row[i]) for i in order) for row in cursor.fetchall())


def rows_of_spark(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_value(row[n]) for n in names) for row in df.collect())


def difference(df, connection, sql: str) -> str:
    """Empty if both give the same rows, else what differs."""
    names, ours = rows_of_spark(df)
    theirs_names, theirs = rows_of_sql(connection, sql)
    if names != theirs_names:
        return f"columns {names} != {theirs_names}"
    if ours != theirs:
        return (f"{sum(ours.values())} rows, expected {sum(theirs.values())}; "
                f"only here {list((ours - theirs).items())[:2]}; "
                f"only there {list((theirs - ours).items())[:2]}")
    return ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tidewatch.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("OFF")
    database = connect(folder)
    statements = entry.oracle_sql()
    for name, function in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        begin = time.time()
        try:
            found = difference(function(session, folder), database, statements[name])
        except Exception as error:  # a report of all queries is wanted, not the first failure
            found = f"{type(error).__name__}: {str(error)[:800]}"
        print(f"{name:26s} {time.time() - begin:6.1f}s {found or 'same'}", flush=True)
