"""Compare registered queries with DuckDB: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
DATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def plain(value):
    """A value both engines show alike, with its kind."""
    if isinstance(value, float):
        if math.isnan(value):
            return ("float", "nan")
        return ("float", repr(value + 0.0))
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, (list, tuple)):
        return ("list", tuple(plain(v) for v in value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return ("time", value.isoformat())
    return (type(value).__name__, value)


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=repr
    )


def difference(df, sql: str, connection) -> str | None:
    """None if the Spark result and the SQL result agree, else what differs."""
    ours, got = normalized(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(sql)
    theirs, expected = normalized([d[0] for d in cursor.description], cursor.fetchall())
    if ours != theirs:
        return f"columns {ours} != {theirs}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            wrong = sum(x != y for x, y in zip(got, expected))
            return f"{wrong}/{len(got)} rows differ: {a} != {b}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    chosen = sys.argv[2:]
    spark = make_session()
    sf_dir = f"{DATA}/sf{sf}"
    connection = connect(sf_dir)
    failed = 0
    for name, run in queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        started = time.time()
        try:
            sql = oracle_sql().get(name)
            if sql is None:
                result = f"rows only: {len(run(spark, sf_dir).collect())}"
            else:
                result = difference(run(spark, sf_dir), sql, connection)
                failed += result is not None
        except Exception as error:  # show every failing query
            failed += 1
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:32} {time.time() - started:6.2f}s  {result or 'ok'}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
