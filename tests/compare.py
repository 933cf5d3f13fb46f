"""Run registered queries next to their SQL on an independent engine.

    python -m tests.compare [key ...]        (sf from $CHECK_SF_DIR)
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from decimal import Decimal

import duckdb

from tallymark.sources.tables import TABLES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


def reference_connection(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    if isinstance(value, int):
        return value
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value if isinstance(value, str) else str(value)


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    body = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(body, key=repr)


def differences(spark, connection, fn, sql, sf_dir: str = SF_DIR) -> tuple[str | None, int]:
    """None when both results are equal, else what differs; and the row count."""
    frame = fn(spark, sf_dir)
    names, rows = table_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return None, len(rows)
    result = connection.execute(sql)
    expected_names = [d[0] for d in result.description]
    expected_names, expected = table_of(expected_names, result.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}", len(rows)
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}", len(rows)
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
    return (f"{len(wrong)} rows differ, e.g. {wrong[:3]}" if wrong else None), len(rows)


def main(keys: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tallymark.session import local_session

    spark, connection = local_session(8), reference_connection()
    all_queries, sql = queries(), oracle_sql()
    chosen = [k for k in all_queries if not keys or any(k.startswith(p) for p in keys)]
    bad = 0
    for key in chosen:
        start = time.time()
        try:
            problem, n = differences(spark, connection, all_queries[key], sql.get(key))
        except Exception as error:  # a report, not a test: go on with the next key
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", 0
        kind = "ok" if key in sql else "rows only"
        note = "  <-- EMPTY" if n == 0 and problem is None else ""
        print(f"{'FAIL' if problem else kind:9} {key:42} {n:7} rows {time.time() - start:6.1f}s{note}", flush=True)
        if problem:
            bad += 1
            print("   ", problem, flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
