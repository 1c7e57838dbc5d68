"""Compare every registered query with its SQL twin: ``python tests/compare.py <folder> [names]``."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(os.listdir(folder)):
        name = f.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{f}'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def as_bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns and the same bag of rows."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = as_bag(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    found = as_bag(df.columns, df.collect())
    if found == expected:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"{sum(found.values())} rows vs {sum(expected.values())}; "
        f"extra {list(extra)[:2]}; missing {list(missing)[:2]}"
    )


def main() -> int:
    import __spark_entry__ as entry
    from ledgerloom.session import build_session

    folder, only = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare",
        spark__master="local[8]",
        spark__sql__shuffle__partitions=os.environ.get("COMPARE_PARTITIONS", "8"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = duck(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        problem = differences(query(spark, folder), con, sqls[name])
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}",
              flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
