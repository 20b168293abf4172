"""Run registered queries and their SQL side by side: ``python -m checks.compare FOLDER [QUERY ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

from opsmart.session import local_session

from .oracle import ORACLE
from .queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def ordered(columns: list[str], rows: list) -> list[tuple]:
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in places) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark_columns, spark_rows, sql_columns, sql_rows) -> list[str]:
    """Empty when names, row count and all values agree."""
    if sorted(spark_columns) != sorted(sql_columns):
        return [f"columns only in Spark {set(spark_columns) - set(sql_columns)}, only in SQL {set(sql_columns) - set(spark_columns)}"]
    if len(spark_rows) != len(sql_rows):
        return [f"rows {len(spark_rows)} in Spark, {len(sql_rows)} in SQL"]
    ours, theirs = ordered(spark_columns, spark_rows), ordered(sql_columns, sql_rows)
    names = sorted(spark_columns)
    found = []
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            found.append(str({n: (x, y) for n, x, y in zip(names, a, b) if x != y or type(x) is not type(y)}))
    return found


def main(folder: str, names: list[str]) -> int:
    spark = local_session()
    con = database(folder)
    bad = 0
    for name in [q for q in QUERIES if not names or any(q.startswith(n) for n in names)]:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            rows = df.collect()
            middle = time.time()
            cursor = con.execute(ORACLE[name])
            columns = [c[0] for c in cursor.description]
            diff = differences(df.columns, rows, columns, cursor.fetchall())
        except Exception as error:  # report and go on with the next query
            diff, middle, rows = [f"error {str(error)[:1500]}"], time.time(), []
        bad += bool(diff)
        print(f"{'ok  ' if not diff else 'DIFF'} {name:28s} {len(rows):7d} rows  spark {middle - start:6.2f}s  sql {time.time() - middle:6.2f}s", flush=True)
        for line in diff[:3]:
            print("      ", line[:700], f"({len(diff)} rows differ)" if len(diff) > 1 else "", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
