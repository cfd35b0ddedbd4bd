"""Compare registered queries with their SQL twins on one folder of test tables.

Run as ``python tests/parity.py [folder] [name ...]``; tests/test_parity.py uses ``compare``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    return connection


def _normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(item):
        return round(item, 9) if isinstance(item, float) and math.isfinite(item) else item

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


def compare(df, connection, sql) -> str | None:
    """None when both sides hold the same columns and rows, else what differs."""
    result = connection.execute(sql)
    expected_columns = [column[0] for column in result.description]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    actual = _normal(df.collect(), df.columns)
    expected = _normal(result.fetchall(), expected_columns)
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for left, right in zip(actual, expected):
        if left != right or [type(x) for x in left] != [type(x) for x in right]:
            return f"{left} != {right}"
    return None


def main(folder: str, names: list[str]) -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from platewise import registry, session
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(folder)
    for name in names or registry.QUERIES:
        start = time.time()
        with session.scope(spark):
            frame = registry.QUERIES[name](spark, folder)
            if name in registry.SQL:
                outcome = compare(frame, connection, registry.SQL[name]) or "equal"
            else:
                rows = frame.collect()
                outcome = f"{len(rows)} rows, no SQL; first {rows[:1]}"
        print(f"{name:26s} {time.time() - start:7.2f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])
