"""Comparison of a query's rows with DuckDB's, over the same Parquet files."""

from __future__ import annotations

from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(row[name] for name in names) for row in df.collect()]
    return names, sorted(rows, key=repr)


def rows_of_duckdb(connection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    columns = [item[0] for item in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    return sorted(columns), sorted(rows, key=repr)


def difference(spark_side, duckdb_side) -> str | None:
    """None if columns, Python types and values are all equal, else what is not."""
    (spark_names, spark_rows), (duck_names, duck_rows) = spark_side, duckdb_side
    if spark_names != duck_names:
        return f"columns {spark_names} != {duck_names}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows != {len(duck_rows)} rows; {spark_rows[:1]} {duck_rows[:1]}"
    for left, right in zip(spark_rows, duck_rows):
        if repr(left) != repr(right):
            return f"{spark_names}\n{left}\n{right}"
    return None
