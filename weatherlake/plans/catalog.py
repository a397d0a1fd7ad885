"""Named queries over the given tables, and the SQL that gives the same rows in DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under a name, with its SQL if there is one."""

    def add(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def plain(df: DataFrame) -> DataFrame:
    """Days and times as ISO text and nested values as JSON: the same types and text in any engine."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampNTZType | T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.StructType | T.ArrayType | T.MapType):
            column = F.to_json(column, {"ignoreNullFields": "false"})
        columns.append(column.alias(field.name))
    return df.select(*columns)


def day(column: str, name: str | None = None) -> str:
    """SQL for a day as `plain` writes it."""
    return f"CAST({column} AS VARCHAR) AS {name or column}"


def stamp(column: str, name: str | None = None) -> str:
    """SQL for a time as `plain` writes it."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name or column}"
