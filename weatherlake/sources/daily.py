"""Daily and monthly results as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherlake import schemas
from weatherlake.operators.filters import in_month
from weatherlake.sources.raw import or_empty

# Name pattern of the folder of one day's results.
DAY_FOLDER = r"daily_(\d{8})/"


def write_daily(df: DataFrame, path: str, day: str = "obs_date") -> None:
    """Writes Parquet with a folder per day; days that are not in `df` stay as they are.

    The rebalance hint lets AQE gather each day in few files and split a day that is too large for one.
    """
    (
        df.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def read_daily(spark: SparkSession, path: str, month: str | None = None, schema: str = schemas.DAILY_CITY_STATS) -> DataFrame:
    """Day folders of a month (or all). Only the folders of that month are listed as input."""
    df = or_empty(lambda: spark.read.schema(schema).parquet(path), spark, schema)
    return df if month is None else in_month(df, "obs_date", month)


def read_day_folders(spark: SparkSession, path: str, month: str, table: str = "city_stats") -> DataFrame:
    """Results kept as daily_YYYYMMDD/<table>, for all days of a month that exist."""
    digits = month.replace("-", "")

    def read() -> DataFrame:
        df = spark.read.schema(schemas.CITY_STATS).parquet(f"{path}/daily_{digits}[0-3][0-9]/{table}")
        day = F.regexp_extract(F.col("_metadata.file_path"), DAY_FOLDER, 1)
        return df.withColumn("obs_date", F.to_date(day, "yyyyMMdd"))

    return or_empty(read, spark, schemas.DAILY_CITY_STATS)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Null fields are written too, so every line has the same keys."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_text(lines: DataFrame, path: str, column: str) -> None:
    """Writes one text column, in the order of the frame over the numbered files."""
    lines.select(column).write.mode("overwrite").text(path)
