"""Raw JSON snapshots: landing them, scanning them by day, and setting bad records apart.

Two layouts are read. Files dropped by a fetcher are named weather_YYYYMMDD_HHMMSS.json and hold an
array of city objects. The landed layout, written by `land_raw`, has a folder per ingest date, so a
range of days is a partition filter.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weatherlake import schemas
from weatherlake.functions.calendar import as_date, compact, days_back
from weatherlake.operators.filters import in_days
from weatherlake.session import literal_frame

_RAW_WITH_CORRUPT = f"{schemas.RAW}, {schemas.CORRUPT} STRING"
# Name pattern of the dropped files.
FILE_DAY = r"weather_(\d{8})_"


def _scan(df: DataFrame) -> DataFrame:
    """Keeps the text of the records that are no JSON or gave nothing at all.

    Spark marks a whole line when any field in it has the wrong type, and may read part of a line that
    ends too early. The first stays, with null for that field; the second is rejected as a whole.
    """
    fields = T.StructType.fromDDL(schemas.RAW).fieldNames()
    text = F.col(schemas.CORRUPT)
    nothing = reduce(lambda a, b: a & b, [F.col(field).isNull() for field in fields])
    # Null for what is no whole JSON, whatever its size; keys that repeat don't matter.
    no_json = F.coalesce(F.json_array_length(text), F.size(F.json_object_keys(text))).isNull()
    return df.withColumn(schemas.CORRUPT, F.when(text.isNotNull() & (nothing | no_json), text))


def or_empty(read, spark: SparkSession, schema: str) -> DataFrame:
    """The frame that `read` gives, or an empty one with the schema if there is no such path."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return literal_frame(spark, [], schema)


def read_raw(spark: SparkSession, path: str, day: str | date) -> DataFrame:
    """All snapshots of one day."""
    return read_raw_range(spark, path, day, days=0)


def read_raw_range(spark: SparkSession, path: str, end: str | date, days: int = 7) -> DataFrame:
    """All snapshots from `days` days before `end` up to `end`, with their extraction_date.

    One scan over one pattern: the folder is listed once and other days' files are not opened.
    """
    first, last = days_back(as_date(end), days)
    wanted = ",".join(compact(first + timedelta(days=i)) for i in range((last - first).days + 1))

    def read() -> DataFrame:
        df = spark.read.schema(_RAW_WITH_CORRUPT).json(f"{path}/weather_{{{wanted}}}_*.json")
        day = F.regexp_extract(F.col("_metadata.file_name"), FILE_DAY, 1)
        return _scan(df.withColumn("extraction_date", F.to_date(day, "yyyyMMdd")))

    return or_empty(read, spark, f"{_RAW_WITH_CORRUPT}, extraction_date DATE")


def land_raw(raw: DataFrame, path: str) -> None:
    """Writes snapshots as JSON, one folder per extraction_date; days that are not in `raw` stay as they are."""
    (
        raw.hint("rebalance", "extraction_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("extraction_date")
        .json(path)
    )


def read_landed(spark: SparkSession, path: str, end: str | date | None = None, days: int = 7) -> DataFrame:
    """Landed snapshots, of all days or of the days up to `end`."""
    schema = f"{_RAW_WITH_CORRUPT}, extraction_date DATE"
    df = or_empty(lambda: _scan(spark.read.schema(schema).json(path)), spark, schema)
    return df if end is None else in_days(df, "extraction_date", *days_back(as_date(end), days))


def compact_raw(raw: DataFrame, path: str) -> None:
    """Writes parsed snapshots as Parquet, one folder per extraction_date.

    The many small JSON files are parsed once; later reads are columnar and prune nested fields.
    """
    (
        raw.hint("rebalance", "extraction_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("extraction_date")
        .parquet(path)
    )


def read_compacted(spark: SparkSession, path: str, end: str | date | None = None, days: int = 7) -> DataFrame:
    """Compacted snapshots, of all days or of the days up to `end`."""
    schema = f"{_RAW_WITH_CORRUPT}, extraction_date DATE"
    df = or_empty(lambda: spark.read.schema(schema).parquet(path), spark, schema)
    return df if end is None else in_days(df, "extraction_date", *days_back(as_date(end), days))


def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records, and rejected ones with their original text.

    Telling them apart takes every field, so on JSON it costs the full parse; on compacted snapshots
    the mark is a stored column.
    """
    good = raw.where(F.col(schemas.CORRUPT).isNull()).drop(schemas.CORRUPT)
    return good, raw.where(F.col(schemas.CORRUPT).isNotNull())
