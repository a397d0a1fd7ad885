"""Row filters. Day and month filters become plain ranges, which reach Parquet statistics and partitions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherlake.functions.calendar import as_date, days_back, month_bounds
from weatherlake.functions.sky import condition


def in_days(df: DataFrame, column: str, first: date | None, last: date | None) -> DataFrame:
    """Rows whose date or timestamp column falls on one of the days first..last; None leaves an end open."""
    if first is not None:
        df = df.where(F.col(column) >= _midnight(df, column, first))
    if last is not None:
        df = df.where(F.col(column) < _midnight(df, column, last + timedelta(days=1)))
    return df


def _midnight(df: DataFrame, column: str, day: date) -> Column:
    # A literal of the column's own type: a cast on the column would keep the filter out of the scan.
    text = datetime.combine(day, time()).isoformat(sep=" ")
    return F.lit(text).cast(df.schema[column].dataType)


def last_n_days(df: DataFrame, column: str, end: str | date, days: int = 7) -> DataFrame:
    """Rows from `days` days before `end` up to and with `end`, so days + 1 dates."""
    return in_days(df, column, *days_back(as_date(end), days))


def in_month(df: DataFrame, column: str, month: str) -> DataFrame:
    return in_days(df, column, *month_bounds(month))


def in_cities(df: DataFrame, cities: Sequence[str]) -> DataFrame:
    return df.where(F.col("city").isin(*cities))


def with_current(messages: DataFrame) -> DataFrame:
    """City messages only: statistics messages on the same topic carry no current weather."""
    return messages.where(F.col("current_weather").isNotNull())


def with_hourly(payloads: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Payloads that have every one of the hourly arrays."""
    for field in fields:
        payloads = payloads.where(F.col(f"hourly.{field}").isNotNull())
    return payloads


def recent(
    df: DataFrame, column: str, hours: int, cities: Sequence[str], as_of: str | datetime | None = None
) -> DataFrame:
    """Rows of the given cities in the last `hours` hours up to `as_of`.

    Without `as_of` the newest timestamp counts. It is looked up first, as one value, so that the
    filter is a literal that reaches the scan.
    """
    if as_of is None:
        as_of = df.agg(F.max(column).cast("string")).first()[0]
        if as_of is None:
            return df.where(F.lit(False))
    kind = df.schema[column].dataType
    last = F.lit(str(as_of)).cast(kind)
    first = F.lit(str(as_of)).cast(kind) - F.make_dt_interval(hours=F.lit(hours))
    return in_cities(df, cities).where((F.col(column) > first) & (F.col(column) <= last))


def retain(df: DataFrame, column: str, as_of: str | date, days: int) -> DataFrame:
    """Drops the rows older than `days` days before `as_of`."""
    first, _ = days_back(as_date(as_of), days)
    return in_days(df, column, first, None)


def erase(df: DataFrame, erased: DataFrame, key: str) -> DataFrame:
    """Drops the rows of the listed identifiers. Rows without an identifier stay.

    The list is not forced into a broadcast: Spark broadcasts it if it is small enough, otherwise it
    sorts and merges and AQE splits the partition of a hot identifier. It is not made distinct first:
    repeats do no harm to an anti join, and an aggregate on its side would keep AQE from splitting.
    """
    return df.join(erased.select(key), key, "left_anti")


@dataclass(frozen=True)
class FilterSpec:
    """What a user may filter on; None leaves a field out."""

    min_temperature: float | None = None
    max_temperature: float | None = None
    start: str | date | None = None
    end: str | date | None = None
    cities: Sequence[str] | None = None
    regions: Sequence[str] | None = None
    conditions: Sequence[str] | None = None


def apply_filters(df: DataFrame, spec: FilterSpec, day: str = "obs_date") -> DataFrame:
    if spec.min_temperature is not None:
        df = df.where(F.col("temperature") >= spec.min_temperature)
    if spec.max_temperature is not None:
        df = df.where(F.col("temperature") <= spec.max_temperature)
    first = None if spec.start is None else as_date(spec.start)
    last = None if spec.end is None else as_date(spec.end)
    df = in_days(df, day, first, last)
    if spec.cities is not None:
        df = in_cities(df, spec.cities)
    if spec.regions is not None:
        df = df.where(F.col("region").isin(*spec.regions))
    if spec.conditions is not None:
        df = df.where(condition(F.col("weathercode")).isin(*spec.conditions))
    return df


def order_rows(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Sorts rows by the keys, with very many rows of equal keys spread over several tasks.

    Spark sorts by ranges of the keys and cannot split rows that are equal in them. A hash of the row
    tells equal keys apart, and the partition a row comes from tells copies apart.
    """
    hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return df.orderBy(*keys, F.xxhash64(*hashed), F.spark_partition_id())


def sort_by(df: DataFrame, order: Sequence[tuple[str, str]]) -> DataFrame:
    """Sorts by any columns, each with "asc" or "desc"."""
    keys = []
    for name, direction in order:
        if name not in df.columns:
            raise ValueError(f"no column {name!r}; there are {', '.join(df.columns)}")
        if direction not in ("asc", "desc"):
            raise ValueError(f"direction must be asc or desc, not {direction!r}")
        keys.append(F.col(name).desc() if direction == "desc" else F.col(name).asc())
    return order_rows(df, *keys)
