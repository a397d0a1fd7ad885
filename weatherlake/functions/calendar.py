"""Dates, months, hours and seasons."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | date) -> date:
    """Accepts a date, YYYY-MM-DD or YYYYMMDD."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return datetime.strptime(value.replace("-", ""), "%Y%m%d").date()


def compact(day: date) -> str:
    return day.strftime("%Y%m%d")


def month_bounds(month: str) -> tuple[date, date]:
    """First and last day of YYYY-MM or YYYYMM."""
    digits = month.replace("-", "")
    first = date(int(digits[:4]), int(digits[4:6]), 1)
    following = (first + timedelta(days=31)).replace(day=1)
    return first, following - timedelta(days=1)


def days_back(end: date, days: int) -> tuple[date, date]:
    """Inclusive bounds: `days` days before `end`, and `end` itself."""
    return end - timedelta(days=days), end


def forecast_ts(time: Column) -> Column:
    """Timestamp of an ISO text such as 2025-09-24T09:00; null if it is none."""
    return time.try_cast("timestamp_ntz")


def hour_text(time: Column) -> Column:
    """HH:MM at the end of an ISO text."""
    return F.right(time, F.lit(5))


def date_hour(day: Column, hour: Column) -> Column:
    """Timestamp of a date and HH:MM on it; null if the hour is none. Hours of later forecast days fall on the one date."""
    return F.concat_ws(" ", day.cast("string"), hour).try_cast("timestamp_ntz")


def iso_minute(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm")


def iso_second(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def season(day: Column) -> Column:
    """Meteorological season of the northern hemisphere."""
    quarter = F.month(day) % 12
    return (
        F.when(quarter < 3, "winter").when(quarter < 6, "spring").when(quarter < 9, "summer").when(quarter < 12, "autumn")
    )
