"""Projections: flattening, exploding hourly arrays, joining the two payload dialects, pivots.

Everything but the pivots is narrow: no shuffle, and only the nested fields in use are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherlake.functions.arrays import array_mean, array_sum, non_empty, zip_shortest
from weatherlake.functions.calendar import forecast_ts, hour_text
from weatherlake.functions.text import city_or_unknown


def current_flat(raw: DataFrame) -> DataFrame:
    """The current observation of each payload as eight flat columns."""
    return raw.select("city", "latitude", "longitude", "current_weather.*")


def hourly_series(raw: DataFrame, **arrays: str) -> DataFrame:
    """One row per hourly element: city, date, hour, ts and a column per entry of `arrays` (name -> array).

    The arrays are matched by position and the shortest one ends the series. `date` is the day the
    snapshot was taken, `ts` the hour the value is for.
    """
    rows = zip_shortest(F.col("hourly.time"), **{name: F.col(f"hourly.{field}") for name, field in arrays.items()})
    exploded = raw.select(
        city_or_unknown(F.col("city")).alias("city"),
        F.col("extraction_date").alias("date"),
        F.inline(rows).alias("time", *arrays),
    )
    return exploded.select(
        "city", "date", hour_text(F.col("time")).alias("hour"), forecast_ts(F.col("time")).alias("ts"), *arrays
    )


def hourly_temperature(raw: DataFrame) -> DataFrame:
    return hourly_series(raw, temperature="temperature_2m")


def hourly_precipitation(raw: DataFrame) -> DataFrame:
    return hourly_series(raw, precipitation="precipitation")


def hourly_wind(raw: DataFrame) -> DataFrame:
    return hourly_series(raw, wind_speed="windspeed_10m", wind_direction="winddirection_10m")


def snapshot_stats(raw: DataFrame) -> DataFrame:
    """Daily figures of each payload, computed inside its row; payloads without temperatures are left out.

    One row per snapshot and city, so overlapping snapshots of a day each give a row.
    """
    temperature = F.col("hourly.temperature_2m")
    return raw.where(non_empty(temperature)).select(
        city_or_unknown(F.col("city")).alias("city"),
        F.col("extraction_date").alias("date"),
        array_mean(temperature).alias("avg_temp"),
        F.array_min(temperature).alias("min_temp"),
        F.array_max(temperature).alias("max_temp"),
        array_mean(F.col("hourly.relative_humidity_2m")).alias("avg_humidity"),
        array_sum(F.col("hourly.precipitation")).alias("precipitation"),
        array_mean(F.col("hourly.windspeed_10m")).alias("avg_windspeed"),
    )


def unify(raw: DataFrame) -> DataFrame:
    """Both payload dialects under one set of names.

    `current` and `hourly` become structs with temperature, humidity, precipitation and windspeed;
    a dialect's missing fields are null. Payloads without a timestamp take that of their current weather.
    """

    def either(first: str, second: str) -> Column:
        return F.coalesce(F.col(first), F.col(second))

    return raw.select(
        *[c for c in raw.columns if c not in ("timestamp", "current_weather", "current", "hourly")],
        F.coalesce("timestamp", "current_weather.time", "current.time").alias("timestamp"),
        F.struct(
            either("current_weather.temperature", "current.temperature_2m").alias("temperature"),
            F.col("current.relative_humidity_2m").alias("humidity"),
            F.col("current.precipitation").alias("precipitation"),
            either("current_weather.windspeed", "current.wind_speed_10m").alias("windspeed"),
            F.col("current_weather.winddirection").alias("winddirection"),
            F.col("current_weather.weathercode").alias("weathercode"),
            either("current_weather.time", "current.time").alias("time"),
        ).alias("current"),
        F.struct(
            F.col("hourly.time").alias("time"),
            F.col("hourly.temperature_2m").alias("temperature"),
            F.col("hourly.relative_humidity_2m").alias("humidity"),
            F.col("hourly.precipitation").alias("precipitation"),
            either("hourly.windspeed_10m", "hourly.wind_speed_10m").alias("windspeed"),
            F.col("hourly.winddirection_10m").alias("winddirection"),
        ).alias("hourly"),
    )


def unified_current(raw: DataFrame) -> DataFrame:
    """Current values of either dialect, flat."""
    return unify(raw).select(city_or_unknown(F.col("city")).alias("city"), "timestamp", "current.*")


def _forecast_hours(raw: DataFrame) -> DataFrame:
    """One row per hourly element of either dialect, with the instant its snapshot was taken at."""
    rows = unify(raw).select(
        city_or_unknown(F.col("city")).alias("city"),
        F.col("timestamp").try_cast("timestamp").alias("snapshot"),
        F.posexplode(
            zip_shortest(
                F.col("hourly.time"),
                temperature=F.col("hourly.temperature"),
                precipitation=F.col("hourly.precipitation"),
            )
        ).alias("pos", "element"),
    )
    return rows.select("city", "snapshot", "pos", "element.*").withColumn("ts", forecast_ts(F.col("time")))


def hourly_latest(raw: DataFrame) -> DataFrame:
    """One row per city and forecast hour, from the snapshot taken last.

    Snapshots are ordered by their instant, whatever offset their stamp has; one whose stamp cannot be read comes
    before all others. Hours whose time cannot be read have no row here; `unreadable_hours` gives them.
    Overlapping snapshots repeat an hour many times. All that the aggregate keeps has a fixed width, so it is hashed
    and combines the repeats on the map side.
    """
    hours = _forecast_hours(raw).where(F.col("ts").isNotNull())
    # Instant, place in the array and, among equals, the values: one number that orders the versions.
    instant = F.coalesce(F.unix_micros("snapshot"), F.lit(-(10**17))).cast("decimal(38,0)")
    last = (F.col("pos").cast("long") * 1_000_000_000 + F.pmod(F.xxhash64("temperature", "precipitation"), F.lit(1_000_000_000))).cast("decimal(20,0)")
    version = (instant * F.lit(10**18).cast("decimal(19,0)") + last).cast("decimal(38,0)")
    newest = [F.max_by(name, "version").alias(name) for name in ("snapshot", "temperature", "precipitation")]
    return hours.withColumn("version", version).groupBy("city", "ts").agg(*newest)


def unreadable_hours(raw: DataFrame) -> DataFrame:
    """The hourly elements whose time is missing or no time, with that text, to be set apart."""
    return _forecast_hours(raw).where(F.col("ts").isNull()).select("city", "snapshot", "pos", "time", "temperature", "precipitation")


def pivot_by_city(df: DataFrame, cities: Sequence[str], value: Column, day: str = "date") -> DataFrame:
    """One row per day and one column per city; `value` is the aggregate, such as F.avg("temperature").

    The city list is given, which saves a job to find it and fixes the schema.
    """
    return df.where(F.col("city").isNotNull()).groupBy(day).pivot("city", list(cities)).agg(value)
