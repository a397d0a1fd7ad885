"""Aggregations by city, day, month, region, season and condition.

All of them are made of aggregates that combine on the map side, so a city with a third of all rows
sends one partial row per task and group into the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherlake.functions.calendar import season
from weatherlake.functions.numbers import round_half_even
from weatherlake.functions.sky import condition
from weatherlake.operators.filters import in_month


def city_stats(current: DataFrame, *by: str) -> DataFrame:
    """Temperature and wind figures per city, or per city and the further columns."""
    return current.groupBy("city", *by).agg(
        F.avg("temperature").alias("avg_temperature"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.avg("windspeed").alias("avg_windspeed"),
        F.max("windspeed").alias("max_windspeed"),
    )


def monthly_city_stats(daily: DataFrame, *by: str) -> DataFrame:
    """Month figures from day figures: the averages are means of the daily means, each day counting the same."""
    return daily.groupBy("city", *by).agg(
        F.avg("avg_temperature").alias("monthly_avg_temperature"),
        F.min("min_temperature").alias("monthly_min_temperature"),
        F.max("max_temperature").alias("monthly_max_temperature"),
        F.avg("avg_windspeed").alias("monthly_avg_windspeed"),
        F.max("max_windspeed").alias("monthly_max_windspeed"),
    )


def monthly_report(snapshots: DataFrame, month: str | None = None, digits: int = 2) -> DataFrame:
    """Month figures from snapshot figures, rounded; rows without a city are left out."""
    if month is not None:
        snapshots = in_month(snapshots, "date", month)
    measures = {
        "avg_temp": F.avg("avg_temp"),
        "min_temp": F.min("min_temp"),
        "max_temp": F.max("max_temp"),
        "avg_humidity": F.avg("avg_humidity"),
        "precipitation": F.coalesce(F.sum("precipitation"), F.lit(0.0)),
        "avg_windspeed": F.avg("avg_windspeed"),
    }
    return (
        snapshots.where(F.col("city").isNotNull())
        .groupBy("city")
        .agg(*[round_half_even(value, digits).alias(name) for name, value in measures.items()])
    )


def temperature_summary(df: DataFrame) -> DataFrame:
    """One row: mean, lowest and highest temperature, null if there is none."""
    return df.agg(
        F.avg("temperature").alias("avg_temp"),
        F.min("temperature").alias("min_temp"),
        F.max("temperature").alias("max_temp"),
    )


def ranked_by_city(df: DataFrame, measure: Column, name: str) -> DataFrame:
    """One aggregate per city, largest first, ties by name; rows without a city are left out."""
    grouped = df.where(F.col("city").isNotNull()).groupBy("city").agg(measure.alias(name))
    return grouped.orderBy(F.desc(name), "city")


def temperature_by_city(df: DataFrame) -> DataFrame:
    return ranked_by_city(df, F.avg("temperature"), "avg_temperature")


def precipitation_by_city(df: DataFrame) -> DataFrame:
    return ranked_by_city(df, F.coalesce(F.sum("precipitation"), F.lit(0.0)), "total_precipitation")


def wind_by_city(df: DataFrame, speed: str = "windspeed") -> DataFrame:
    return ranked_by_city(df, F.avg(speed), "avg_wind_speed")


def daily_temperature(df: DataFrame, day: str = "obs_date") -> DataFrame:
    return df.where(F.col("city").isNotNull()).groupBy(day, "city").agg(F.avg("temperature").alias("avg_temperature"))


def daily_precipitation(df: DataFrame, day: str = "obs_date") -> DataFrame:
    total = F.coalesce(F.sum("precipitation"), F.lit(0.0))
    return df.where(F.col("city").isNotNull()).groupBy(day, "city").agg(total.alias("total_precipitation"))


def pressure_precipitation_corr(df: DataFrame, digits: int = 6) -> DataFrame:
    """Correlation of pressure and precipitation per city."""
    return df.groupBy("city").agg(F.round(F.corr("pressure", "precipitation"), digits).alias("correlation"))


# Grouping keys of the climate statistics that are computed from a row's own columns.
DERIVED_KEYS = {
    "season": lambda: season(F.col("obs_date")),
    "condition": lambda: condition(F.col("weathercode")),
    "year": lambda: F.year("obs_date"),
    "month": lambda: F.month("obs_date"),
}


def place_partials(obs: DataFrame, stations: DataFrame, *by: str) -> DataFrame:
    """Sums, counts and extremes per grouping key, ready to be combined further.

    Keys of the station (city, region) come from `stations`, which is joined only if one of them is asked for. A
    grouping by station alone first makes a few rows of each station. With further keys, such as the day, it would
    make hardly fewer rows than there are and shuffle them all; then the observations meet the stations first, which
    a small table does without a shuffle, and are grouped once, combined on the map side.
    """
    own_names = [key for key in by if key in DERIVED_KEYS or key in obs.columns]
    own = [DERIVED_KEYS[key]().alias(key) if key in DERIVED_KEYS else F.col(key) for key in own_names]
    place = [key for key in by if key not in own_names]
    rows = obs.select(*own, "station", "temperature", "precipitation")
    if not place:
        return _partial(rows, *own_names)
    placed = stations.select("station", *place)
    if not own_names:
        return _partial(rows, "station").join(placed, "station").drop("station")
    return _partial(rows.join(placed, "station"), *by)


def _partial(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("temperature").alias("temperature_sum"),
        F.count("temperature").alias("temperature_count"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.sum("precipitation").alias("precipitation_sum"),
        F.count(F.lit(1)).alias("observations"),
    )


def climate_stats(obs: DataFrame, stations: DataFrame, *by: str) -> DataFrame:
    """Mean, lowest and highest temperature and total precipitation by region, season, condition, year ..."""
    return _combined(place_partials(obs, stations, *by).groupBy(*by))


def climate_stats_sets(obs: DataFrame, stations: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same by each of the keys on its own, in one pass: dimension, member and the figures.

    The grouping sets expand the partial rows, not the observations.
    """
    partial = place_partials(obs, stations, *keys)
    sets = [[F.col(key)] for key in keys]
    grouped = _combined(partial.groupingSets(sets, *[F.col(key) for key in keys]),
                        *[F.grouping(key).alias(f"{key}_absent") for key in keys])
    dimension, member = F, F.coalesce(*[F.col(key) for key in keys])
    for key in keys:
        dimension = dimension.when(F.col(f"{key}_absent") == 0, key)
    return grouped.select(
        dimension.alias("dimension"), member.alias("member"),
        *[c for c in grouped.columns if c not in keys and not c.endswith("_absent")],
    )


def _combined(grouped, *extra: Column) -> DataFrame:
    figures = grouped.agg(
        F.try_divide(F.sum("temperature_sum"), F.sum("temperature_count")).alias("avg_temperature"),
        F.min("min_temperature").alias("min_temperature"),
        F.max("max_temperature").alias("max_temperature"),
        F.sum("precipitation_sum").alias("total_precipitation"),
        F.sum("observations").alias("observations"),
        *extra,
    )
    return figures


def temperature_trend(obs: DataFrame, stations: DataFrame, origin: str, digits: int = 6) -> DataFrame:
    """Degrees per day and region: slope of the region's daily mean over the day number since `origin`."""
    daily = _combined(place_partials(obs, stations, "region", "obs_date").groupBy("region", "obs_date"))
    day_number = F.datediff(F.col("obs_date"), F.lit(origin).cast("date")).cast("double")
    slope = F.regr_slope(F.col("avg_temperature"), day_number)
    return daily.groupBy("region").agg(
        F.round(slope, digits).alias("degrees_per_day"), F.count(F.lit(1)).alias("days")
    )


def dataset_profile(df: DataFrame, day: str = "obs_date") -> DataFrame:
    """Rows, distinct cities and the last day of a data set."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("city").alias("n_cities"),
        F.max(day).alias("last_date"),
    )
