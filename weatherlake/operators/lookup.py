"""Lookups against dimension tables, top-k semi joins and the comparison with history."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weatherlake import schemas
from weatherlake.operators.filters import order_rows
from weatherlake.session import literal_frame

# The two lists of cities with their coordinates.
WORLD_CITIES = [
    ("Paris", 48.85, 2.35),
    ("New York", 40.71, -74.01),
    ("Tokyo", 35.69, 139.69),
    ("Sydney", -33.87, 151.21),
    ("Nairobi", -1.29, 36.82),
]
MONITORED_CITIES = [
    ("Paris", 48.8566, 2.3522),
    ("Lyon", 45.7640, 4.8357),
    ("Marseille", 43.2965, 5.3698),
    ("Bordeaux", 44.8378, -0.5792),
    ("Lille", 50.6292, 3.0573),
    ("Strasbourg", 48.5734, 7.7521),
]


def city_frame(spark: SparkSession, cities: Iterable[tuple[str, float, float]]) -> DataFrame:
    return literal_frame(spark, list(cities), schemas.CITY)


def city_lookup(df: DataFrame, cities: DataFrame, how: str = "inner") -> DataFrame:
    """Adds latitude and longitude; rows of an unknown city are dropped (or kept, with how="left").

    No hint: a literal city list has an exact size, so Spark broadcasts it; a table of cities is
    broadcast only if its size is below the session's threshold.
    """
    return df.join(cities, "city", how)


def city_unmatched(df: DataFrame, cities: DataFrame) -> DataFrame:
    """The cities that have no coordinates, once each."""
    return df.select("city").distinct().join(cities, "city", "left_anti")


def top_cities(df: DataFrame, measure: Column, k: int) -> DataFrame:
    """The k cities with the largest aggregate, ties by name: city, measure."""
    ranked = df.where(F.col("city").isNotNull()).groupBy("city").agg(measure.alias("measure"))
    return ranked.orderBy(F.desc("measure"), "city").limit(k)


def series_of_top(df: DataFrame, measure: Column, k: int, ts: str = "ts") -> DataFrame:
    """The rows of the top k cities in time order. Spark knows that the limited side has k rows at most."""
    top = top_cities(df, measure, k).select("city")
    return order_rows(df.join(top, "city", "left_semi"), "city", ts)


def historical_comparison(monthly: DataFrame, key: str, value: str) -> DataFrame:
    """Each month beside the same month of the year before; null if there is none.

    `monthly` has one row per key, year and month.
    """
    same_month = Window.partitionBy(key, "month").orderBy("year").rangeBetween(-1, -1)
    rows = monthly.select(key, "year", "month", F.col(value).alias("current_value"))
    compared = rows.withColumn("previous_value", F.first("current_value").over(same_month))
    return compared.withColumn("change", F.col("current_value") - F.col("previous_value"))
