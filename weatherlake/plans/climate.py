"""Queries by region, season and condition over several years."""

from __future__ import annotations

from weatherlake.operators import filters, lookup, stats
from weatherlake.plans.bindings import CLIMATE, climate_obs, stations
from weatherlake.plans.catalog import day, query

FIGURES = """avg(temperature) AS avg_temperature, min(temperature) AS min_temperature,
  max(temperature) AS max_temperature, sum(precipitation) AS total_precipitation, count(*) AS observations"""


def _stats(spark, sf_dir, *by):
    return stats.climate_stats(climate_obs(spark, sf_dir), stations(spark, sf_dir), *by)


@query("stats_by_region", f"WITH {CLIMATE} SELECT region, {FIGURES} FROM placed GROUP BY region")
def stats_by_region(spark, sf_dir):
    return _stats(spark, sf_dir, "region")


@query("stats_by_season", f"WITH {CLIMATE} SELECT season, {FIGURES} FROM climate GROUP BY season")
def stats_by_season(spark, sf_dir):
    return _stats(spark, sf_dir, "season")


@query("stats_by_condition", f"WITH {CLIMATE} SELECT condition, {FIGURES} FROM climate GROUP BY condition")
def stats_by_condition(spark, sf_dir):
    return _stats(spark, sf_dir, "condition")


@query("stats_by_dimension", f"""WITH {CLIMATE}
SELECT 'region' AS dimension, region AS member, {FIGURES} FROM placed GROUP BY region UNION ALL
SELECT 'season' AS dimension, season AS member, {FIGURES} FROM placed GROUP BY season UNION ALL
SELECT 'condition' AS dimension, condition AS member, {FIGURES} FROM placed GROUP BY condition""")
def stats_by_dimension(spark, sf_dir):
    return stats.climate_stats_sets(
        climate_obs(spark, sf_dir), stations(spark, sf_dir), ["region", "season", "condition"]
    )


@query("region_analysis", f"""WITH {CLIMATE} SELECT region, season, {FIGURES} FROM placed
WHERE region = 'EUROPE' GROUP BY region, season""")
def region_analysis(spark, sf_dir):
    europe = stations(spark, sf_dir).where("region = 'EUROPE'")
    return stats.climate_stats(climate_obs(spark, sf_dir), europe, "region", "season")


@query("temperature_trend", f"""WITH {CLIMATE}, daily AS (
  SELECT region, obs_date, avg(temperature) AS mean FROM placed GROUP BY region, obs_date)
SELECT region, round(regr_slope(mean, CAST(date_diff('day', DATE '1995-01-01', obs_date) AS DOUBLE)), 9) AS degrees_per_day,
  count(*) AS days FROM daily GROUP BY region""")
def temperature_trend(spark, sf_dir):
    return stats.temperature_trend(climate_obs(spark, sf_dir), stations(spark, sf_dir), "1995-01-01", 9)


@query("historical_comparison", f"""WITH {CLIMATE}, monthly AS (
  SELECT city, CAST(year(obs_date) AS INTEGER) AS year, CAST(month(obs_date) AS INTEGER) AS month,
    avg(temperature) AS mean FROM placed GROUP BY ALL)
SELECT c.city, c.year, c.month, c.mean AS current_value, p.mean AS previous_value, c.mean - p.mean AS change
FROM monthly c LEFT JOIN monthly p ON p.city = c.city AND p.month = c.month AND p.year = c.year - 1""")
def historical_comparison(spark, sf_dir):
    monthly = _stats(spark, sf_dir, "city", "year", "month")
    return lookup.historical_comparison(monthly, "city", "avg_temperature")


@query("user_filter", f"""WITH {CLIMATE} SELECT station, city, region, {day('obs_date')}, temperature, weathercode
FROM placed WHERE temperature BETWEEN 0 AND 30 AND obs_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
  AND region IN ('EUROPE', 'ASIA') AND condition IN ('rain', 'fog')""")
def user_filter(spark, sf_dir):
    spec = filters.FilterSpec(
        min_temperature=0.0, max_temperature=30.0, start="1996-01-01", end="1998-12-31",
        regions=["EUROPE", "ASIA"], conditions=["rain", "fog"],
    )
    placed = climate_obs(spark, sf_dir).join(stations(spark, sf_dir), "station")
    rows = filters.apply_filters(placed, spec, day="ts")
    return rows.select("station", "city", "region", "obs_date", "temperature", "weathercode")
