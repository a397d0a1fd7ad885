"""Queries on flat observations."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherlake.functions.text import pseudonym
from weatherlake.operators import filters, lookup, stats, wind
from weatherlake.operators.reshape import pivot_by_city
from weatherlake.plans.bindings import CITIES, CITY_TABLE, CLIMATE, MONTHS, OBS, climate_obs, months, obs, table
from weatherlake.plans.catalog import day, query, stamp
from weatherlake.sources.reports import notification_text

ROW = ["event_id", "city", "ts", "temperature", "windspeed", "precipitation"]
ROW_SQL = f"event_id, city, {stamp('ts')}, temperature, windspeed, precipitation"
STATS_SQL = """avg(temperature) AS avg_temperature, min(temperature) AS min_temperature,
  max(temperature) AS max_temperature, avg(windspeed) AS avg_windspeed, max(windspeed) AS max_windspeed"""
RANGE_END, RANGE_DAYS = "2024-01-20", 7


@query("city_stats", f"WITH {OBS} SELECT city, {day('obs_date')}, {STATS_SQL} FROM obs GROUP BY city, obs_date")
def city_stats(spark, sf_dir):
    return stats.city_stats(obs(spark, sf_dir), "obs_date")


@query("monthly_city_stats", f"""WITH {MONTHS}, daily AS (
  SELECT city, obs_date, {STATS_SQL} FROM months GROUP BY city, obs_date)
SELECT city, CAST(CAST(date_trunc('month', obs_date) AS DATE) AS VARCHAR) AS month,
  round(avg(avg_temperature), 6) AS monthly_avg_temperature,
  min(min_temperature) AS monthly_min_temperature, max(max_temperature) AS monthly_max_temperature,
  round(avg(avg_windspeed), 6) AS monthly_avg_windspeed, max(max_windspeed) AS monthly_max_windspeed
FROM daily GROUP BY city, date_trunc('month', obs_date)""")
def monthly_city_stats(spark, sf_dir):
    daily = stats.city_stats(months(spark, sf_dir), "obs_date")
    monthly = stats.monthly_city_stats(daily.withColumn("month", F.trunc("obs_date", "month")), "month")
    means = ["monthly_avg_temperature", "monthly_avg_windspeed"]
    return monthly.withColumns({name: F.round(name, 6) for name in means})


@query("global_temperature", f"""WITH {OBS}
SELECT avg(temperature) AS avg_temp, min(temperature) AS min_temp, max(temperature) AS max_temp FROM obs""")
def global_temperature(spark, sf_dir):
    return stats.temperature_summary(obs(spark, sf_dir))


@query("notification_text", f"""WITH {OBS}, s AS (
  SELECT avg(temperature) AS a, min(temperature) AS b, max(temperature) AS c FROM obs)
SELECT 'Rapport météo du 30/01/2024 12:00 :' || chr(10)
  || 'Température moyenne : ' || printf('%.1f', round_even(a * 10, 0) / 10) || '°C' || chr(10)
  || 'Température minimale : ' || printf('%.1f', round_even(b * 10, 0) / 10) || '°C' || chr(10)
  || 'Température maximale : ' || printf('%.1f', round_even(c * 10, 0) / 10) || '°C' AS message FROM s""")
def notification(spark, sf_dir):
    now = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    return notification_text(stats.temperature_summary(obs(spark, sf_dir)), now)


@query("temperature_by_city", f"WITH {OBS} SELECT city, avg(temperature) AS avg_temperature FROM obs GROUP BY city")
def temperature_by_city(spark, sf_dir):
    return stats.temperature_by_city(obs(spark, sf_dir))


@query("precipitation_by_city", f"""WITH {OBS}
SELECT city, sum(precipitation) AS total_precipitation FROM obs GROUP BY city""")
def precipitation_by_city(spark, sf_dir):
    return stats.precipitation_by_city(obs(spark, sf_dir))


@query("wind_by_city", f"WITH {OBS} SELECT city, avg(windspeed) AS avg_wind_speed FROM obs GROUP BY city")
def wind_by_city(spark, sf_dir):
    return stats.wind_by_city(obs(spark, sf_dir))


@query("daily_temperature", f"""WITH {OBS}
SELECT {day('obs_date')}, city, avg(temperature) AS avg_temperature FROM obs GROUP BY obs_date, city""")
def daily_temperature(spark, sf_dir):
    return stats.daily_temperature(obs(spark, sf_dir))


@query("daily_precipitation", f"""WITH {OBS}
SELECT {day('obs_date')}, city, sum(precipitation) AS total_precipitation FROM obs GROUP BY obs_date, city""")
def daily_precipitation(spark, sf_dir):
    return stats.daily_precipitation(obs(spark, sf_dir))


def _pivot_sql(measure: str) -> str:
    columns = ", ".join(f"{measure} FILTER (WHERE city = '{city}') AS \"{city}\"" for city in CITIES)
    return f"WITH {OBS} SELECT {day('obs_date')}, {columns} FROM obs GROUP BY obs_date"


@query("pivot_temperature", _pivot_sql("avg(temperature)"))
def pivot_temperature(spark, sf_dir):
    return pivot_by_city(obs(spark, sf_dir), CITIES, F.avg("temperature"), "obs_date")


@query("pivot_precipitation", f"""WITH {OBS}, daily AS (SELECT city, obs_date, coalesce(sum(precipitation), 0) AS total
  FROM obs GROUP BY city, obs_date) SELECT {day('obs_date')},
  {", ".join(f"max(total) FILTER (WHERE city = '{city}') AS " + '"' + city + '"' for city in CITIES)} FROM daily GROUP BY obs_date""")
def pivot_precipitation(spark, sf_dir):
    """The daily totals, 0 where all values are null; null only where a city has no rows on a day."""
    daily = stats.daily_precipitation(obs(spark, sf_dir))
    return pivot_by_city(daily, CITIES, F.max("total_precipitation"), "obs_date")


@query("top_temperature_cities", f"""WITH {OBS} SELECT city, avg(temperature) AS measure FROM obs
GROUP BY city ORDER BY measure DESC, city LIMIT 3""")
def top_temperature_cities(spark, sf_dir):
    return lookup.top_cities(obs(spark, sf_dir), F.avg("temperature"), 3)


@query("top_wind_cities", f"""WITH {OBS} SELECT city, avg(windspeed) AS measure FROM obs
GROUP BY city ORDER BY measure DESC, city LIMIT 4""")
def top_wind_cities(spark, sf_dir):
    return lookup.top_cities(obs(spark, sf_dir), F.avg("windspeed"), 4)


@query("top_cities_series", f"""WITH {OBS}, top AS (
  SELECT city FROM obs GROUP BY city ORDER BY avg(temperature) DESC, city LIMIT 3)
SELECT city, {stamp('ts')}, temperature FROM obs WHERE city IN (SELECT city FROM top)""")
def top_cities_series(spark, sf_dir):
    rows = obs(spark, sf_dir).select("city", "ts", "temperature")
    return lookup.series_of_top(rows, F.avg("temperature"), 3)


_SECTORS = ("['N','NNE','NE','ENE','E','ESE','SE','SSE','S','SSW','SW','WSW','W','WNW','NW','NNW']"
            "[CAST(floor(((winddirection + 11.25) % 360) / 22.5) AS INTEGER) + 1]")


@query("wind_rose", f"""WITH {OBS}, top AS (
  SELECT city FROM obs GROUP BY city ORDER BY avg(windspeed) DESC, city LIMIT 4),
counts AS (
  SELECT city, {_SECTORS} AS sector,
    CAST(CASE WHEN windspeed < 10 THEN 0 WHEN windspeed < 20 THEN 10 WHEN windspeed < 40 THEN 20
      WHEN windspeed < 60 THEN 40 WHEN windspeed < 80 THEN 60 ELSE 80 END AS BIGINT) AS speed_from,
    count(*) AS n
  FROM obs WHERE city IN (SELECT city FROM top) GROUP BY ALL)
SELECT city, sector, speed_from, n, n / CAST(sum(n) OVER (PARTITION BY city) AS DOUBLE) AS share FROM counts""")
def wind_rose(spark, sf_dir):
    return wind.wind_rose(obs(spark, sf_dir))


@query("dominant_wind", f"""WITH {OBS}, counts AS (
  SELECT city, CAST(floor(((winddirection + 11.25) % 360) / 22.5) AS INTEGER) AS no, {_SECTORS} AS sector,
    count(*) AS n FROM obs GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY n DESC, no) AS rank,
  CAST(sum(n) OVER (PARTITION BY city) AS DOUBLE) AS total FROM counts)
SELECT city, sector, n, n / total AS share FROM ranked WHERE rank = 1""")
def dominant_wind(spark, sf_dir):
    return wind.dominant_wind(obs(spark, sf_dir))


@query("pressure_precip_corr", f"""WITH {OBS}
SELECT city, round(corr(pressure, precipitation), 6) AS correlation FROM obs GROUP BY city""")
def pressure_precip_corr(spark, sf_dir):
    return stats.pressure_precipitation_corr(obs(spark, sf_dir))


@query("dataset_profile", f"""WITH {OBS}
SELECT count(*) AS n_rows, count(DISTINCT city) AS n_cities, {day('max(obs_date)', 'last_date')} FROM obs""")
def dataset_profile(spark, sf_dir):
    return stats.dataset_profile(obs(spark, sf_dir))


@query("last_n_days", f"""WITH {OBS} SELECT {ROW_SQL} FROM obs
WHERE obs_date BETWEEN DATE '{RANGE_END}' - {RANGE_DAYS} AND DATE '{RANGE_END}'""")
def last_n_days(spark, sf_dir):
    return filters.last_n_days(obs(spark, sf_dir), "ts", RANGE_END, RANGE_DAYS).select(*ROW)


@query("month_filter", f"""WITH {CLIMATE} SELECT station, {day('obs_date')}, temperature, precipitation
FROM climate WHERE strftime(obs_date, '%Y%m') = '199705'""")
def month_filter(spark, sf_dir):
    rows = filters.in_month(climate_obs(spark, sf_dir), "ts", "1997-05")
    return rows.select("station", "obs_date", "temperature", "precipitation")


@query("city_subset", f"WITH {OBS} SELECT {ROW_SQL} FROM obs WHERE city IN ('Paris', 'Tokyo')")
def city_subset(spark, sf_dir):
    return filters.in_cities(obs(spark, sf_dir), ["Paris", "Tokyo"]).select(*ROW)


@query("recent_weather", f"""WITH {OBS} SELECT {ROW_SQL} FROM obs
WHERE city IN ('Paris', 'Nairobi') AND ts > (SELECT max(ts) FROM obs) - INTERVAL 24 HOUR""")
def recent_weather(spark, sf_dir):
    return filters.recent(obs(spark, sf_dir), "ts", 24, ["Paris", "Nairobi"]).select(*ROW)


@query("retention", f"WITH {OBS} SELECT {ROW_SQL} FROM obs WHERE obs_date >= DATE '2024-01-30' - 7")
def retention(spark, sf_dir):
    return filters.retain(obs(spark, sf_dir), "ts", "2024-01-30", 7).select(*ROW)


@query("erasure", f"""WITH {OBS} SELECT {ROW_SQL} FROM obs WHERE NOT EXISTS (
  SELECT 1 FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey = station)""")
def erasure(spark, sf_dir):
    erased = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("station"))
    return filters.erase(obs(spark, sf_dir), erased, "station").select(*ROW)


@query("user_sort", f"WITH {OBS} SELECT {ROW_SQL} FROM obs ORDER BY temperature DESC, event_id")
def user_sort(spark, sf_dir):
    return filters.sort_by(obs(spark, sf_dir).select(*ROW), [("temperature", "desc"), ("event_id", "asc")])


@query("anonymise", f"""WITH {OBS} SELECT event_id, sha256('weather' || CAST(station AS VARCHAR)) AS station,
  city, temperature FROM obs""")
def anonymise(spark, sf_dir):
    return obs(spark, sf_dir).select("event_id", pseudonym(F.col("station"), "weather").alias("station"), "city", "temperature")


@query("city_lookup", f"""WITH {OBS}, {CITY_TABLE} SELECT {ROW_SQL}, latitude, longitude
FROM obs JOIN cities USING (city)""")
def city_lookup(spark, sf_dir):
    cities = lookup.city_frame(spark, lookup.WORLD_CITIES)
    return lookup.city_lookup(obs(spark, sf_dir).select(*ROW), cities)


@query("city_unmatched", f"""WITH {OBS} SELECT DISTINCT city FROM obs
WHERE city NOT IN ('Paris', 'Lyon', 'Marseille', 'Bordeaux', 'Lille', 'Strasbourg')""")
def city_unmatched(spark, sf_dir):
    return lookup.city_unmatched(obs(spark, sf_dir), lookup.city_frame(spark, lookup.MONITORED_CITIES))
