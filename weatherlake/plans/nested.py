"""Queries on nested payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherlake.functions.calendar import date_hour
from weatherlake.operators import reshape, stats
from weatherlake.plans.bindings import HOURLY, SNAPSHOTS, payloads
from weatherlake.plans.catalog import day, query, stamp
from weatherlake.sources.reports import monthly_text as monthly_text_blocks

SERIES = f"city, {day('CAST(snap_ts AS DATE)', 'date')}, right(hour_time, 5) AS hour, {stamp('hour_ts', 'ts')}"
SNAPSHOT_STATS = """SELECT city, CAST(snap_ts AS DATE) AS date, avg(temperature) AS avg_temp, min(temperature) AS min_temp,
    max(temperature) AS max_temp, avg(humidity) AS avg_humidity, sum(precipitation) AS precipitation,
    avg(CASE WHEN NOT second THEN windspeed END) AS avg_windspeed
  FROM hourly GROUP BY city, fetch_no, snap_ts"""


def _rounded(value: str, name: str) -> str:
    return f"round_even({value} * 100, 0) / 100 AS {name}"


REPORT = f"""report AS (SELECT city, {_rounded('avg(avg_temp)', 'avg_temp')}, {_rounded('min(min_temp)', 'min_temp')},
  {_rounded('max(max_temp)', 'max_temp')}, {_rounded('avg(avg_humidity)', 'avg_humidity')},
  {_rounded('coalesce(sum(precipitation), 0)', 'precipitation')}, {_rounded('avg(avg_windspeed)', 'avg_windspeed')}
  FROM ({SNAPSHOT_STATS}) WHERE strftime(date, '%Y%m') = '202401' GROUP BY city)"""


@query("current_flat", f"""WITH {SNAPSHOTS} SELECT city, latitude, longitude,
  CASE WHEN NOT second THEN temperature END AS temperature, CASE WHEN NOT second THEN windspeed END AS windspeed,
  CASE WHEN NOT second THEN winddirection END AS winddirection,
  CASE WHEN NOT second THEN weathercode END AS weathercode, CASE WHEN NOT second THEN minute END AS time FROM snap""")
def current_flat(spark, sf_dir):
    return reshape.current_flat(payloads(spark, sf_dir))


@query("unified_current", f"""WITH {SNAPSHOTS} SELECT city, stamp AS timestamp, temperature,
  CASE WHEN second THEN humidity END AS humidity, CASE WHEN second THEN precipitation END AS precipitation, windspeed,
  CASE WHEN NOT second THEN winddirection END AS winddirection,
  CASE WHEN NOT second THEN weathercode END AS weathercode, minute AS time FROM snap""")
def unified_current(spark, sf_dir):
    return reshape.unified_current(payloads(spark, sf_dir))


@query("hourly_temperature", f"WITH {HOURLY} SELECT {SERIES}, temperature FROM hourly")
def hourly_temperature(spark, sf_dir):
    return reshape.hourly_temperature(payloads(spark, sf_dir))


@query("date_hour_series", f"""WITH {HOURLY} SELECT {SERIES}, temperature,
  strftime(CAST(strftime(snap_ts, '%Y-%m-%d') || ' ' || right(hour_time, 5) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS date_hour FROM hourly""")
def date_hour_series(spark, sf_dir):
    """The series with its hours on the snapshot's date, as charts show them."""
    series = reshape.hourly_temperature(payloads(spark, sf_dir))
    return series.withColumn("date_hour", date_hour(F.col("date"), F.col("hour")))


@query("hourly_precipitation", f"WITH {HOURLY} SELECT {SERIES}, precipitation FROM hourly")
def hourly_precipitation(spark, sf_dir):
    return reshape.hourly_precipitation(payloads(spark, sf_dir))


@query("hourly_wind", f"""WITH {HOURLY}
SELECT {SERIES}, windspeed AS wind_speed, winddirection AS wind_direction FROM hourly WHERE NOT second""")
def hourly_wind(spark, sf_dir):
    return reshape.hourly_wind(payloads(spark, sf_dir))


@query("hourly_latest", f"""WITH {HOURLY}, ranked AS (SELECT *, row_number() OVER (PARTITION BY city, hour_ts
  ORDER BY date_trunc('second', snap_ts) DESC, pos DESC) AS version FROM hourly)
SELECT city, {stamp('hour_ts', 'ts')}, {stamp("date_trunc('second', snap_ts)", 'snapshot')}, temperature, precipitation
FROM ranked WHERE version = 1""")
def hourly_latest(spark, sf_dir):
    return reshape.hourly_latest(payloads(spark, sf_dir))


@query("snapshot_stats", f"""WITH {HOURLY} SELECT city, {day('date')}, avg_temp, min_temp, max_temp, avg_humidity,
  precipitation, avg_windspeed FROM ({SNAPSHOT_STATS})""")
def snapshot_stats(spark, sf_dir):
    return reshape.snapshot_stats(payloads(spark, sf_dir))


def _report(spark, sf_dir):
    return stats.monthly_report(reshape.snapshot_stats(payloads(spark, sf_dir)), "2024-01")


@query("monthly_report", f"WITH {HOURLY}, {REPORT} SELECT * FROM report")
def monthly_report(spark, sf_dir):
    return _report(spark, sf_dir)


@query("monthly_text", f"""WITH {HOURLY}, {REPORT} SELECT city, 'Ville: ' || city || chr(10)
  || '  Température moyenne: ' || avg_temp || '°C' || chr(10)
  || '  Température min/max: ' || min_temp || '°C / ' || max_temp || '°C' || chr(10)
  || '  Humidité moyenne: ' || avg_humidity || '%' || chr(10)
  || '  Précipitations totales: ' || precipitation || ' mm' || chr(10)
  || '  Vitesse moyenne du vent: ' || coalesce(CAST(avg_windspeed AS VARCHAR), 'nan') || ' km/h' || chr(10) AS block
FROM report""")
def monthly_text(spark, sf_dir):
    return monthly_text_blocks(_report(spark, sf_dir))
