"""Weather-shaped views of the given tables, each with the DuckDB text of the same view.

Measures are whole numbers over powers of two. Such doubles add up without rounding in any order,
so sums and means do not depend on how Spark splits the work and equal DuckDB's to the last bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherlake.functions.calendar import iso_minute, iso_second
from weatherlake.operators.lookup import WORLD_CITIES, city_frame, city_lookup

# Event types stand for cities; a type that is not listed is a city of that name.
CITY_OF_TYPE = {"click": "Paris", "view": "New York", "purchase": "Tokyo", "signup": "Sydney", "error": "Nairobi"}
CITIES = [city for city, _, _ in WORLD_CITIES]
# Weather codes given to the rows in turn.
CODES = [0, 1, 2, 3, 45, 51, 61, 63, 65, 71, 80, 82, 95]
# Consecutive events that make up the snapshots of one fetch.
FETCH_EVENTS = 120
# Cities whose payloads are in the second dialect.
SECOND_DIALECT = ["Paris", "Tokyo"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str) -> Column:
    return F.rint(F.col(column) * 100).cast("long")


def weather_code(key: str) -> Column:
    codes = F.array(*[F.lit(code) for code in CODES])
    return F.get(codes, (F.col(key) % len(CODES)).cast("int"))


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per event: city, station, time and all measures."""
    city = F.lit(None).cast("string")
    names = F
    for event_type, name in CITY_OF_TYPE.items():
        names = names.when(F.col("event_type") == event_type, name)
    city = names.otherwise(F.col("event_type"))
    number = F.regexp_extract("props", "[0-9]+", 0).try_cast("double")
    value = cents("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        city.alias("city"),
        F.col("user_id").alias("station"),
        "ts",
        F.col("ts").cast("date").alias("obs_date"),
        (value / 256.0 - 24.0).alias("temperature"),
        (number * 1.25).alias("windspeed"),
        (100.0 - number / 2.0).alias("humidity"),
        (F.greatest(value - 10000, F.lit(0)) / 256.0).alias("precipitation"),
        ((F.col("event_id") * 37) % 360).cast("double").alias("winddirection"),
        (1013.25 - value / 1024.0 + ((F.col("event_id") * 7) % 32) / 4.0).alias("pressure"),
        weather_code("event_id").alias("weathercode"),
    )


def _code_list() -> str:
    return ", ".join(str(code) for code in CODES)


_CITY_CASE = " ".join(f"WHEN '{t}' THEN '{c}'" for t, c in CITY_OF_TYPE.items())
OBS = f"""obs AS (
  SELECT event_id, CASE event_type {_CITY_CASE} ELSE event_type END AS city, user_id AS station,
         ts, CAST(ts AS DATE) AS obs_date,
         cents / 256::DOUBLE - 24::DOUBLE AS temperature,
         k * 1.25::DOUBLE AS windspeed,
         100::DOUBLE - k / 2::DOUBLE AS humidity,
         greatest(cents - 10000, 0) / 256::DOUBLE AS precipitation,
         CAST((event_id * 37) % 360 AS DOUBLE) AS winddirection,
         1013.25::DOUBLE - cents / 1024::DOUBLE + ((event_id * 7) % 32) / 4::DOUBLE AS pressure,
         ([{_code_list()}])[event_id % {len(CODES)} + 1] AS weathercode
  FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents,
               TRY_CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) AS k FROM events)
)"""


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations over several months: two thirds of them are put one or two spans of 31 days earlier."""
    back = (F.col("event_id") % 3 * 31).cast("int")
    return obs(spark, sf_dir).withColumn("obs_date", F.date_sub("obs_date", back))


MONTHS = f"""{OBS}, months AS (
  SELECT * REPLACE (CAST(obs_date - CAST(event_id % 3 * 31 AS INTEGER) AS DATE) AS obs_date) FROM obs)"""


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested raw payloads: a city's observations of one fetch as parallel hourly arrays.

    The first observation is the current one. A fetch spans FETCH_EVENTS event ids, which bounds
    the arrays and the groups. Cities in SECOND_DIALECT come in the second dialect.
    """
    elements = F.sort_array(F.collect_list(F.struct(
        "event_id", "ts", iso_minute(F.date_trunc("hour", "ts")).alias("hour_time"), "temperature", "windspeed",
        "winddirection", "humidity", "precipitation", "weathercode",
    )))
    fetch = F.expr(f"event_id div {FETCH_EVENTS}")
    fetched = obs(spark, sf_dir).groupBy("city", fetch.alias("fetch_no")).agg(elements.alias("r"))
    located = city_lookup(fetched, city_frame(spark, WORLD_CITIES), "left")
    first = F.col("r")[0]
    second = F.col("city").isin(*SECOND_DIALECT)
    speeds = F.col("r.windspeed")
    return located.select(
        "city",
        "latitude",
        "longitude",
        F.lit(0.5).alias("generationtime_ms"),
        F.lit("GMT").alias("timezone"),
        iso_second(first["ts"]).alias("timestamp"),
        F.when(~second, F.struct(
            first["temperature"].alias("temperature"),
            first["windspeed"].alias("windspeed"),
            first["winddirection"].alias("winddirection"),
            first["weathercode"].alias("weathercode"),
            iso_minute(first["ts"]).alias("time"),
        )).alias("current_weather"),
        F.when(second, F.struct(
            iso_minute(first["ts"]).alias("time"),
            first["temperature"].alias("temperature_2m"),
            first["humidity"].alias("relative_humidity_2m"),
            first["precipitation"].alias("precipitation"),
            first["windspeed"].alias("wind_speed_10m"),
        )).alias("current"),
        F.struct(
            F.col("r.hour_time").alias("time"),
            F.col("r.temperature").alias("temperature_2m"),
            F.col("r.humidity").alias("relative_humidity_2m"),
            F.col("r.precipitation").alias("precipitation"),
            F.when(~second, speeds).alias("windspeed_10m"),
            F.when(~second, F.col("r.winddirection")).alias("winddirection_10m"),
            F.when(second, speeds).alias("wind_speed_10m"),
        ).alias("hourly"),
        first["ts"].cast("date").alias("extraction_date"),
    )


_DIALECTS = ", ".join(f"'{city}'" for city in SECOND_DIALECT)
_WORLD = ", ".join(f"('{c}', {lat}::DOUBLE, {lon}::DOUBLE)" for c, lat, lon in WORLD_CITIES)
CITY_TABLE = f"cities AS (SELECT * FROM (VALUES {_WORLD}) AS v(city, latitude, longitude))"
# One row per hourly element, with its place in the snapshot and the snapshot's own columns.
HOURLY = f"""{OBS}, hourly AS (
  SELECT *, city IN ({_DIALECTS}) AS second, event_id // {FETCH_EVENTS} AS fetch_no,
         date_trunc('hour', ts) AS hour_ts, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M') AS hour_time,
         first_value(ts) OVER w AS snap_ts, row_number() OVER w AS pos
  FROM obs WINDOW w AS (PARTITION BY city, event_id // {FETCH_EVENTS} ORDER BY event_id)
)"""
# One row per payload with its current observation.
SNAPSHOTS = f"""{HOURLY}, {CITY_TABLE}, snap AS (
  SELECT hourly.*, latitude, longitude, strftime(snap_ts, '%Y-%m-%dT%H:%M:%S') AS stamp,
         strftime(ts, '%Y-%m-%dT%H:%M') AS minute
  FROM hourly LEFT JOIN cities USING (city) WHERE pos = 1
)"""


def climate_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per order, over several years; the customer stands for the station."""
    value = cents("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("station"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderdate").cast("date").alias("obs_date"),
        (value / 1048576.0 - 8.0).alias("temperature"),
        ((value % 4096) / 64.0).alias("precipitation"),
        weather_code("o_orderkey").alias("weathercode"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station, its city and its region."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("region")
    )
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station"), "c_nationkey")
    return customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("station", "city", "region")


SEASON = """CASE month(obs_date) WHEN 12 THEN 'winter' WHEN 1 THEN 'winter' WHEN 2 THEN 'winter'
  WHEN 3 THEN 'spring' WHEN 4 THEN 'spring' WHEN 5 THEN 'spring' WHEN 6 THEN 'summer' WHEN 7 THEN 'summer'
  WHEN 8 THEN 'summer' ELSE 'autumn' END"""
CONDITION = """CASE WHEN weathercode = 0 THEN 'clear' WHEN weathercode <= 3 THEN 'cloudy'
  WHEN weathercode BETWEEN 45 AND 48 THEN 'fog' WHEN weathercode BETWEEN 51 AND 57 THEN 'drizzle'
  WHEN weathercode BETWEEN 61 AND 67 OR weathercode BETWEEN 80 AND 82 THEN 'rain'
  WHEN weathercode BETWEEN 71 AND 77 OR weathercode BETWEEN 85 AND 86 THEN 'snow'
  WHEN weathercode BETWEEN 95 AND 99 THEN 'thunderstorm' ELSE 'unknown' END"""
CLIMATE = f"""climate AS (
  SELECT *, {SEASON} AS season, {CONDITION} AS condition FROM (
    SELECT o_custkey AS station, o_orderdate AS ts, CAST(o_orderdate AS DATE) AS obs_date,
           cents / 1048576::DOUBLE - 8::DOUBLE AS temperature, (cents % 4096) / 64::DOUBLE AS precipitation,
           ([{_code_list()}])[o_orderkey % {len(CODES)} + 1] AS weathercode
    FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders))
), places AS (
  SELECT c_custkey AS station, n_name AS city, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), placed AS (SELECT * FROM climate JOIN places USING (station))"""
