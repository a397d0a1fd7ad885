"""Schemas of the inputs and outputs, as Spark DDL.

Humidity is an array of doubles: with an integer array one fractional element
would turn the whole array into null.
"""

# Field names of the two payload dialects and of the messages.
CURRENT_WEATHER = (
    "STRUCT<temperature: DOUBLE, windspeed: DOUBLE, winddirection: DOUBLE, weathercode: INT, time: STRING>"
)
CURRENT = (
    "STRUCT<time: STRING, temperature_2m: DOUBLE, relative_humidity_2m: DOUBLE, "
    "precipitation: DOUBLE, wind_speed_10m: DOUBLE>"
)
HOURLY = (
    "STRUCT<time: ARRAY<STRING>, temperature_2m: ARRAY<DOUBLE>, relative_humidity_2m: ARRAY<DOUBLE>, "
    "precipitation: ARRAY<DOUBLE>, windspeed_10m: ARRAY<DOUBLE>, winddirection_10m: ARRAY<DOUBLE>, "
    "wind_speed_10m: ARRAY<DOUBLE>>"
)
COORDINATES = "STRUCT<latitude: DOUBLE, longitude: DOUBLE>"
TEMPERATURE_SUMMARY = "STRUCT<avg_temp: DOUBLE, min_temp: DOUBLE, max_temp: DOUBLE>"

# One object per city and fetch; holds both dialects.
RAW = (
    "city STRING, latitude DOUBLE, longitude DOUBLE, generationtime_ms DOUBLE, timezone STRING, timestamp STRING, "
    f"current_weather {CURRENT_WEATHER}, current {CURRENT}, hourly {HOURLY}"
)
CORRUPT = "_corrupt_record"

# All message shapes on the weather topic: a city message or a statistics message.
MESSAGE = (
    f"type STRING, city STRING, timestamp STRING, current_weather {CURRENT_WEATHER}, "
    f"coordinates {COORDINATES}, data {TEMPERATURE_SUMMARY}"
)
ALERT_MESSAGE = (
    f"timestamp STRING, city STRING, coordinates {COORDINATES}, "
    "alert STRUCT<type: STRING, value: DOUBLE, threshold: DOUBLE, message: STRING>"
)

CITY = "city STRING, latitude DOUBLE, longitude DOUBLE"
CURRENT_FLAT = (
    "city STRING, latitude DOUBLE, longitude DOUBLE, temperature DOUBLE, windspeed DOUBLE, "
    "winddirection DOUBLE, weathercode INT, time STRING"
)
CITY_STATS = (
    "city STRING, avg_temperature DOUBLE, min_temperature DOUBLE, max_temperature DOUBLE, "
    "avg_windspeed DOUBLE, max_windspeed DOUBLE"
)
DAILY_CITY_STATS = f"{CITY_STATS}, obs_date DATE"
SNAPSHOT_STATS = (
    "city STRING, date DATE, avg_temp DOUBLE, min_temp DOUBLE, max_temp DOUBLE, "
    "avg_humidity DOUBLE, precipitation DOUBLE, avg_windspeed DOUBLE"
)
ALERTS = (
    "id STRING, city STRING, timestamp TIMESTAMP_NTZ, alert_type STRING, value DOUBLE, threshold DOUBLE, "
    "message STRING, forecast_time STRING, processed INT"
)
