"""Messages: envelopes as key and JSON value, and their decoding. Works on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherlake import schemas
from weatherlake.operators.alerts import ALERT_FIELDS

# json.dumps writes nulls, to_json leaves them out unless told otherwise.
JSON_OPTIONS = {"ignoreNullFields": "false"}


def weather_messages(raw: DataFrame, stamp: Column) -> DataFrame:
    """One message per payload that has current weather: key is the city, value the JSON envelope."""
    envelope = F.struct(
        "city",
        stamp.alias("timestamp"),
        "current_weather",
        F.struct("latitude", "longitude").alias("coordinates"),
    )
    return raw.where(F.col("current_weather").isNotNull()).select(
        F.col("city").alias("key"), F.to_json(envelope, JSON_OPTIONS).alias("value")
    )


def statistics_message(summary: DataFrame, stamp: Column) -> DataFrame:
    """Statistics message from a temperature summary; it has no key."""
    message = F.struct(
        F.lit("statistics").alias("type"),
        stamp.alias("timestamp"),
        F.struct("avg_temp", "min_temp", "max_temp").alias("data"),
    )
    return summary.select(F.lit(None).cast("string").alias("key"), F.to_json(message, JSON_OPTIONS).alias("value"))


def alert_messages(alerts: DataFrame) -> DataFrame:
    """One message per alert, with its city, coordinates and stamp; key is the city."""
    names = dict(zip(ALERT_FIELDS, ("type", "value", "threshold", "message")))
    message = F.struct(
        "timestamp",
        "city",
        "coordinates",
        F.struct(*[F.col(field).alias(name) for field, name in names.items()]).alias("alert"),
    )
    return alerts.select(F.col("city").alias("key"), F.to_json(message, JSON_OPTIONS).alias("value"))


def bundle_messages(bundles: DataFrame) -> DataFrame:
    """One message per bundle, keyed by city."""
    message = F.struct("city", "timestamp", "alerts")
    return bundles.select(F.col("city").alias("key"), F.to_json(message, JSON_OPTIONS).alias("value"))


def decode(messages: DataFrame, schema: str = schemas.MESSAGE) -> DataFrame:
    """Decoded `value` of each message; what is no JSON decodes to nulls."""
    return messages.select(F.from_json(F.col("value"), schema).alias("m")).select("m.*")
