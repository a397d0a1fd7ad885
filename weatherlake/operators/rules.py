"""Threshold rules and the texts of their alerts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from weatherlake.session import literal_frame


@dataclass(frozen=True)
class Rule:
    """An alert of type `type` when `metric` is above (or below) `threshold`; equal is no alert."""

    profile: str
    type: str
    metric: str
    direction: str
    threshold: float
    message: str
    forecast_message: str | None = None
    priority_threshold: float | None = None
    enabled: bool = True


# Thresholds and message texts of the profiles. {city}, {value}, {threshold} and {time}
# stand for the alert's own values.
BASIC = [
    Rule("basic", "HIGH_TEMPERATURE", "temperature", "above", 35.0,
         "Température élevée détectée à {city}: {value}°C"),
    Rule("basic", "LOW_TEMPERATURE", "temperature", "below", -10.0,
         "Température basse détectée à {city}: {value}°C"),
    Rule("basic", "HIGH_WIND", "windspeed", "above", 80.0,
         "Vent fort détecté à {city}: {value} km/h"),
    Rule("basic", "HEAVY_RAIN", "precipitation", "above", 10.0,
         "Fortes pluies détectées à {city}: {value} mm", enabled=False),
]
MONITORED = [
    Rule("monitored", "temperature_high", "temperature", "above", 35.0,
         "Température élevée à {city}: {value}°C (seuil: {threshold}°C)",
         "Prévision de température élevée à {city} pour {time}: {value}°C", priority_threshold=35.0 + 5),
    Rule("monitored", "temperature_low", "temperature", "below", 0.0,
         "Température basse à {city}: {value}°C (seuil: {threshold}°C)",
         "Prévision de température basse à {city} pour {time}: {value}°C"),
    Rule("monitored", "precipitation", "precipitation", "above", 25.0,
         "Fortes précipitations à {city}: {value}mm (seuil: {threshold}mm)",
         "Prévision de fortes précipitations à {city} pour {time}: {value}mm", priority_threshold=25.0 * 1.5),
    Rule("monitored", "wind_speed", "windspeed", "above", 50.0,
         "Vents violents à {city}: {value}km/h (seuil: {threshold}km/h)",
         "Prévision de vents violents à {city} pour {time}: {value}km/h", priority_threshold=50.0 * 1.2),
]
EXTREME_THRESHOLDS = {"temperature_high": 40.0, "temperature_low": -20.0, "precipitation": 50.0, "wind_speed": 100.0}

EXTREME = [
    Rule("extreme", rule.type, rule.metric, rule.direction, EXTREME_THRESHOLDS[rule.type],
         rule.message, rule.forecast_message)
    for rule in MONITORED
]
PROFILES = {"basic": BASIC, "monitored": MONITORED, "extreme": EXTREME}

RULE_SCHEMA = (
    "profile STRING, type STRING, metric STRING, direction STRING, threshold DOUBLE, priority_threshold DOUBLE, "
    "message STRING, forecast_message STRING, enabled BOOLEAN"
)


def rule_frame(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules as a table, which can be stored, edited and given to `alerts.detect_by_table`."""
    names = [part.split()[0] for part in RULE_SCHEMA.split(", ")]
    return literal_frame(spark, [tuple(getattr(rule, name) for name in names) for rule in rules], RULE_SCHEMA)


def all_profiles(spark: SparkSession) -> DataFrame:
    """The rules of all profiles as one table."""
    return rule_frame(spark, [rule for rules in PROFILES.values() for rule in rules])
