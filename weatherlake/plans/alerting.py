"""Queries that raise, count and word alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherlake.operators import alerts, reshape
from weatherlake.operators.lookup import WORLD_CITIES, city_frame, city_lookup
from weatherlake.operators.rules import BASIC, EXTREME, MONITORED, Rule, all_profiles
from weatherlake.plans.bindings import CITY_TABLE, HOURLY, OBS, obs, payloads
from weatherlake.plans.catalog import query, stamp
from weatherlake.session import scratch_path
from weatherlake.sources import messages as msg
from weatherlake.sources import tables

ALERT_DAY = "2024-01-15"


def _text_sql(template: str, value: str, threshold: float, time: str = "NULL") -> str:
    """SQL that fills a message text."""
    pieces = {"{city}": "city", "{value}": f"CAST({value} AS VARCHAR)", "{threshold}": f"'{threshold}'", "{time}": time}
    text = "'" + template.replace("'", "''") + "'"
    for name, piece in pieces.items():
        text = text.replace(name, f"' || {piece} || '")
    return text


def alert_sql(source: str, kept: str, rules: list[Rule], forecast: bool = False, time: str = "NULL") -> str:
    """SQL with one SELECT per enabled rule."""
    selects = []
    for number, rule in enumerate(rules):
        if not rule.enabled:
            continue
        sign = ">" if rule.direction == "above" else "<"
        name = f"forecast_{rule.type}" if forecast else rule.type
        text = _text_sql(rule.forecast_message if forecast else rule.message, rule.metric, rule.threshold, time)
        selects.append(
            f"SELECT {kept}, '{name}' AS alert_type, {rule.metric} AS value, {rule.threshold}::DOUBLE AS threshold, "
            f"{text} AS message, {number} AS rule_no FROM {source} WHERE {rule.metric} {sign} {rule.threshold}"
        )
    return " UNION ALL ".join(selects)


def readings(spark, sf_dir):
    """Every observation as a reading."""
    return obs(spark, sf_dir).select("city", F.col("ts").alias("timestamp"), "temperature", "precipitation", "windspeed")


def monitored(spark, sf_dir):
    return alerts.detect(readings(spark, sf_dir), MONITORED)


def unified(spark, sf_dir):
    return reshape.unify(payloads(spark, sf_dir))


def _flat(rules: list[Rule]) -> str:
    return f"{OBS}, alerts AS ({alert_sql('obs', 'city, ts', rules)})"


FLAT = f"city, {stamp('ts', 'timestamp')}, alert_type, value, threshold, message"
MONITORED_FLAT = _flat(MONITORED)
# Current values of the payloads, as far as the dialect has them, and all hourly values.
NESTED = f"""{HOURLY}, stamped AS (SELECT *, strftime(snap_ts, '%Y-%m-%dT%H:%M:%S') AS timestamp FROM hourly),
first AS (SELECT * REPLACE (CASE WHEN second THEN precipitation END AS precipitation) FROM stamped WHERE pos = 1),
current_alerts AS ({alert_sql('first', 'city, fetch_no, timestamp, CAST(NULL AS VARCHAR) AS forecast_time, 0 AS pos', MONITORED)}),
forecast_alerts AS ({alert_sql('stamped', 'city, fetch_no, timestamp, hour_time AS forecast_time, pos', MONITORED, True, 'hour_time')})"""
ALERT = "city, timestamp, forecast_time, alert_type, value, threshold, message"


@query("alerts_basic", f"WITH {_flat(BASIC)} SELECT {FLAT} FROM alerts")
def alerts_basic(spark, sf_dir):
    return alerts.detect(readings(spark, sf_dir), BASIC)


@query("alerts_extreme", f"WITH {_flat(EXTREME)} SELECT {FLAT} FROM alerts")
def alerts_extreme(spark, sf_dir):
    return alerts.detect(readings(spark, sf_dir), EXTREME)


@query("alerts_current", f"WITH {MONITORED_FLAT} SELECT {FLAT} FROM alerts")
def alerts_current(spark, sf_dir):
    return monitored(spark, sf_dir)


@query("alerts_forecast", f"WITH {NESTED} SELECT {ALERT} FROM forecast_alerts")
def alerts_forecast(spark, sf_dir):
    return alerts.detect(alerts.forecast_readings(unified(spark, sf_dir)), MONITORED)


@query("alerts_all", f"""WITH {NESTED}
SELECT {ALERT} FROM current_alerts UNION ALL SELECT {ALERT} FROM forecast_alerts""")
def alerts_all(spark, sf_dir):
    return alerts.detect(alerts.all_readings(unified(spark, sf_dir)), MONITORED)


@query("alerts_rule_table", f"""WITH {NESTED}
SELECT {ALERT} FROM current_alerts UNION ALL SELECT {ALERT} FROM forecast_alerts""")
def alerts_rule_table(spark, sf_dir):
    """The rules come from a stored table that holds all profiles."""
    path = scratch_path(spark, "rules")
    tables.publish_rules(all_profiles(spark), path)
    return alerts.detect_by_table(alerts.all_readings(unified(spark, sf_dir)), tables.read_rules(spark, path, "monitored"))


@query("alert_bundle", f"""WITH {NESTED}, both_kinds AS (
  SELECT * FROM current_alerts UNION ALL SELECT * FROM forecast_alerts)
SELECT city, timestamp, CAST(to_json(list(struct_pack(alert_type := alert_type, value := value, threshold := threshold,
  message := message, forecast_time := forecast_time) ORDER BY pos, rule_no)) AS VARCHAR) AS alerts
FROM both_kinds GROUP BY city, fetch_no, timestamp""")
def alert_bundle(spark, sf_dir):
    return alerts.alert_bundle(unified(spark, sf_dir), MONITORED)


PRIORITY = """((alert_type = 'temperature_high' AND value > 40) OR (alert_type = 'precipitation' AND value > 37.5)
  OR (alert_type = 'wind_speed' AND value > 60))"""


@query("alerts_high_priority", f"WITH {MONITORED_FLAT} SELECT {FLAT} FROM alerts WHERE {PRIORITY}")
def alerts_high_priority(spark, sf_dir):
    return alerts.high_priority(monitored(spark, sf_dir), MONITORED)


@query("alert_digest", f"""WITH {MONITORED_FLAT}
SELECT city, {stamp('ts', 'timestamp')}, alert_type, message FROM alerts WHERE {PRIORITY}""")
def alert_digest(spark, sf_dir):
    return alerts.digest(alerts.high_priority(monitored(spark, sf_dir), MONITORED))


@query("alert_counts", f"""WITH {MONITORED_FLAT} SELECT city, alert_type, count(*) AS alert_count FROM alerts
WHERE CAST(ts AS DATE) = DATE '{ALERT_DAY}' GROUP BY city, alert_type""")
def alert_counts(spark, sf_dir):
    return alerts.alert_counts(monitored(spark, sf_dir), ALERT_DAY)


@query("alert_display", f"""WITH {MONITORED_FLAT} SELECT city, alert_type, count(*) AS alert_count,
  array_to_string(list_transform(string_split(replace(alert_type, '_', ' '), ' '),
    lambda word: upper(word[1]) || lower(word[2:])), ' ') AS display_type
FROM alerts GROUP BY city, alert_type""")
def alert_display(spark, sf_dir):
    return alerts.with_display_type(alerts.alert_counts(monitored(spark, sf_dir)))


@query("alert_summary", f"""WITH {MONITORED_FLAT}, counts AS (
  SELECT city, alert_type, count(*) AS n FROM alerts GROUP BY city, alert_type)
SELECT city, '{{' || string_agg('"' || alert_type || '":' || n, ',' ORDER BY n DESC, alert_type) || '}}' AS summary
FROM counts GROUP BY city""")
def alert_summary(spark, sf_dir):
    return alerts.alert_summary(alerts.count_alerts(monitored(spark, sf_dir)))


@query("alert_totals", f"WITH {MONITORED_FLAT} SELECT count(*) AS n_alerts, count(DISTINCT city) AS n_cities FROM alerts")
def alert_totals(spark, sf_dir):
    return alerts.alert_totals(monitored(spark, sf_dir))


@query("alert_messages", f"""WITH {_flat(BASIC)}, {CITY_TABLE}
SELECT city AS key, CAST(to_json(struct_pack(timestamp := strftime(ts, '%Y-%m-%dT%H:%M:%S'), city := city,
  coordinates := struct_pack(latitude := latitude, longitude := longitude),
  alert := struct_pack(type := alert_type, value := value, threshold := threshold, message := message))) AS VARCHAR) AS value
FROM alerts LEFT JOIN cities USING (city)""")
def alert_messages(spark, sf_dir):
    found = alerts.detect(readings(spark, sf_dir), BASIC)
    located = city_lookup(found, city_frame(spark, WORLD_CITIES), "left")
    return msg.alert_messages(located.select(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), "city",
        F.struct("latitude", "longitude").alias("coordinates"), "alert_type", "value", "threshold", "message",
    ))
