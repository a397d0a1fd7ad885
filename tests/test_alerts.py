"""Threshold rules, texts and what is made of alerts."""

import json

import pytest
from pyspark.sql import functions as F
from samples import drop, payload, second_dialect

from weatherlake.operators import alerts, reshape
from weatherlake.operators.rules import BASIC, EXTREME, MONITORED, Rule, all_profiles, rule_frame
from weatherlake.sources import messages, raw, tables

READING = "city STRING, timestamp STRING, temperature DOUBLE, precipitation DOUBLE, windspeed DOUBLE"


def readings(spark, *rows):
    return spark.createDataFrame([("Paris", "2025-09-24T09:00", *row) for row in rows], READING)


def types(df):
    return sorted(r.alert_type for r in df.collect())


def test_comparison_is_strict(spark):
    at = readings(spark, (35.0, 25.0, 50.0), (0.0, 0.0, 0.0))
    beyond = readings(spark, (35.1, 25.1, 50.1), (-0.1, 0.0, 0.0))
    assert types(alerts.detect(at, MONITORED)) == []
    assert types(alerts.detect(beyond, MONITORED)) == [
        "precipitation", "temperature_high", "temperature_low", "wind_speed"
    ]


def test_null_values_raise_no_alert_and_hide_none(spark):
    assert types(alerts.detect(readings(spark, (None, None, 90.0)), BASIC)) == ["HIGH_WIND"]


def test_disabled_rule_raises_nothing(spark):
    assert types(alerts.detect(readings(spark, (20.0, 99.0, 0.0)), BASIC)) == []
    assert rule_frame(spark, BASIC).where("NOT enabled").select("type").collect() == [("HEAVY_RAIN",)]


def test_no_rule_for_the_metrics_gives_no_alerts(spark):
    found = alerts.detect(readings(spark, (99.0, 99.0, 99.0)).drop("temperature", "windspeed"), BASIC)
    assert found.columns == ["city", "timestamp", *alerts.ALERT_FIELDS] and found.count() == 0


def test_profiles_differ(spark):
    cold = readings(spark, (-15.0, 0.0, 90.0))
    assert types(alerts.detect(cold, BASIC)) == ["HIGH_WIND", "LOW_TEMPERATURE"]
    assert types(alerts.detect(cold, EXTREME)) == []


def test_texts(spark):
    found = alerts.detect(readings(spark, (36.5, 0.0, 81.0)), BASIC).collect()
    assert sorted(r.message for r in found) == [
        "Température élevée détectée à Paris: 36.5°C", "Vent fort détecté à Paris: 81.0 km/h",
    ]
    found = alerts.detect(readings(spark, (36.5, 0.0, 0.0)), MONITORED).collect()
    assert found[0].message == "Température élevée à Paris: 36.5°C (seuil: 35.0°C)"


def unified(spark, tmp_path, *payloads):
    drop(tmp_path, "weather_20250924_090000.json", list(payloads))
    return reshape.unify(raw.read_raw(spark, str(tmp_path), "2025-09-24"))


def test_current_and_forecast(spark, tmp_path):
    df = unified(spark, tmp_path, second_dialect())
    current = alerts.detect(alerts.current_readings(df), MONITORED)
    forecast = alerts.detect(alerts.forecast_readings(df), MONITORED)
    assert types(current) == ["temperature_high"]
    assert types(forecast) == [
        "forecast_precipitation", "forecast_temperature_high", "forecast_temperature_low", "forecast_wind_speed"
    ]
    messages_of = {r.alert_type: r.message for r in forecast.collect()}
    assert messages_of["forecast_precipitation"] == (
        "Prévision de fortes précipitations à Lyon pour 2025-09-24T10:00: 26.0mm"
    )
    union = current.unionByName(forecast, allowMissingColumns=True)
    columns = sorted(union.columns)
    together = alerts.detect(alerts.all_readings(df), MONITORED)
    assert sorted(map(str, union.select(columns).collect())) == sorted(map(str, together.select(columns).collect()))


def test_forecast_needs_all_arrays_but_current_does_not(spark, tmp_path):
    partial = second_dialect()
    del partial["hourly"]["precipitation"]
    df = unified(spark, tmp_path, partial)
    assert types(alerts.detect(alerts.all_readings(df), MONITORED)) == ["temperature_high"]
    assert [len(r.alerts) for r in alerts.alert_bundle(df, MONITORED).collect()] == [1]


def test_rules_without_forecast_text_are_for_current_values_only(spark, tmp_path):
    df = unified(spark, tmp_path, second_dialect())
    assert types(alerts.detect(alerts.all_readings(df), BASIC)) == ["HIGH_TEMPERATURE"]
    bundle = alerts.alert_bundle(df, BASIC).collect()
    assert [[a.alert_type for a in r.alerts] for r in bundle] == [["HIGH_TEMPERATURE"]]


def test_bundle_is_the_alerts_by_payload(spark, tmp_path):
    df = unified(spark, tmp_path, second_dialect(), second_dialect("Lille", temperature_2m=20.0), payload("Nice"))
    bundles = {r.city: [a.alert_type for a in r.alerts] for r in alerts.alert_bundle(df, MONITORED).collect()}
    forecast = [
        "forecast_temperature_high", "forecast_precipitation", "forecast_wind_speed", "forecast_temperature_low"
    ]
    assert bundles == {"Lyon": ["temperature_high", *forecast], "Lille": forecast}
    sent = messages.bundle_messages(alerts.alert_bundle(df, MONITORED)).where("key = 'Lyon'").collect()[0]
    assert json.loads(sent.value)["alerts"][0]["threshold"] == 35.0


def test_high_priority_is_for_current_alerts_beyond_the_second_threshold(spark, tmp_path):
    df = unified(
        spark, tmp_path, second_dialect("A", temperature_2m=40.0), second_dialect("B", temperature_2m=40.5),
        second_dialect("C", temperature_2m=-30.0), second_dialect("D", temperature_2m=1.0, precipitation=37.6),
    )
    urgent = alerts.high_priority(alerts.detect(alerts.all_readings(df), MONITORED), MONITORED)
    assert sorted((r.city, r.alert_type) for r in urgent.collect()) == [("B", "temperature_high"), ("D", "precipitation")]
    assert [r.city for r in alerts.digest(urgent).collect()] == ["B", "D"]


def test_counts_summary_and_totals(spark):
    found = spark.createDataFrame(
        [("Paris", "2025-09-24T01:00", "b"), ("Paris", "2025-09-24T02:00", "b"), ("Paris", "2025-09-24T03:00", "a"),
         ("Lyon", "2025-09-25T00:00", "a")],
        "city STRING, timestamp STRING, alert_type STRING",
    )
    counts = alerts.alert_counts(found, "2025-09-24")
    assert [tuple(r) for r in counts.collect()] == [("Paris", "b", 2), ("Paris", "a", 1)]
    assert [r.summary for r in alerts.alert_summary(counts).collect()] == ['{"b":2,"a":1}']
    assert alerts.alert_totals(found).collect() == [(4, 2)]
    assert alerts.with_display_type(spark.createDataFrame([("wind_speed",)], "alert_type STRING")).collect()[0][1] == "Wind Speed"


def test_alert_table_is_added_to_and_refuses_nulls(spark, tmp_path):
    path = str(tmp_path / "alerts")
    found = alerts.detect(readings(spark, (36.0, 0.0, 0.0)), MONITORED)
    tables.write_alerts(found, path, "2025-09-24")
    tables.write_alerts(found, path, "2025-09-24")
    tables.write_alerts(found.withColumn("value", F.lit(None).cast("double")), path, "2025-09-25")
    later = found.withColumn("timestamp", F.lit("2025-09-26T00:00:00"))
    tables.write_alerts(later, path, "2025-09-26")
    stored = tables.read_alerts(spark, path)
    assert stored.count() == 2
    row = tables.read_alerts(spark, path, "2025-09-24").collect()[0]
    assert (row.processed, row.forecast_time, row.alert_type) == (0, None, "temperature_high")
    assert stored.select("id").distinct().count() == 2
    assert tables.read_alerts(spark, path, run_day="2025-09-26").count() == 1
    assert tables.read_alerts(spark, str(tmp_path / "none")).count() == 0


def test_raising_a_threshold_never_adds_alerts(spark):
    rows = readings(spark, *[(float(t), float(t), float(t)) for t in range(-40, 120, 5)])
    basic, extreme = alerts.detect(rows, MONITORED), alerts.detect(rows, EXTREME)
    assert extreme.count() < basic.count()
    assert extreme.select("alert_type", "value").subtract(basic.select("alert_type", "value")).isEmpty()


def sorted_rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("few", [100, 3])
@pytest.mark.parametrize("rules", [BASIC, MONITORED, EXTREME])
def test_a_rule_table_gives_what_the_rules_do(spark, tmp_path, few, rules):
    """Broadcast, and dealt over parts."""
    df = unified(spark, tmp_path, second_dialect(), payload(), second_dialect("{value}", temperature_2m=41.5, precipitation=None))
    readings = alerts.all_readings(df)
    found = alerts.detect_by_table(readings, rule_frame(spark, rules), few=few, parts=3)
    assert sorted_rows(found) == sorted_rows(alerts.detect(readings, rules)) and found.count()
    assert found.columns == alerts.detect(readings, rules).columns
    current = alerts.current_readings(df)
    assert sorted_rows(alerts.detect_by_table(current, rule_frame(spark, rules), few=few)) == sorted_rows(alerts.detect(current, rules))


def test_more_rules_than_are_broadcast(spark, tmp_path):
    many = [Rule("many", f"t{i}", "temperature", "above" if i % 2 else "below", float(i - 50), "{city} {value} {threshold} {other}") for i in range(200)]
    df = unified(spark, tmp_path, payload())
    found = alerts.detect_by_table(alerts.current_readings(df), rule_frame(spark, many), few=50)
    assert "part#" in found._jdf.queryExecution().executedPlan().toString()
    value = payload()["current_weather"]["temperature"]
    hits = [r for r in many if (value > r.threshold if r.direction == "above" else value < r.threshold)]
    assert {r.message for r in found.collect()} == {f"Paris {value} {r.threshold} {{other}}" for r in hits} and hits


def test_empty_and_disabled_rule_tables_give_no_alerts(spark, tmp_path):
    readings = alerts.current_readings(unified(spark, tmp_path, second_dialect()))
    assert alerts.detect_by_table(readings, rule_frame(spark, [])).count() == 0
    assert alerts.detect_by_table(readings, all_profiles(spark).withColumn("enabled", F.lit(False))).count() == 0


def test_rule_table_is_stored_by_version(spark, tmp_path):
    path = str(tmp_path / "rules")
    assert tables.read_rules(spark, path).count() == 0
    assert tables.publish_rules(all_profiles(spark), path) == 1
    assert tables.publish_rules(rule_frame(spark, BASIC), path) == 2
    assert (tables.read_rules(spark, path).count(), tables.read_rules(spark, path, version=1).count()) == (4, 12)
    assert tables.read_rules(spark, path, "monitored", 1).count() == 4
