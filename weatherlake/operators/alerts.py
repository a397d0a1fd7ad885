"""Threshold alerts on current and forecast values, and what is made of them.

The rules are a short list known when the plan is built, so each reading is tested in its own row:
no join, no shuffle, and the test itself reaches the scan as a filter. The same functions run on
batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weatherlake.functions.arrays import zip_shortest
from weatherlake.functions.calendar import as_date
from weatherlake.functions.numbers import number_text
from weatherlake.functions.text import city_or_unknown, display_name, fill, fill_column
from weatherlake.operators.filters import in_days, order_rows, with_hourly
from weatherlake.operators.rules import Rule

METRICS = ("temperature", "precipitation", "windspeed")
HOURLY_FIELDS = ("time", *METRICS)
ALERT_FIELDS = ("alert_type", "value", "threshold", "message")
# Rules of a table that are sent to all executors, and the parts that readings are dealt over if there are more.
FEW_RULES = 10_000
PARTS = 64


def is_hit(rule: Rule, value: Column) -> Column:
    """Strict comparison; a null value is no hit."""
    return value > rule.threshold if rule.direction == "above" else value < rule.threshold


def _breaks(rule: Rule, value: Column, time: Column | None) -> Column:
    """A hit, and the rule is one for such readings: a rule without forecast text is for current values only."""
    hit = is_hit(rule, value)
    return hit & time.isNull() if time is not None and rule.forecast_message is None else hit


def _hits(
    rules: Sequence[Rule], metric: Callable[[str], Column], time: Column | None, *extra: Column
) -> Column:
    """Array with a struct per rule: the rule's number and the value if it is broken, else null."""
    return F.array(*[
        F.when(
            _breaks(rule, metric(rule.metric), time),
            F.struct(F.lit(number).alias("rule"), metric(rule.metric).alias("value"), *extra),
        )
        for number, rule in enumerate(rules)
    ])


def _any_hit(rules: Sequence[Rule], metric: Callable[[str], Column]) -> Column:
    return reduce(lambda a, b: a | b, [is_hit(rule, metric(rule.metric)) for rule in rules])


def _by_rule(rules: Sequence[Rule], number: Column, answer: Callable[[Rule], Column]) -> Column:
    """The answer of the rule with that number."""
    *others, last = enumerate(rules)
    chosen = F
    for i, rule in others:
        chosen = chosen.when(number == i, answer(rule))
    return chosen.otherwise(answer(last[1])) if others else answer(last[1])


def _alert_type(rules: Sequence[Rule], number: Column, time: Column | None) -> Column:
    name = _by_rule(rules, number, lambda rule: F.lit(rule.type))
    return name if time is None else F.concat(F.when(time.isNull(), "").otherwise("forecast_"), name)


def _message(rules: Sequence[Rule], number: Column, time: Column | None, **texts: Column) -> Column:
    def text(rule: Rule) -> Column:
        return fill(rule.message, threshold=F.lit(str(rule.threshold)), **texts)

    current = _by_rule(rules, number, text)
    if time is None or all(rule.forecast_message is None for rule in rules):
        return current

    def forecast_text(rule: Rule) -> Column:
        return text(rule) if rule.forecast_message is None else fill(rule.forecast_message, time=time, **texts)

    forecast = _by_rule(rules, number, forecast_text)
    return F.when(time.isNull(), current).otherwise(forecast)


def detect(readings: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per reading and rule that it breaks: the columns of `readings` without the metrics, then
    alert_type, value, threshold and message.

    A reading has a city, any of the metrics, and optionally `forecast_time`: where that is not null
    the alert is a forecast alert, with its own type and text, or none if the rule has no such text. The texts are made once per alert,
    after the readings without one are gone.
    """
    metrics = [m for m in METRICS if m in readings.columns]
    active = [rule for rule in rules if rule.enabled and rule.metric in metrics]
    kept = [c for c in readings.columns if c not in METRICS]
    if not active:
        nothing = "alert_type STRING, value DOUBLE, threshold DOUBLE, message STRING"
        columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(nothing)]
        return readings.where(F.lit(False)).select(*kept, *columns)
    rule, time = F.col("rule"), F.col("forecast_time") if "forecast_time" in kept else None
    hits = (
        readings.where(_any_hit(active, F.col))
        .select(*kept, F.inline(_hits(active, F.col, time)).alias("rule", "value"))
        .where(F.col("rule").isNotNull())
        .withColumn("value_text", number_text(F.col("value")))
    )
    return hits.select(
        *kept,
        _alert_type(active, rule, time).alias("alert_type"),
        "value",
        _by_rule(active, rule, lambda r: F.lit(r.threshold)).alias("threshold"),
        _message(active, rule, time, city=F.col("city"), value=F.col("value_text")).alias("message"),
    )


def detect_by_table(readings: DataFrame, rules: DataFrame, few: int = FEW_RULES, parts: int = PARTS) -> DataFrame:
    """The rows of `detect` for rules that are rows of a table (columns of `RULE_SCHEMA`) instead of part of the plan.

    The metrics become rows, which meet the rules of their metric; the direction decides which side of the threshold is a
    hit. The rules are counted first: up to `few` are sent to all executors; more than that are copied to `parts` parts,
    over which the readings are dealt, as there are only a few metrics to join by. A reading's metric has as many alerts
    as rules that it breaks. In a stream this is for micro-batches, as the count is a job of its own.
    """
    metrics = [m for m in METRICS if m in readings.columns]
    kept = [c for c in readings.columns if c not in METRICS]
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])
    values = readings.select(*kept, F.inline(values)).where(F.col("value").isNotNull())
    active = rules.where(F.col("enabled") & F.col("metric").isin(*metrics)).select("metric", F.struct("*").alias("rule"))
    rule, value = F.col("rule"), F.col("value")
    hit = F.when(rule["direction"] == "above", value > rule["threshold"]).otherwise(value < rule["threshold"])
    time = F.col("forecast_time") if "forecast_time" in kept else F.lit(None).cast("string")
    applies = hit & (time.isNull() | rule["forecast_message"].isNotNull())
    if active.count() <= few:
        hits = values.alias("v").join(F.broadcast(active.alias("r")), (F.col("v.metric") == F.col("r.metric")) & applies)
    else:
        dealt = values.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(parts)))
        copied = active.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        same = (F.col("v.metric") == F.col("r.metric")) & (F.col("v.part") == F.col("r.part"))
        hits = dealt.alias("v").join(copied.alias("r"), same & applies)
    text = F.when(time.isNull(), rule["message"]).otherwise(rule["forecast_message"])
    texts = {"city": F.col("city"), "value": number_text(value), "threshold": number_text(rule["threshold"]), "time": time}
    return hits.select(
        *[F.col(f"v.{name}") for name in kept],
        F.concat(F.when(time.isNull(), "").otherwise("forecast_"), rule["type"]).alias("alert_type"),
        "value",
        rule["threshold"].alias("threshold"),
        fill_column(text, **texts).alias("message"),
    )


def current_readings(payloads: DataFrame) -> DataFrame:
    """Current values of unified payloads as readings."""
    return payloads.select(
        city_or_unknown(F.col("city")).alias("city"), "timestamp", *[F.col(f"current.{m}").alias(m) for m in METRICS]
    )


def forecast_readings(payloads: DataFrame) -> DataFrame:
    """Hourly values of unified payloads as readings; payloads that lack one of the arrays give none."""
    return with_hourly(payloads, HOURLY_FIELDS).select(
        city_or_unknown(F.col("city")).alias("city"), "timestamp", F.inline(_hourly()).alias("forecast_time", *METRICS)
    )


def all_readings(payloads: DataFrame) -> DataFrame:
    """Current and hourly values together in one pass over the payloads; forecast_time is null for current ones."""
    current = F.array(F.struct(F.lit(None).cast("string").alias("time"), *[F.col(f"current.{m}").alias(m) for m in METRICS]))
    rows = F.when(_has_hourly(), F.concat(current, _hourly())).otherwise(current)
    return payloads.select(
        city_or_unknown(F.col("city")).alias("city"), "timestamp", F.inline(rows).alias("forecast_time", *METRICS)
    )


def _hourly() -> Column:
    return zip_shortest(F.col("hourly.time"), **{m: F.col(f"hourly.{m}") for m in METRICS})


def _has_hourly() -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"hourly.{field}").isNotNull() for field in HOURLY_FIELDS])


def _may_hit(rules: Sequence[Rule]) -> Column:
    """Whether a payload's extremes break a rule: compiled tests that spare most payloads the array functions."""
    tests = [F.lit(False)]
    for rule in rules:
        extreme = F.array_max if rule.direction == "above" else F.array_min
        for value in (F.col(f"current.{rule.metric}"), extreme(f"hourly.{rule.metric}")):
            breaks = value > rule.threshold if rule.direction == "above" else value < rule.threshold
            tests.append(F.coalesce(breaks, F.lit(False)))
    return reduce(lambda a, b: a | b, tests)


def alert_bundle(payloads: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per payload with alerts: city, timestamp and the array of its alerts, current ones first.

    The array is built inside the payload's row, so no group is ever collected.
    """
    active = [rule for rule in rules if rule.enabled]
    no_time = F.lit(None).cast("string")
    current = _hits(active, lambda m: F.col(f"current.{m}"), None, no_time.alias("time"))
    # Most hours break no rule: they are dropped before any array is made for them.
    breaking = F.filter(_hourly(), lambda e: _any_hit(active, lambda m: e[m]))
    hourly = F.flatten(F.transform(breaking, lambda e: _hits(active, lambda m: e[m], e["time"], e["time"].alias("time"))))
    hits = F.array_compact(F.when(_has_hourly(), F.concat(current, hourly)).otherwise(current))

    def alert(hit: Column) -> Column:
        rule, time = hit["rule"], hit["time"]
        message = _message(active, rule, time, city=F.col("city"), value=number_text(hit["value"]))
        return F.struct(
            _alert_type(active, rule, time).alias("alert_type"),
            hit["value"].alias("value"),
            _by_rule(active, rule, lambda r: F.lit(r.threshold)).alias("threshold"),
            message.alias("message"),
            time.alias("forecast_time"),
        )

    # Exploding an array of one array keeps the optimizer from working the hits out twice, for the
    # filter and again for the texts.
    found = payloads.where(_may_hit(active)).select(
        city_or_unknown(F.col("city")).alias("city"), "timestamp", F.explode(F.array(hits)).alias("hits")
    )
    return found.where(F.size("hits") > 0).select("city", "timestamp", F.transform("hits", alert).alias("alerts"))


def high_priority(alerts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Current alerts whose value is beyond the rule's priority threshold."""
    ranked = [rule for rule in rules if rule.priority_threshold is not None]
    urgent = [(F.col("alert_type") == rule.type) & (F.col("value") > rule.priority_threshold) for rule in ranked]
    return alerts.where(reduce(lambda a, b: a | b, urgent))


def digest(alerts: DataFrame) -> DataFrame:
    """The lines of the digest of urgent alerts, in city and time order.

    The digest has no bound on its length, so it stays a sorted set of lines; written as text, the
    files one after the other are the digest.
    """
    lines = alerts.select("city", "timestamp", "alert_type", "message")
    return order_rows(lines, "city", "timestamp", "alert_type")


def count_alerts(alerts: DataFrame, day: str | date | None = None) -> DataFrame:
    """Alerts per city and type, of one day or of all."""
    if day is not None:
        alerts = in_days(alerts, "timestamp", as_date(day), as_date(day))
    return alerts.groupBy("city", "alert_type").agg(F.count(F.lit(1)).alias("alert_count"))


def alert_counts(alerts: DataFrame, day: str | date | None = None) -> DataFrame:
    """The counts as a report: by city, most frequent type first."""
    return count_alerts(alerts, day).orderBy("city", F.desc("alert_count"), "alert_type")


def alert_summary(counts: DataFrame) -> DataFrame:
    """City and a map from alert type to count, as JSON. A city's list has one entry per alert type."""
    entries = F.sort_array(F.collect_list(F.struct((-F.col("alert_count")).alias("order"), "alert_type", "alert_count")))
    return counts.groupBy("city").agg(
        F.to_json(F.map_from_arrays(entries["alert_type"], entries["alert_count"])).alias("summary")
    )


def alert_totals(alerts: DataFrame) -> DataFrame:
    """Number of alerts and of cities with alerts."""
    return alerts.agg(F.count(F.lit(1)).alias("n_alerts"), F.countDistinct("city").alias("n_cities"))


def with_display_type(counts: DataFrame) -> DataFrame:
    return counts.withColumn("display_type", display_name(F.col("alert_type")))
