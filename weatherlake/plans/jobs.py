"""The batch and streaming jobs: read landed files, compute, write results.

Each job parses its JSON once into Parquet under the output folder and takes everything else from
there, so a result never re-reads the many small files. Nothing is cached: a lost executor costs
the re-run of its tasks only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weatherlake import schemas
from weatherlake.functions.calendar import as_date
from weatherlake.operators import alerts, lookup, reshape, stats, wind
from weatherlake.operators.filters import in_month
from weatherlake.operators.lookup import WORLD_CITIES
from weatherlake.operators.rules import BASIC, MONITORED, Rule
from weatherlake.sources import daily, messages, raw, reports, tables, upkeep
from weatherlake.sources.versions import publish_version, version_path
from weatherlake.streaming import connect, weather


def _parsed(
    spark: SparkSession, snapshots: DataFrame, output_path: str, end: str | date, days: int = 0
) -> DataFrame | None:
    """The good records of the snapshots, parsed once; None if there are no snapshots at all.

    Other runs keep their days in the same folder, so only the days of this run are read back.
    """
    if snapshots.isEmpty():
        return None
    raw.compact_raw(snapshots, f"{output_path}/snapshots")
    good, rejected = raw.split_corrupt(raw.read_compacted(spark, f"{output_path}/snapshots", end, days))
    daily.write_parquet(rejected.select(schemas.CORRUPT, "extraction_date"), f"{output_path}/rejected")
    return good


def run_daily(spark: SparkSession, day: str, input_path: str, output_path: str) -> DataFrame | None:
    """One day's snapshots to the tables `current` and `city_stats`; None and no output without data."""
    good = _parsed(spark, raw.read_raw(spark, input_path, day), output_path, day)
    if good is None:
        return None
    daily.write_parquet(reshape.current_flat(good), f"{output_path}/current")
    current = spark.read.schema(schemas.CURRENT_FLAT).parquet(f"{output_path}/current")
    daily.write_parquet(stats.city_stats(current), f"{output_path}/city_stats")
    return spark.read.schema(schemas.CITY_STATS).parquet(f"{output_path}/city_stats")


def run_monthly(spark: SparkSession, month: str, input_path: str, output_path: str) -> DataFrame | None:
    """The month's daily_YYYYMMDD/city_stats to Parquet and CSV; None and no output without data."""
    days = daily.read_day_folders(spark, input_path, month)
    if days.isEmpty():
        return None
    monthly = stats.monthly_city_stats(days)
    daily.write_parquet(monthly, f"{output_path}/city_monthly_stats")
    written = spark.read.schema(monthly.schema).parquet(f"{output_path}/city_monthly_stats")
    daily.write_csv(written, f"{output_path}/city_monthly_summary")
    return written


def run_snapshot_stats(spark: SparkSession, day: str, input_path: str, output_path: str) -> DataFrame | None:
    """One day's snapshot figures into the daily data set, beside the other days; gives its profile.

    None and no output without data. Snapshots without one good record leave the day without figures, also those of an
    earlier run.
    """
    snapshots = raw.read_raw(spark, input_path, day)
    path = f"{output_path}/daily_weather_stats"
    if snapshots.isEmpty():
        return None
    good, _ = raw.split_corrupt(snapshots)
    if good.isEmpty():
        upkeep.drop_day(spark, path, day, "date")
        return None
    daily.write_daily(reshape.snapshot_stats(good), path, "date")
    written = daily.read_daily(spark, path, schema=schemas.SNAPSHOT_STATS)
    return stats.dataset_profile(written.where(F.col("date") == F.lit(as_date(day))), "date")


def run_monthly_report(spark: SparkSession, month: str, input_path: str, output_path: str) -> DataFrame | None:
    """The month's report from the daily data set, as CSV and as text; None and no output without data."""
    path = f"{input_path}/daily_weather_stats"
    snapshots = raw.or_empty(
        lambda: daily.read_daily(spark, path, schema=schemas.SNAPSHOT_STATS), spark, schemas.SNAPSHOT_STATS
    )
    if in_month(snapshots, "date", month).isEmpty():
        return None
    digits = month.replace("-", "")
    report = stats.monthly_report(snapshots, month).orderBy("city")
    daily.write_csv(report, f"{output_path}/monthly_weather_report_{digits}")
    lines = reports.monthly_text_lines(report, month)
    daily.write_text(lines, f"{output_path}/monthly_weather_summary_{digits}", "block")
    return report


def run_analysis(
    spark: SparkSession, end: str | date, input_path: str, output_path: str, days: int = 7,
    cities: Sequence[str] = tuple(city for city, *_ in WORLD_CITIES), top: int = 5, tables_prefix: str | None = "weather_",
) -> dict[str, DataFrame]:
    """The last days' hourly tables and the figures made from them, each replaced on its own.

    The pivots have a column for each of `cities`; the series are those of the `top` warmest cities. Each table is a name
    in the session's catalog, with the prefix, that always shows one whole run; without a prefix it is a folder only.
    """
    good = _parsed(spark, raw.read_raw_range(spark, input_path, end, days), output_path, end, days)
    if good is None:
        return {}

    def saved(name: str, df: DataFrame) -> DataFrame:
        path = f"{output_path}/{name}"
        if tables_prefix is None:
            version = publish_version(df, path)
        else:
            version = tables.replace_table(df, f"{tables_prefix}{name}", path)
        return spark.read.schema(df.schema).parquet(version_path(path, version))

    temperature = saved("temperature", reshape.hourly_temperature(good))
    precipitation = saved("precipitation", reshape.hourly_precipitation(good))
    winds = saved("wind", reshape.hourly_wind(good))
    figures = {
        "temperature_by_city": stats.temperature_by_city(temperature),
        "daily_temperature": stats.daily_temperature(temperature, "date"),
        "precipitation_by_city": stats.precipitation_by_city(precipitation),
        "daily_precipitation": stats.daily_precipitation(precipitation, "date"),
        "wind_by_city": stats.wind_by_city(winds, "wind_speed"),
        "wind_rose": wind.wind_rose(winds, speed="wind_speed", direction="wind_direction"),
        "temperature_pivot": reshape.pivot_by_city(temperature, cities, F.avg("temperature")),
        "precipitation_pivot": reshape.pivot_by_city(
            stats.daily_precipitation(precipitation, "date"), cities, F.max("total_precipitation")
        ),
        "top_temperature_series": lookup.series_of_top(temperature, F.avg("temperature"), top),
    }
    return {
        "temperature": temperature, "precipitation": precipitation, "wind": winds,
        **{name: saved(name, df) for name, df in figures.items()},
    }


def run_alerts(
    spark: SparkSession, day: str, input_path: str, output_path: str, rules: list[Rule] = MONITORED,
    channel: connect.Channel | None = None,
) -> DataFrame | None:
    """One day's payloads to alerts: alert table, bundle messages, digest of the urgent ones, summary.

    A run for the same day replaces its alerts, its messages in files, digest and summary. Alerts whose stamp is no time
    are set apart.
    """
    good = _parsed(spark, raw.read_raw(spark, input_path, day), output_path, day)
    if good is None:
        return None
    payloads = reshape.unify(good)
    found = alerts.detect(alerts.all_readings(payloads), rules)
    tables.write_alerts(found, f"{output_path}/alerts", day)
    daily.write_json(tables.unstamped(found), f"{output_path}/unstamped_alerts_{as_date(day)}")
    bundles = messages.bundle_messages(alerts.alert_bundle(payloads, rules))
    if channel is None:
        connect.write_messages(bundles, connect.Channel(path=f"{output_path}/messages/run_date={as_date(day)}"), "overwrite")
    else:
        connect.write_messages(bundles, channel)
    stored = tables.read_alerts(spark, f"{output_path}/alerts", run_day=day)
    daily.write_text(alerts.digest(alerts.high_priority(found, rules)), f"{output_path}/digest", "message")
    summary = alerts.alert_summary(alerts.count_alerts(stored))
    daily.write_json(summary, f"{output_path}/alert_summary_{as_date(day)}")
    return stored


def run_publish(
    spark: SparkSession, day: str, input_path: str, channel: connect.Channel, now: datetime | None = None
) -> None:
    """Publishes one day's payloads as city messages, and the statistics message on them; nothing without data.

    In a folder of messages a run for the same day replaces its messages; a topic gets them again.
    """
    stamp = F.lit((now or datetime.now()).isoformat())
    good, _ = raw.split_corrupt(raw.read_raw(spark, input_path, day))
    summary = stats.temperature_summary(reshape.current_flat(good)).where(F.col("avg_temp").isNotNull())
    envelopes = messages.weather_messages(good, stamp).unionByName(messages.statistics_message(summary, stamp))
    if envelopes.isEmpty():
        return
    if channel.path is not None:
        channel = replace(channel, path=f"{channel.path}/run_date={as_date(day)}")
    connect.write_messages(envelopes, channel, "overwrite")


def run_notification(spark: SparkSession, day: str, input_path: str, output_path: str, now: datetime | None = None) -> DataFrame:
    """The notification on one day's temperatures as a text file, or the notice that there are none."""
    good, _ = raw.split_corrupt(raw.read_raw(spark, input_path, day))
    summary = stats.temperature_summary(reshape.current_flat(good))
    text = reports.notification_text(summary, F.lit((now or datetime.now()).isoformat()).cast("timestamp_ntz"))
    daily.write_text(text, f"{output_path}/notification_{as_date(day)}", "message")
    return text


def run_processed_stream(
    spark: SparkSession, source: connect.Channel, sink: connect.Channel, checkpoint: str
) -> StreamingQuery:
    """Drains the weather topic into flat observations on the topic of processed ones."""
    stream = connect.stream_source(spark, source)
    return connect.stream_sink(weather.processed_messages(stream), sink, checkpoint)


def run_rule_alert_stream(
    spark: SparkSession, source: connect.Channel, rules_path: str, path: str, checkpoint: str, profile: str | None = None
) -> StreamingQuery:
    """Drains the weather topic into alerts by a stored rule table, read again for each micro-batch."""
    return weather.update_rule_alerts(connect.stream_source(spark, source), rules_path, path, checkpoint, profile)


def run_retention(spark: SparkSession, path: str, as_of: str | date, days: int, day: str = "obs_date") -> list[str]:
    """Deletes day folders that are too old; their names."""
    return upkeep.drop_days(spark, path, as_of, days, day)


def run_erasure(spark: SparkSession, path: str, ids_path: str, key: str, schema: str | None = None, day: str = "obs_date") -> list[str]:
    """Removes the identifiers of a CSV file with a header from a stored data set; the files that were written again."""
    erased = spark.read.option("header", True).csv(ids_path)
    schema = schema or spark.read.parquet(path).schema.toDDL()
    kind = T.StructType.fromDDL(schema)[key].dataType
    return upkeep.erase_stored(spark, path, erased.select(F.col(key).cast(kind).alias(key)), key, schema, day)


def run_alert_stream(
    spark: SparkSession, source: connect.Channel, sink: connect.Channel, checkpoint: str, rules: list[Rule] = BASIC
) -> StreamingQuery:
    """Drains the weather topic into the alert topic; the next run goes on where this one ended."""
    stream = connect.stream_source(spark, source)
    return connect.stream_sink(weather.alert_message_stream(stream, rules), sink, checkpoint)
