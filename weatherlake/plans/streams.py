"""Streaming queries: the observations as messages in files, run to the end, result read back as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherlake import schemas
from weatherlake.functions.calendar import iso_minute
from weatherlake.operators.lookup import WORLD_CITIES, city_frame, city_lookup
from weatherlake.operators.rules import BASIC, EXTREME, rule_frame
from weatherlake.plans.alerting import alert_sql
from weatherlake.plans.bindings import CITY_TABLE, OBS, obs
from weatherlake.plans.catalog import query
from weatherlake.session import scratch_path
from weatherlake.sources import tables
from weatherlake.sources.messages import decode, weather_messages
from weatherlake.streaming import connect, groups, weather, windows


# Micro-batches have a bound, which all executors share. A micro-batch has a fixed cost whatever it holds, so the bound is as
# high as tasks of one file each allow.
FILE_MESSAGES = "100000"
BATCH_BYTES = str(1 << 30)
BATCH_FILES = 32


def observation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message per observation, and the observation's id."""
    located = city_lookup(obs(spark, sf_dir), city_frame(spark, WORLD_CITIES), "left")
    return located.select(
        "event_id", "city", "latitude", "longitude", "ts",
        F.struct("temperature", "windspeed", "winddirection", "weathercode", iso_minute(F.col("ts")).alias("time"))
        .alias("current_weather"),
    )


def publish(payload: DataFrame, path: str) -> None:
    """Writes the messages of the payloads as files."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    channel = connect.Channel(path=path, options={"maxRecordsPerFile": FILE_MESSAGES})
    connect.write_messages(weather_messages(payload, stamp), channel)


def open_stream(spark: SparkSession, path: str) -> DataFrame:
    return connect.stream_source(spark, connect.Channel(path=path, options={"maxBytesPerTrigger": BATCH_BYTES}))


def publish_observations(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, str]:
    """All messages as files; gives the stream over them and a folder for the results."""
    path = scratch_path(spark, name)
    publish(observation_messages(spark, sf_dir), f"{path}/messages")
    return open_stream(spark, f"{path}/messages"), path


def halves(payload: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The messages in two deliveries, each over all times."""
    return payload.where("event_id % 2 = 0"), payload.where("event_id % 2 = 1")


@query("stream_current", f"""WITH {OBS}, {CITY_TABLE} SELECT city, latitude, longitude, temperature, windspeed,
  winddirection, weathercode, strftime(ts, '%Y-%m-%dT%H:%M') AS time FROM obs LEFT JOIN cities USING (city)""")
def stream_current(spark, sf_dir):
    stream, path = publish_observations(spark, sf_dir, "stream_current")
    connect.stream_to_parquet(weather.current_stream(stream), f"{path}/current", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(schemas.CURRENT_FLAT).parquet(f"{path}/current")


@query("stream_alerts", f"""WITH {OBS}, {CITY_TABLE}, alerts AS ({alert_sql('obs', 'city, ts', BASIC)})
SELECT city, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, latitude, longitude, alert_type, value, threshold, message
FROM alerts LEFT JOIN cities USING (city)""")
def stream_alerts(spark, sf_dir):
    stream, path = publish_observations(spark, sf_dir, "stream_alerts")
    sink = connect.Channel(path=f"{path}/alerts")
    connect.stream_sink(weather.alert_message_stream(stream), sink, f"{path}/checkpoint").awaitTermination()
    published = spark.read.schema(connect.MESSAGE_COLUMNS).json(f"{path}/alerts")
    return decode(published, schemas.ALERT_MESSAGE).select(
        "city", "timestamp", "coordinates.latitude", "coordinates.longitude",
        F.col("alert.type").alias("alert_type"), "alert.value", "alert.threshold", "alert.message",
    )


@query("stream_throughput", f"""WITH {OBS}, delays AS (
  SELECT date_trunc('hour', ts) AS h, epoch_us(ts) - epoch_us(date_trunc('minute', ts)) AS micros FROM obs),
windows AS (SELECT h, count(*) AS messages, avg(micros) / 1000000::DOUBLE AS mean_delay_seconds FROM delays GROUP BY h)
SELECT strftime(h, '%Y-%m-%d %H:%M:%S.%f') AS window_start, messages, mean_delay_seconds,
  mean_delay_seconds > 5 AS is_slow FROM windows""")
def stream_throughput(spark, sf_dir):
    stream, path = publish_observations(spark, sf_dir, "stream_throughput")
    weather.update_throughput(stream, f"{path}/windows", f"{path}/checkpoint").awaitTermination()
    return weather.read_throughput(spark, f"{path}/windows")


@query("stream_windows", f"""WITH {OBS}, delays AS (
  SELECT date_trunc('hour', ts) AS h, epoch_us(ts) - epoch_us(date_trunc('minute', ts)) AS micros FROM obs)
SELECT strftime(h, '%Y-%m-%d %H:%M:%S.%f') AS window_start, count(*) AS messages,
  avg(micros) / 1000000::DOUBLE AS mean_delay_seconds FROM delays GROUP BY h""")
def stream_windows(spark, sf_dir):
    """The second delivery is late for nearly all windows; counted and late rows are all rows."""
    path = scratch_path(spark, "stream_windows")
    for half in halves(observation_messages(spark, sf_dir)):
        publish(half, f"{path}/messages")
        stream = open_stream(spark, f"{path}/messages")
        windows.update_windows(stream, f"{path}/windows", f"{path}/checkpoint", delay="1 day", buckets=8).awaitTermination()
    windows.compact_windows(spark, f"{path}/windows")
    return windows.corrected_windows(spark, f"{path}/windows").select("window_start", "messages", "mean_delay_seconds")


LATER_RULES = [rule for rule in EXTREME if rule.metric in ("temperature", "windspeed")]


@query("stream_rule_alerts", f"""WITH {OBS}, {CITY_TABLE}, early AS (SELECT * FROM obs WHERE event_id % 2 = 0),
later AS (SELECT * FROM obs WHERE event_id % 2 = 1),
alerts AS (SELECT *, 1 AS rules_version FROM ({alert_sql('early', 'city, ts', BASIC)})
  UNION ALL SELECT *, 2 FROM ({alert_sql('later', 'city, ts', LATER_RULES)}))
SELECT city, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, latitude, longitude, alert_type, value, threshold, message,
  CAST(rules_version AS INTEGER) AS rules_version FROM alerts LEFT JOIN cities USING (city)""")
def stream_rule_alerts(spark, sf_dir):
    """The rule table is replaced between two deliveries."""
    path = scratch_path(spark, "stream_rule_alerts")
    for half, rules in zip(halves(observation_messages(spark, sf_dir)), (BASIC, EXTREME)):
        publish(half, f"{path}/messages")
        tables.publish_rules(rule_frame(spark, rules), f"{path}/rules")
        stream = open_stream(spark, f"{path}/messages")
        weather.update_rule_alerts(stream, f"{path}/rules", f"{path}/alerts", f"{path}/checkpoint").awaitTermination()
    found = weather.read_rule_alerts(spark, f"{path}/alerts")
    decoded = found.select(F.from_json("value", schemas.ALERT_MESSAGE).alias("m"), "rules_version")
    return decoded.select(
        "m.city", "m.timestamp", "m.coordinates.latitude", "m.coordinates.longitude",
        F.col("m.alert.type").alias("alert_type"), "m.alert.value", "m.alert.threshold", "m.alert.message", "rules_version",
    )


@query("stream_groups", f"""WITH {OBS}, rows AS (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp FROM obs)
SELECT 'all' AS consumer, city, timestamp, temperature FROM rows
UNION ALL SELECT 'new' AS consumer, city, timestamp, temperature FROM rows WHERE event_id % 2 = 1""")
def stream_groups(spark, sf_dir):
    """One group from the beginning, one from the latest message after the first delivery."""
    path = scratch_path(spark, "stream_groups")
    channel = connect.Channel(path=f"{path}/messages")

    def drain(group: str, starting: str) -> None:
        def save(batch: DataFrame, number: int) -> None:
            decode(batch).select(F.lit(group).alias("consumer"), "city", "timestamp", "current_weather.temperature").write.mode(
                "overwrite"
            ).parquet(f"{path}/out/{group}-{number}")

        groups.drain(spark, channel, group, f"{path}/offsets", save, starting, max_files=BATCH_FILES)

    for half in halves(observation_messages(spark, sf_dir)):
        publish(half, channel.path)
        drain("all", "earliest")
        drain("new", "latest")  # its first call only notes where it begins
    return spark.read.schema("consumer STRING, city STRING, timestamp STRING, temperature DOUBLE").parquet(f"{path}/out/*")
