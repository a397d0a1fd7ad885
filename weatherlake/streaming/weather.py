"""Streaming forms of the operators: the batch functions on a streaming frame, and the hourly throughput."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weatherlake.functions.text import city_or_unknown
from weatherlake.operators.alerts import detect, detect_by_table
from weatherlake.operators.filters import with_current
from weatherlake.operators.rules import BASIC, Rule
from weatherlake.sources.messages import JSON_OPTIONS, alert_messages, decode
from weatherlake.sources.tables import read_rules
from weatherlake.sources.versions import latest_version
from weatherlake.streaming.batches import batch_path, compact_batches, read_batches

# A message is late from this many seconds on.
LATENCY_LIMIT_SECONDS = 5

THROUGHPUT_PARTS = "window_start TIMESTAMP, messages LONG, micros DECIMAL(38,0), with_delay LONG"


def current_stream(messages: DataFrame) -> DataFrame:
    """Messages to flat current observations."""
    return with_current(decode(messages)).select(
        city_or_unknown(F.col("city")).alias("city"),
        "coordinates.latitude",
        "coordinates.longitude",
        "current_weather.*",
    )


def alert_readings(messages: DataFrame) -> DataFrame:
    """Messages to readings with the stamp and place of the message."""
    return with_current(decode(messages)).select(
        "timestamp",
        city_or_unknown(F.col("city")).alias("city"),
        "coordinates",
        "current_weather.temperature",
        "current_weather.windspeed",
    )


def alert_stream(messages: DataFrame, rules: Sequence[Rule] = BASIC) -> DataFrame:
    """Messages to alerts. Stateless: every message is tested on its own."""
    return detect(alert_readings(messages), rules)


def alert_message_stream(messages: DataFrame, rules: Sequence[Rule] = BASIC) -> DataFrame:
    """Messages to alert messages, one per alert, ready for a sink."""
    return alert_messages(alert_stream(messages, rules))


def update_rule_alerts(
    messages: DataFrame, rules_path: str, path: str, checkpoint: str, profile: str | None = None
) -> StreamingQuery:
    """Alert messages by a rule table that is read again for each micro-batch, all that is there now.

    A micro-batch uses the version of the table that is the newest when it begins, and notes it in `rules_version`
    (null without any table, which gives no alerts). It writes a folder of its own, which a repeated one replaces.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = latest_version(spark, rules_path)
        rules = read_rules(spark, rules_path, profile, version)
        found = alert_messages(detect_by_table(alert_readings(batch), rules))
        noted = found.withColumn("rules_version", F.lit(version).cast("int"))
        noted.write.mode("overwrite").parquet(batch_path(path, batch_id))

    return (
        messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save).trigger(availableNow=True).start()
    )


def read_rule_alerts(spark: SparkSession, path: str) -> DataFrame:
    """key, value and rules_version of all alert messages."""
    return read_batches(spark, path, "key STRING, value STRING, rules_version INT")


def delays(messages: DataFrame) -> DataFrame:
    """Stamp of each city message, and its delay after the observation in microseconds.

    A message without a readable stamp has null there; it is counted in a window of its own, null.
    """
    stamped = with_current(decode(messages)).select(
        F.col("timestamp").try_cast("timestamp").alias("ts"),
        F.col("current_weather.time").try_cast("timestamp").alias("observed"),
    )
    return stamped.select("ts", (F.unix_micros("ts") - F.unix_micros("observed")).alias("micros"))


def throughput_parts(rows: DataFrame, seconds: int = 3600) -> DataFrame:
    """Counts and sums per window of the stamp, ready to be added to those of other rows."""
    start = F.timestamp_seconds(F.floor(F.unix_micros("ts") / (1_000_000 * seconds)) * seconds)
    return rows.groupBy(start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.col("micros").cast("decimal(38,0)")).alias("micros"),
        F.count("micros").alias("with_delay"),
    )


def update_throughput(messages: DataFrame, path: str, checkpoint: str, seconds: int = 3600) -> StreamingQuery:
    """Keeps the parts of each micro-batch in a folder of its own, all that is there now.

    A micro-batch is aggregated alone, so the query holds no state, no message is too late for it, and the parts add
    up to the same whatever the cut into micro-batches and the order. A micro-batch that is run again replaces
    its own folder, so a restart adds nothing twice.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        throughput_parts(batch, seconds).write.mode("overwrite").parquet(batch_path(path, batch_id))

    return (
        delays(messages).writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(save)
        .trigger(availableNow=True)
        .start()
    )


def read_throughput(spark: SparkSession, path: str) -> DataFrame:
    """Messages per window, and the mean delay between observation and stamp in seconds: the sum of all parts."""
    parts = read_batches(spark, path, THROUGHPUT_PARTS)
    mean = F.sum("micros").cast("double") / F.nullif(F.sum("with_delay"), F.lit(0)) / 1e6
    summed = parts.groupBy("window_start").agg(F.sum("messages").alias("messages"), mean.alias("mean_delay_seconds"))
    return summed.withColumn("is_slow", F.col("mean_delay_seconds") > LATENCY_LIMIT_SECONDS)


def compact_throughput(spark: SparkSession, path: str) -> int | None:
    """Adds up the parts of all micro-batches so far, one row a window, so that reading does not grow with the batches."""

    def fold(parts: DataFrame) -> DataFrame:
        sums = [F.sum(name).cast(kind).alias(name) for name, kind in (("messages", "long"), ("micros", "decimal(38,0)"), ("with_delay", "long"))]
        return parts.groupBy("window_start").agg(*sums)

    return compact_batches(spark, path, THROUGHPUT_PARTS, fold)


def processed_messages(messages: DataFrame) -> DataFrame:
    """Messages to messages of their flat current observation, keyed by city."""
    flat = current_stream(messages)
    return flat.select(F.col("city").alias("key"), F.to_json(F.struct(*flat.columns), JSON_OPTIONS).alias("value"))
