"""Where message streams come from and go to: Kafka on a cluster, files elsewhere."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Topic names.
WEATHER_TOPIC = "weather-data"
PROCESSED_TOPIC = "processed-weather"
ALERT_TOPIC = "weather-alerts"
BUNDLE_TOPIC = "weather.alerts"
# Days that each topic is kept.
TOPIC_RETENTION_DAYS = {WEATHER_TOPIC: 7, PROCESSED_TOPIC: 7, ALERT_TOPIC: 30}

MESSAGE_COLUMNS = "key STRING, value STRING"


@dataclass(frozen=True)
class Channel:
    """A topic (with servers) or a folder of key/value files.

    `options` go to the reader or writer as they are, such as maxOffsetsPerTrigger or
    maxFilesPerTrigger, which bound a micro-batch.
    """

    topic: str | None = None
    servers: str | None = None
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)


def stream_source(spark: SparkSession, channel: Channel, starting: str = "latest") -> DataFrame:
    """Stream of key and value. With Kafka a new query starts at `starting`, a restarted one at its checkpoint."""
    if channel.topic is not None:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", channel.servers)
            .option("subscribe", channel.topic)
            .option("startingOffsets", starting)
            .options(**channel.options)
        )
        return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))
    return spark.readStream.schema(MESSAGE_COLUMNS).options(**channel.options).json(channel.path)


def write_messages(messages: DataFrame, channel: Channel, mode: str = "append") -> None:
    """Publishes a batch of key and value; mode="overwrite" replaces a folder's messages, a topic is only added to."""
    if channel.topic is not None:
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", channel.servers)
            .option("topic", channel.topic)
            .options(**channel.options)
            .save()
        )
    else:
        messages.write.mode(mode).options(**channel.options).json(channel.path)


def stream_sink(messages: DataFrame, channel: Channel, checkpoint: str) -> StreamingQuery:
    """Publishes a stream of key and value, all that is there now; the checkpoint is the place to go on from."""
    writer = messages.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if channel.topic is not None:
        writer = (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", channel.servers)
            .option("topic", channel.topic)
        )
    else:
        writer = writer.format("json").option("path", channel.path)
    return writer.options(**channel.options).start()


def stream_to_parquet(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Adds a stream's rows to Parquet files, all that is there now."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
