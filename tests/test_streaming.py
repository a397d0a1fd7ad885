"""Streams give what the batch functions give, and go on where they ended."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from weatherlake.operators.lookup import WORLD_CITIES, city_frame, city_lookup
from weatherlake.plans import streams
from weatherlake.sources.messages import statistics_message, weather_messages
from weatherlake.streaming import connect, weather

SCHEMA = "city STRING, ts TIMESTAMP_NTZ, temperature DOUBLE, windspeed DOUBLE"


def publish(spark, channel, rows):
    payload = city_lookup(spark.createDataFrame(rows, SCHEMA), city_frame(spark, WORLD_CITIES), "left").withColumn(
        "current_weather",
        F.struct("temperature", "windspeed", F.lit(180.0).alias("winddirection"), F.lit(3).alias("weathercode"),
                 F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time")),
    )
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    summary = payload.agg(F.avg("temperature").alias("avg_temp"), F.min("temperature").alias("min_temp"),
                          F.max("temperature").alias("max_temp"))
    messages = weather_messages(payload, stamp).unionByName(statistics_message(summary, F.lit("2025-01-01T00:00:00")))
    connect.write_messages(messages, channel)


def rows(first, n):
    start = datetime(2025, 9, 24)
    return [("Paris" if i % 2 else "Tokyo", start + timedelta(minutes=20 * i, seconds=10 * (i % 3)),
             float(i * 7 % 60 - 15), float(i * 13 % 100)) for i in range(first, first + n)]


def test_alert_stream_equals_batch_and_resumes(spark, tmp_path):
    source = connect.Channel(path=str(tmp_path / "in"))
    sink = connect.Channel(path=str(tmp_path / "out"))
    checkpoint = str(tmp_path / "checkpoint")

    def drain():
        stream = connect.stream_source(spark, source)
        connect.stream_sink(weather.alert_message_stream(stream), sink, checkpoint).awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema(connect.MESSAGE_COLUMNS).json(sink.path).collect())

    def batch():
        landed = spark.read.schema(connect.MESSAGE_COLUMNS).json(source.path)
        return sorted(tuple(r) for r in weather.alert_message_stream(landed).collect())

    publish(spark, source, rows(0, 40))
    first = drain()
    assert first == batch() and first
    assert drain() == first
    publish(spark, source, rows(40, 30))
    second = drain()
    assert second == batch() and len(second) > len(first)


def test_current_stream_leaves_out_statistics(spark, tmp_path):
    source = connect.Channel(path=str(tmp_path / "in"), options={})
    publish(spark, source, rows(0, 12))
    stream = weather.current_stream(connect.stream_source(spark, source))
    connect.stream_to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    result = spark.read.parquet(str(tmp_path / "out"))
    assert result.count() == 12
    assert result.where("city = 'Paris'").select("latitude", "longitude").distinct().collect() == [(48.85, 2.35)]


def test_throughput_over_two_runs_counts_every_message_once(spark, tmp_path):
    source = connect.Channel(path=str(tmp_path / "in"))

    def drain():
        stream = connect.stream_source(spark, source)
        weather.update_throughput(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        table = weather.read_throughput(spark, str(tmp_path / "out"))
        return {r.window_start.strftime("%d %H"): (r.messages, r.mean_delay_seconds, r.is_slow) for r in table.collect()}

    publish(spark, source, rows(0, 5))
    assert drain() == {"24 00": (3, 10.0, True), "24 01": (2, 5.0, False)}
    publish(spark, source, rows(5, 4))
    assert drain() == {"24 00": (3, 10.0, True), "24 01": (3, 10.0, True), "24 02": (3, 10.0, True)}


def test_throughput_counts_all_messages_newest_first_and_one_file_at_a_time(spark, tmp_path):
    for first in (20, 10, 0):
        publish(spark, connect.Channel(path=str(tmp_path / "in")), rows(first, 10))
    found = []
    for name, options in (("one", {}), ("many", {"maxFilesPerTrigger": "1"})):
        stream = connect.stream_source(spark, connect.Channel(path=str(tmp_path / "in"), options=options))
        out = str(tmp_path / name)
        weather.update_throughput(stream, out, f"{out}-checkpoint").awaitTermination()
        found.append(sorted(map(str, weather.read_throughput(spark, out).collect())))
    assert found[0] == found[1]
    assert weather.read_throughput(spark, str(tmp_path / "many")).groupBy().sum("messages").first()[0] == 30


def test_processed_messages_are_flat(spark, tmp_path):
    source, sink = (connect.Channel(path=str(tmp_path / name)) for name in ("in", "out"))
    publish(spark, source, rows(0, 6))
    stream = weather.processed_messages(connect.stream_source(spark, source))
    connect.stream_sink(stream, sink, str(tmp_path / "checkpoint")).awaitTermination()
    published = spark.read.schema(connect.MESSAGE_COLUMNS).json(sink.path)
    assert published.count() == 6 and "temperature" in published.first().value


def test_two_batches_equal_one(spark, tmp_path):
    """The same files one per micro-batch and all at once."""
    source = connect.Channel(path=str(tmp_path / "in"))
    for first in range(0, 30, 10):
        publish(spark, source, rows(first, 10))
    results = []
    for name, options in (("one", {}), ("many", {"maxFilesPerTrigger": "1"})):
        stream = weather.current_stream(connect.stream_source(spark, connect.Channel(path=source.path, options=options)))
        out = str(tmp_path / name)
        connect.stream_to_parquet(stream, out, f"{out}-checkpoint").awaitTermination()
        results.append(sorted(map(str, spark.read.parquet(out).collect())))
    assert results[0] == results[1] and len(results[0]) == 30


def test_micro_batches_are_cut_by_bytes_not_by_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "in")
    payload = spark.createDataFrame(rows(0, 24), SCHEMA).repartition(12)
    messages = payload.select(F.col("city").alias("key"), F.to_json(F.struct("city", "temperature")).alias("value"))
    connect.write_messages(messages, connect.Channel(path=path, options={"maxRecordsPerFile": "1"}))

    def batches(name):
        out = str(tmp_path / name)
        run = connect.stream_to_parquet(streams.open_stream(spark, path), out, f"{out}-checkpoint")
        run.awaitTermination()
        assert spark.read.parquet(out).count() == 24
        return sum(progress["numInputRows"] > 0 for progress in run.recentProgress)

    assert batches("one") == 1
    monkeypatch.setattr(streams, "BATCH_BYTES", "600")
    assert batches("many") > 1
