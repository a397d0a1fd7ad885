"""Throughput by event time: tumbling windows in the state store, closed by a watermark, and the rows that came too late.

Rows are dealt over buckets. A bucket's state holds its open windows; each micro-batch gives the new totals of the windows that it
changed, and as rows of their own those whose window the watermark had passed before. So at any moment the last total of each
window and the late rows are all rows, whatever the cut into micro-batches; only which rows are late depends on it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weatherlake.functions.text import city_or_unknown
from weatherlake.operators.filters import with_current
from weatherlake.sources.messages import decode
from weatherlake.streaming.batches import batch_path, compact_batches, read_batches

BUCKETS = 64
PARTITIONS = "spark.sql.shuffle.partitions"
# The window of rows whose stamp is no time; the watermark never passes it.
NO_TIME = 2**62
# Sums are carried in two halves, so that no sum of a micro-batch overflows.
HALF = 20

EMITTED = "kind STRING, bucket INT, start LONG, messages LONG, micros STRING, with_delay LONG, city STRING, ts_micros LONG"
# `open` is the total of a window in a bucket after a micro-batch, `late` a row that came too late.
STORED = (
    "bucket INT, window_start TIMESTAMP, messages LONG, micros DECIMAL(38,0), with_delay LONG, city STRING, ts TIMESTAMP, "
    "batch LONG, kind STRING"
)


def stamped_rows(messages: DataFrame, seconds: int, buckets: int) -> DataFrame:
    """bucket, city, ts, its window's start in seconds, the delay in microseconds and whether there is one."""
    rows = with_current(decode(messages)).select(
        city_or_unknown(F.col("city")).alias("city"),
        F.col("timestamp").try_cast("timestamp").alias("ts"),
        F.col("current_weather.time").try_cast("timestamp").alias("observed"),
    )
    micros = F.unix_micros("ts") - F.unix_micros("observed")
    start = F.floor(F.unix_micros("ts") / (1_000_000 * seconds)) * seconds
    return rows.select(
        F.pmod(F.xxhash64("city", "ts", "observed"), F.lit(buckets)).cast("int").alias("bucket"),
        "city",
        "ts",
        F.coalesce(F.unix_micros("ts"), F.lit(0)).alias("ts_micros"),
        F.coalesce(start, F.lit(NO_TIME)).alias("start"),
        F.coalesce(micros, F.lit(0)).alias("micros"),
        micros.isNotNull().cast("int").alias("with_delay"),
    )


def _folder(seconds: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """What a bucket does with the rows of a micro-batch; the state is the open windows' totals by start, as JSON."""

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (bucket,) = key
        windows: dict[str, list[int]] = json.loads(state.get[0]) if state.exists else {}
        watermark = state.getCurrentWatermarkMs() if state.getCurrentWatermarkMs() > 0 else -NO_TIME
        changed = set()
        for frame in frames:
            is_late = (frame["start"] < NO_TIME) & ((frame["start"] + seconds) * 1000 <= watermark)
            late = frame[is_late]
            if len(late):
                yield pd.DataFrame({
                    "kind": "late", "bucket": bucket, "start": late["start"], "messages": 1,
                    "micros": late["micros"].astype(str), "with_delay": late["with_delay"], "city": late["city"],
                    "ts_micros": late["ts_micros"],
                })
            kept = frame[~is_late]
            halves = kept.assign(high=kept["micros"] // (1 << HALF), low=kept["micros"] % (1 << HALF), messages=1)
            sums = halves.groupby("start")[["messages", "high", "low", "with_delay"]].sum()
            for start, messages, high, low, with_delay in sums.itertuples():
                before = windows.get(str(start), [0, 0, 0])
                own = (messages, (int(high) << HALF) + int(low), with_delay)
                windows[str(start)] = [a + int(b) for a, b in zip(before, own)]
                changed.add(str(start))
        if changed:
            rows = [("open", bucket, int(s), windows[s][0], str(windows[s][1]), windows[s][2], None, 0) for s in sorted(changed)]
            yield pd.DataFrame(rows, columns=[part.split()[0] for part in EMITTED.split(", ")])
        still_open = {s: total for s, total in windows.items() if int(s) == NO_TIME or (int(s) + seconds) * 1000 > watermark}
        state.update((json.dumps(still_open),))

    return fold


def update_windows(
    messages: DataFrame, path: str, checkpoint: str, delay: str = "1 hour", seconds: int = 3600, buckets: int = BUCKETS
) -> StreamingQuery:
    """Counts a stream's messages by window, all that is there now, with a folder for each micro-batch.

    A window is open until a message is more than `delay` after its end. Closed windows leave the state, so what it holds
    is bounded by the windows that can be open at a time. `buckets` bounds the tasks that work on one window. The state has
    twice as many partitions as buckets, as each costs time in every micro-batch; a checkpoint keeps its number.
    """
    rows = stamped_rows(messages, seconds, buckets).withWatermark("ts", delay)
    folded = rows.groupBy("bucket").applyInPandasWithState(
        _folder(seconds), EMITTED, "windows STRING", "update", GroupStateTimeout.NoTimeout
    )
    known = F.col("start") < NO_TIME
    shaped = folded.select(
        "bucket",
        F.when(known, F.timestamp_seconds("start")).alias("window_start"),
        "messages",
        F.col("micros").cast("decimal(38,0)").alias("micros"),
        "with_delay",
        "city",
        F.when(F.col("kind") == "late", F.timestamp_micros("ts_micros")).alias("ts"),
        "kind",
    )

    def save(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        numbered.write.mode("overwrite").parquet(batch_path(path, batch_id))

    writer = shaped.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save)
    conf = messages.sparkSession.conf
    before = conf.get(PARTITIONS)
    conf.set(PARTITIONS, 2 * buckets)
    try:
        return writer.trigger(availableNow=True).start()  # with the settings of now
    finally:
        conf.set(PARTITIONS, before)


def _latest(stored: DataFrame) -> DataFrame:
    """The last total of each window in each bucket."""
    total = F.max_by(F.struct("messages", "micros", "with_delay"), "batch").alias("total")
    last = stored.where("kind = 'open'").groupBy("bucket", "window_start").agg(total, F.max("batch").alias("batch"))
    return last.select("bucket", "window_start", "total.*", "batch")


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """window_start, messages, micros, with_delay: what was counted in time."""
    latest = _latest(read_batches(spark, path, STORED))
    return latest.groupBy("window_start").agg(*[F.sum(name).alias(name) for name in ("messages", "micros", "with_delay")])


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came after their window had closed: city, ts, window_start, micros, with_delay, batch."""
    late = read_batches(spark, path, STORED).where("kind = 'late'")
    return late.select("city", "ts", "window_start", "micros", "with_delay", "batch")


def corrected_windows(spark: SparkSession, path: str) -> DataFrame:
    """window_start, messages, n_late and the mean delay in seconds over all messages, late ones too."""
    late = read_late(spark, path).withColumns({"messages": F.lit(1).cast("long"), "n_late": F.lit(1).cast("long")})
    names = ("window_start", "messages", "micros", "with_delay", "n_late")
    both = read_windows(spark, path).withColumn("n_late", F.lit(0).cast("long")).select(*names).unionByName(late.select(*names))
    mean = F.sum("micros").cast("double") / F.nullif(F.sum("with_delay"), F.lit(0)) / 1e6
    return both.groupBy("window_start").agg(
        F.sum("messages").alias("messages"), F.sum("n_late").alias("n_late"), mean.alias("mean_delay_seconds")
    )


def compact_windows(spark: SparkSession, path: str) -> int | None:
    """Keeps the last total of each window in each bucket and the late rows, in one folder."""

    def fold(stored: DataFrame) -> DataFrame:
        latest = _latest(stored).withColumn("kind", F.lit("open"))
        return latest.unionByName(stored.where("kind = 'late'"), allowMissingColumns=True)

    return compact_batches(spark, path, STORED, fold)
