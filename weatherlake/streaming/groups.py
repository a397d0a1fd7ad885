"""Consumer groups over a file channel, with their resume points as a table.

A group's batch is planned first: the files that it will read are written down. Then it is handled, and then marked as
done. A run that broke off is repeated with the same files and the same number, so a handler that replaces what it wrote for
a number before has no message twice and misses none. On a topic, Spark's checkpoint keeps the same thing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherlake.sources.folders import Folder
from weatherlake.streaming.connect import MESSAGE_COLUMNS, Channel

PLANNED = "group_name STRING, batch LONG, file STRING, skipped BOOLEAN"
Handler = Callable[[DataFrame, int], None]


def _group(spark: SparkSession, offsets: str, group: str) -> Folder:
    if not group or "/" in group or group.startswith(("_", ".")):
        raise ValueError(f"{group!r} is no name for a group")
    return Folder(spark, f"{offsets.rstrip('/')}/group={group}")


def positions(spark: SparkSession, offsets: str, group: str) -> DataFrame:
    """The group's resume point: group_name, batch, file, skipped (there before the group began at "latest")."""
    planned = _group(spark, offsets, group).numbered("batch")
    if not planned:
        return spark.createDataFrame([], PLANNED)
    return spark.read.schema(PLANNED).parquet(*planned.values())


def _plan(spark: SparkSession, folder: Folder, group: str, batch: int, files: list[str], skipped: bool) -> None:
    rows = spark.createDataFrame([(file,) for file in files], "file STRING")
    rows = rows.select(F.lit(group).alias("group_name"), F.lit(batch).cast("long").alias("batch"), "file", F.lit(skipped).alias("skipped"))
    rows.write.mode("overwrite").parquet(f"{folder.path}/batch={batch}")


def drain(
    spark: SparkSession, channel: Channel, group: str, offsets: str, handle: Handler, starting: str = "earliest", max_files: int | None = None
) -> int:
    """Hands the group the messages that it has not had, all that are there now; returns the number of batches.

    `handle` gets the messages (key, value) of a batch and its number, and must replace what it did for that number before. A
    new group begins with all messages, or with `starting="latest"` after those that are there. `max_files` bounds a
    batch. A group must be drained by one process at a time; groups do not affect each other.
    """
    if channel.path is None:
        raise ValueError("groups are for folders of messages; a topic's groups are kept by the checkpoint of a stream")
    if starting not in ("earliest", "latest"):
        raise ValueError(f"starting must be earliest or latest, not {starting!r}")
    folder, messages = _group(spark, offsets, group), Folder(spark, channel.path)

    def read(files: list[str]) -> DataFrame:
        if not files:
            return spark.createDataFrame([], MESSAGE_COLUMNS)
        return spark.read.schema(MESSAGE_COLUMNS).json([f"{messages.path}/{file}" for file in files])

    def finish(batch: int, files: list[str]) -> None:
        handle(read(files), batch)
        folder.write(f"done-{batch}", "")

    planned = sorted(folder.numbered("batch"))
    handled = 0
    # Only the last batch can be open, as the next is planned when it is done.
    if planned and not folder.has(f"done-{planned[-1]}"):
        own = positions(spark, offsets, group).where(F.col("batch") == planned[-1]).collect()
        if not all(row.skipped for row in own):
            finish(planned[-1], sorted(row.file for row in own))
            handled = 1
        else:
            folder.write(f"done-{planned[-1]}", "")
    now = messages.data_files()
    if not planned and starting == "latest":
        _plan(spark, folder, group, 0, now, True)
        folder.write("done-0", "")
        return 0
    seen = {row.file for row in positions(spark, offsets, group).select("file").collect()}
    new = [file for file in now if file not in seen]
    batch = planned[-1] + 1 if planned else 0
    step = max_files or max(len(new), 1)
    for first in range(0, len(new), step):
        files = new[first : first + step]
        _plan(spark, folder, group, batch, files, False)
        finish(batch, files)
        batch, handled = batch + 1, handled + 1
    return handled
