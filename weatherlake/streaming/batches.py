"""Results of a stream kept as a folder for each micro-batch, and their compaction.

A micro-batch that is run again replaces its own folder. Compaction folds the folders up to a batch into one named after that
batch, which counts once it is complete; what it covers is passed over from then on, also if a covered batch is written
again, and deleted by the next compaction, so that readers that have begun can end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weatherlake.sources.folders import Folder

BATCH, UPTO = "batch", "upto"


def batch_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{BATCH}={batch_id}"


def _current(folder: Folder) -> tuple[int, list[str]]:
    """The last compacted batch (-1 without one), and the folders that hold all results."""
    compacted = folder.numbered(UPTO)
    last = max(compacted, default=-1)
    later = [path for number, path in sorted(folder.numbered(BATCH).items()) if number > last]
    return last, ([compacted[last]] if compacted else []) + later


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The results of all micro-batches; an empty frame if there are none."""
    _, paths = _current(Folder(spark, path))
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def compact_batches(spark: SparkSession, path: str, schema: str, fold: Callable[[DataFrame], DataFrame]) -> int | None:
    """Folds all results into one folder; returns the last batch in it, or None if nothing new is there.

    Reading what `fold` returns must give what reading its input does. A run that breaks off changes nothing that is
    read; there must be one compaction of a folder at a time.
    """
    folder = Folder(spark, path)
    last, paths = _current(folder)
    newest = max(folder.numbered(BATCH), default=-1)
    if newest <= last or not paths:
        return None
    folded = fold(spark.read.schema(schema).parquet(*paths))
    folded.write.mode("overwrite").parquet(f"{folder.path}/{UPTO}={newest}")
    for label, covered in ((BATCH, last), (UPTO, last - 1)):
        for number in folder.numbered(label):
            if number <= covered:
                folder.delete(f"{label}={number}")
    return newest
