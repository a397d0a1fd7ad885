"""Retention and erasure of stored data: day folders that are too old, and rows of listed identifiers."""

from __future__ import annotations

import json
import uuid
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherlake.functions.calendar import as_date, days_back
from weatherlake.operators.filters import erase
from weatherlake.sources.folders import Folder
from weatherlake.sources.raw import or_empty

STAGED = "_erasure-"
COMMIT = "commit"


def drop_days(spark: SparkSession, path: str, as_of: str | date, days: int, day: str = "obs_date") -> list[str]:
    """Deletes the day folders older than `days` days before `as_of` and returns their names.

    Only the names of the folders are looked at; folders that are not named after a day stay.
    """
    first, _ = days_back(as_date(as_of), days)
    folder = Folder(spark, path)
    old = [name for name in folder.names(f"{day}=*") if (found := _day_of(name)) is not None and found < first]
    for name in old:
        folder.delete(name)
    return old


def drop_day(spark: SparkSession, path: str, which: str | date, day: str = "obs_date") -> bool:
    """Deletes one day's folder; whether there was one."""
    return Folder(spark, path).delete(f"{day}={as_date(which)}")


def _day_of(name: str) -> date | None:
    try:
        return as_date(name.split("=", 1)[1])
    except ValueError:
        return None


def erase_stored(spark: SparkSession, path: str, erased: DataFrame, key: str, schema: str, day: str = "obs_date") -> list[str]:
    """Removes the rows of the listed identifiers from Parquet files in day folders; returns the files that held any.

    The files with such rows are found by a semi join that reads the key column only. They alone are written again, into a hidden
    folder; one small file with the names to add and to remove is the commit, after which the files are moved in and
    the old ones deleted. A run that broke off before its commit has changed nothing, one that broke off after it is
    finished by the next run, and `read_stored` reads the committed state in between. There must be one such run on a
    data set at a time. The files' names are gathered, not their rows.
    """
    finish_erasures(spark, path)
    folder = Folder(spark, path)
    stored = or_empty(lambda: spark.read.schema(schema).parquet(path), spark, schema)
    if not folder.data_files():
        return []
    held = stored.select(key, F.col("_metadata.file_path").alias("file")).join(erased.select(key), key, "left_semi")
    files = sorted(row.file for row in held.select("file").distinct().collect())
    if not files:
        return []
    staged = f"{STAGED}{uuid.uuid4().hex}"
    kept = erase(spark.read.schema(schema).option("basePath", path).parquet(*files), erased, key)
    kept.write.partitionBy(day).parquet(f"{folder.path}/{staged}/data")
    # Spark names each file with an id of its own, and gives its path with the special characters of a URI.
    names = {unquote(file).rsplit("/", 1)[-1] for file in files}
    removed = [name for name in folder.data_files() if name.rsplit("/", 1)[-1] in names]
    added = Folder(spark, f"{folder.path}/{staged}/data").data_files()
    folder.write(f"{staged}/{COMMIT}", json.dumps({"add": added, "remove": removed}))
    finish_erasures(spark, path)
    return removed


def _committed(folder: Folder) -> dict[str, dict[str, list[str]]]:
    """The erasures that are committed and not yet finished: by their folder, the files to add and to remove."""
    return {
        staged: json.loads(folder.read(f"{staged}/{COMMIT}"))
        for staged in folder.names(f"{STAGED}*")
        if folder.has(f"{staged}/{COMMIT}")
    }


def finish_erasures(spark: SparkSession, path: str) -> None:
    """Moves in and deletes what a commit names, and clears what was never committed. May be repeated at any point."""
    folder = Folder(spark, path)
    for staged, change in _committed(folder).items():
        for name in change["remove"]:
            folder.delete(name)
        for name in change["add"]:
            if folder.has(f"{staged}/data/{name}"):
                folder.move(f"{staged}/data/{name}", name)
    for staged in folder.names(f"{STAGED}*"):
        folder.delete(staged)


def read_stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a data set in day folders, also while an erasure is being finished."""
    folder = Folder(spark, path)
    pending = _committed(folder)
    if not pending:
        return or_empty(lambda: spark.read.schema(schema).parquet(path), spark, schema)
    gone = {name for change in pending.values() for name in change["remove"]}
    parts = [(folder, [name for name in folder.data_files() if name not in gone])]
    for staged in pending:
        own = Folder(spark, f"{folder.path}/{staged}/data")
        parts.append((own, own.data_files()))
    frames = [
        spark.read.schema(schema).option("basePath", part.path).parquet(*[f"{part.path}/{name}" for name in names])
        for part, names in parts
        if names
    ]
    whole = spark.createDataFrame([], schema)
    for frame in frames:
        whole = whole.unionByName(frame)
    return whole
