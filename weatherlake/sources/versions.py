"""Data sets kept as whole versions, each in a folder of its own, so that a reader never sees a half-written one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weatherlake.sources.folders import Folder

# Versions that stay for readers that began before the newest was there.
KEPT = 2


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The highest complete version; None if there is none."""
    return max(Folder(spark, path).numbered("version"), default=None)


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/version={version}"


def publish_version(df: DataFrame, path: str, kept: int = KEPT) -> int:
    """Writes the next version, which counts once it is complete, and removes all but the newest `kept`.

    A version is never written twice: of two writers at the same time one fails.
    """
    folder = Folder(df.sparkSession, path)
    version = max((int(name.split("=")[1]) for name in folder.names("version=*")), default=0) + 1
    df.write.mode("errorifexists").parquet(version_path(path, version))
    for old in sorted(folder.numbered("version"))[:-kept]:
        folder.delete(f"version={old}")
    return version


def read_version(spark: SparkSession, path: str, schema: str, version: int | None = None) -> DataFrame:
    """The newest or a given version; an empty frame if there is none."""
    if version is None:
        version = latest_version(spark, path)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_path(path, version))
