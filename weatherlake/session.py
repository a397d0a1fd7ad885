"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings that the results or the plans rely on. Sizes are left to the cluster:
# partition counts are chosen by AQE from a high initial number, so the same code
# runs with a handful of partitions on a laptop and with tens of thousands on a cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Python call sites in error messages; noting them costs more than building the plan itself.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app_name: str = "weatherlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; `conf` adds or replaces settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def literal_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A short list of rows as a frame of known size, which Spark can broadcast; `schema` is DDL.

    A frame made of Python rows has no size for the planner, and a join with it would shuffle both sides.
    """
    struct = T.StructType.fromDDL(schema)
    names = struct.fieldNames()
    table = pa.Table.from_pylist([dict(zip(names, row)) for row in rows], schema=to_arrow_schema(struct))
    return spark.createDataFrame(table, struct)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path not used before, in a folder that the driver and all executors share.

    That is the folder named by spark.checkpoint.dir. A local session without one gets a folder in its warehouse; on a
    cluster that may lie on the driver's own disk, so there the setting is required. `clear_scratch` removes what
    this application wrote.
    """
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/weatherlake/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Deletes the scratch data of this application; frames that read it can't be used afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
