"""Tables: replaced analysis tables, the rule table, and the alert table that is only added to."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weatherlake import schemas
from weatherlake.functions.calendar import as_date
from weatherlake.operators.rules import RULE_SCHEMA
from weatherlake.sources.raw import or_empty
from weatherlake.sources.versions import publish_version, read_version, version_path

REQUIRED = ("city", "timestamp", "alert_type", "value", "threshold", "message")


def replace_table(df: DataFrame, name: str, path: str) -> int:
    """Makes `df` the content of the catalog's table `name`, stored under `path`; returns its version.

    The rows are written as a new version first. Then the name, a view on its newest version, is pointed to it by one
    change of the catalog, so a reader has the old rows or the new ones, also if the columns differ. The version before stays
    for readers that began with it.
    """
    version = publish_version(df, path)
    location = version_path(path, version).replace("`", "``")
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{location}`")
    return version


def publish_rules(rules: DataFrame, path: str) -> int:
    """Writes a rule table as a new version, for streams and jobs to read from then on."""
    return publish_version(rules.select(*T.StructType.fromDDL(RULE_SCHEMA).fieldNames()), path)


def read_rules(spark: SparkSession, path: str, profile: str | None = None, version: int | None = None) -> DataFrame:
    """The newest or a given version of the rule table, of one profile or of all."""
    rules = read_version(spark, path, RULE_SCHEMA, version)
    return rules if profile is None else rules.where(F.col("profile") == profile)


def alert_rows(alerts: DataFrame) -> DataFrame:
    """Alerts as rows of the alert table: a key from their content, and not yet processed.

    Rows that lack a required value are left out, as a NOT NULL column would refuse them; `unstamped` gives those whose
    stamp is there but no time.
    """
    if "forecast_time" not in alerts.columns:
        alerts = alerts.withColumn("forecast_time", F.lit(None).cast("string"))
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in REQUIRED])
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    identity = F.md5(F.concat_ws("|", "city", stamp, "alert_type", "message", "forecast_time"))
    typed = alerts.withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))
    # Exploding an array of one struct keeps the optimizer from making the texts twice, for the check
    # and for the row.
    rows = typed.select(F.inline(F.array(F.struct(*REQUIRED, "forecast_time"))))
    return rows.where(complete).select(
        identity.alias("id"), *REQUIRED, F.col("forecast_time"), F.lit(0).alias("processed")
    )


def unstamped(alerts: DataFrame) -> DataFrame:
    """Alerts whose stamp cannot be read as a time, as they are, to be set apart."""
    return alerts.where(F.col("timestamp").isNotNull() & F.col("timestamp").try_cast("timestamp_ntz").isNull())


def write_alerts(alerts: DataFrame, path: str, run_day: str | date) -> None:
    """Adds a run's alerts to the table, with a folder per alert day inside the run's own folder.

    A run for the same day replaces what the run before wrote, so a repeated run adds nothing twice.
    """
    rows = alert_rows(alerts).withColumn("alert_date", F.col("timestamp").cast("date"))
    (
        rows.hint("rebalance", "alert_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("alert_date")
        .parquet(f"{path}/run_date={as_date(run_day)}")
    )


def read_alerts(spark: SparkSession, path: str, day: str | None = None, run_day: str | date | None = None) -> DataFrame:
    """The alert table, or the alerts of one day or of one run."""
    schema = f"{schemas.ALERTS}, run_date DATE, alert_date DATE"
    df = or_empty(lambda: spark.read.schema(schema).parquet(path), spark, schema)
    for column, wanted in (("alert_date", day), ("run_date", run_day)):
        if wanted is not None:
            df = df.where(F.col(column) == F.lit(str(as_date(wanted))).cast("date"))
    return df.drop("alert_date", "run_date")
