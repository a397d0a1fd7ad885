"""Queries that write the given data in some form and read it back."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weatherlake import schemas
from weatherlake.operators import filters, reshape, stats
from weatherlake.plans.alerting import MONITORED_FLAT, monitored
from weatherlake.plans.bindings import HOURLY, MONTHS, OBS, SNAPSHOTS, months, obs, payloads, table
from weatherlake.plans.catalog import day, query, stamp
from weatherlake.plans.nested import SNAPSHOT_STATS
from weatherlake.plans.observations import RANGE_DAYS, RANGE_END, ROW, ROW_SQL, STATS_SQL
from weatherlake.session import scratch_path
from weatherlake.sources import daily, messages, raw, tables, upkeep

PAYLOAD_ROWS = f"""SELECT city, strftime(snap_ts, '%Y-%m-%dT%H:%M:%S') AS timestamp,
  {day('CAST(snap_ts AS DATE)', 'extraction_date')}, CAST(count(*) AS INTEGER) AS n_hours, sum(temperature) AS temperature_sum
FROM hourly"""


def _payload_rows(df):
    return df.select(
        "city", "timestamp", "extraction_date", F.size("hourly.time").alias("n_hours"),
        F.aggregate("hourly.temperature_2m", F.lit(0.0), lambda total, x: total + x).alias("temperature_sum"),
    )


RAW_DAY = "2024-01-12"


def dropped_files(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A folder of the payloads in files named as a fetcher names them, weather_YYYYMMDD_NNNNNN.json."""
    path = scratch_path(spark, name)
    raw.land_raw(payloads(spark, sf_dir), f"{path}/landed")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for i, file in enumerate(system.globStatus(hadoop(f"{path}/landed/extraction_date=*/*.json"))):
        day = file.getPath().getParent().getName().split("=")[1].replace("-", "")
        system.rename(file.getPath(), hadoop(f"{path}/weather_{day}_{i:06d}.json"))
    return path


@query("raw_scan", f"""WITH {HOURLY} {PAYLOAD_ROWS} WHERE CAST(snap_ts AS DATE) = DATE '{RAW_DAY}'
GROUP BY city, fetch_no, snap_ts""")
def raw_scan(spark, sf_dir):
    good, _ = raw.split_corrupt(raw.read_raw(spark, dropped_files(spark, sf_dir, "raw_scan"), RAW_DAY))
    return _payload_rows(good)


@query("raw_range_scan", f"""WITH {HOURLY} {PAYLOAD_ROWS}
WHERE CAST(snap_ts AS DATE) BETWEEN DATE '{RANGE_END}' - {RANGE_DAYS} AND DATE '{RANGE_END}'
GROUP BY city, fetch_no, snap_ts""")
def raw_range_scan(spark, sf_dir):
    path = dropped_files(spark, sf_dir, "raw_range_scan")
    return _payload_rows(raw.read_raw_range(spark, path, RANGE_END, RANGE_DAYS))


@query("landed_scan", f"WITH {HOURLY} {PAYLOAD_ROWS} GROUP BY city, fetch_no, snap_ts")
def landed_scan(spark, sf_dir):
    path = scratch_path(spark, "landed_scan")
    raw.land_raw(payloads(spark, sf_dir), path)
    good, _ = raw.split_corrupt(raw.read_landed(spark, path))
    return _payload_rows(good)


@query("landed_range_scan", f"""WITH {HOURLY} {PAYLOAD_ROWS}
WHERE CAST(snap_ts AS DATE) BETWEEN DATE '{RANGE_END}' - {RANGE_DAYS} AND DATE '{RANGE_END}'
GROUP BY city, fetch_no, snap_ts""")
def landed_range_scan(spark, sf_dir):
    path = scratch_path(spark, "landed_range_scan")
    raw.land_raw(payloads(spark, sf_dir), path)
    return _payload_rows(raw.read_landed(spark, path, RANGE_END, RANGE_DAYS))


@query("corrupt_split", f"""WITH {SNAPSHOTS} SELECT {day('CAST(snap_ts AS DATE)', 'extraction_date')},
  CASE WHEN city = 'Nairobi' THEN 'rejected' ELSE 'good' END AS status, count(*) AS n FROM snap GROUP BY ALL""")
def corrupt_split(spark, sf_dir):
    """Every payload of one city is cut in half before it is landed."""
    source = payloads(spark, sf_dir)
    text = F.to_json(F.struct(*[c for c in source.columns if c != "extraction_date"]))
    cut = F.when(F.col("city") == "Nairobi", F.left(text, (F.length(text) / 2).cast("int"))).otherwise(text)
    path = scratch_path(spark, "corrupt_split")
    landed = source.select(cut.alias("value"), "extraction_date").hint("rebalance", "extraction_date")
    landed.write.partitionBy("extraction_date").text(f"{path}/landed")
    raw.compact_raw(raw.read_landed(spark, f"{path}/landed"), f"{path}/compacted")
    status = F.when(F.col(schemas.CORRUPT).isNull(), "good").otherwise("rejected").alias("status")
    return raw.read_compacted(spark, f"{path}/compacted").groupBy("extraction_date", status).agg(F.count(F.lit(1)).alias("n"))


@query("month_scan", f"""WITH {MONTHS} SELECT city, {day('obs_date')}, {STATS_SQL} FROM months
WHERE obs_date BETWEEN DATE '2023-12-01' AND DATE '2023-12-31' GROUP BY city, obs_date""")
def month_scan(spark, sf_dir):
    path = scratch_path(spark, "month_scan")
    daily.write_daily(stats.city_stats(months(spark, sf_dir), "obs_date"), path)
    return daily.read_daily(spark, path, "2023-12")


@query("parquet_roundtrip", f"""WITH {OBS} SELECT event_id, city, {stamp('ts')}, temperature, windspeed, precipitation,
  {day('obs_date')} FROM obs""")
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "parquet_roundtrip")
    rows = obs(spark, sf_dir).select(*ROW, "obs_date")
    daily.write_daily(rows, path)
    return daily.read_daily(spark, path, schema=rows.schema)


@query("csv_roundtrip", f"WITH {OBS} SELECT city, {day('obs_date')}, {STATS_SQL} FROM obs GROUP BY city, obs_date")
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv_roundtrip")
    rows = stats.city_stats(obs(spark, sf_dir), "obs_date")
    daily.write_csv(rows, path)
    return daily.read_csv(spark, path, rows.schema)


@query("json_roundtrip", f"""WITH {HOURLY} SELECT city, {day('date')}, avg_temp, min_temp, max_temp, avg_humidity,
  precipitation, avg_windspeed FROM ({SNAPSHOT_STATS})""")
def json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "json_roundtrip")
    daily.write_json(reshape.snapshot_stats(payloads(spark, sf_dir)), path)
    return spark.read.schema(schemas.SNAPSHOT_STATS).json(path)


@query("alerts_table", f"""WITH {MONITORED_FLAT}
SELECT md5(city || '|' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '|' || alert_type || '|' || message) AS id,
  city, {stamp('ts', 'timestamp')}, alert_type, value, threshold, message, CAST(NULL AS VARCHAR) AS forecast_time,
  CAST(0 AS INTEGER) AS processed FROM alerts""")
def alerts_table(spark, sf_dir):
    path = scratch_path(spark, "alerts_table")
    tables.write_alerts(monitored(spark, sf_dir), path, "2024-01-30")
    return tables.read_alerts(spark, path)


@query("replaced_table", f"WITH {OBS} SELECT city, {day('obs_date')}, {STATS_SQL} FROM obs GROUP BY city, obs_date")
def replaced_table(spark, sf_dir):
    """A table of the catalog is made, and replaced by one with other columns."""
    path = scratch_path(spark, "replaced_table")
    name = f"city_stats_{path[-8:]}"
    tables.replace_table(stats.city_stats(obs(spark, sf_dir)), name, path)
    tables.replace_table(stats.city_stats(obs(spark, sf_dir), "obs_date"), name, path)
    return spark.table(name)


STORED_ROW = [*ROW, "station", "obs_date"]


def stored_days(spark, sf_dir, name):
    """The observations in day folders; (path, schema)."""
    path = scratch_path(spark, name)
    rows = obs(spark, sf_dir).select(*STORED_ROW)
    daily.write_daily(rows, path)
    return path, rows.schema.toDDL()


@query("retention_stored", f"WITH {OBS} SELECT {ROW_SQL} FROM obs WHERE obs_date >= DATE '2024-01-30' - 7")
def retention_stored(spark, sf_dir):
    path, schema = stored_days(spark, sf_dir, "retention_stored")
    upkeep.drop_days(spark, path, "2024-01-30", 7)
    return upkeep.read_stored(spark, path, schema).select(*ROW)


@query("erasure_stored", f"""WITH {OBS} SELECT {ROW_SQL} FROM obs WHERE NOT EXISTS (
  SELECT 1 FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey = station)""")
def erasure_stored(spark, sf_dir):
    path, schema = stored_days(spark, sf_dir, "erasure_stored")
    erased = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("station"))
    upkeep.erase_stored(spark, path, erased, "station", schema)
    return upkeep.read_stored(spark, path, schema).select(*ROW)


ENVELOPE = """SELECT city AS key, CAST(to_json(struct_pack(city := city, timestamp := stamp,
  current_weather := struct_pack(temperature := temperature, windspeed := windspeed, winddirection := winddirection,
    weathercode := weathercode, time := minute),
  coordinates := struct_pack(latitude := latitude, longitude := longitude))) AS VARCHAR) AS value
FROM snap WHERE NOT second"""


@query("kafka_envelope", f"WITH {SNAPSHOTS} {ENVELOPE}")
def kafka_envelope(spark, sf_dir):
    return messages.weather_messages(payloads(spark, sf_dir), F.col("timestamp"))


@query("stats_message", f"""WITH {OBS} SELECT CAST(NULL AS VARCHAR) AS key, CAST(to_json(struct_pack(
  type := 'statistics', timestamp := '2024-01-30T12:00:00', data := struct_pack(avg_temp := avg(temperature),
  min_temp := min(temperature), max_temp := max(temperature)))) AS VARCHAR) AS value FROM obs""")
def stats_message(spark, sf_dir):
    return messages.statistics_message(stats.temperature_summary(obs(spark, sf_dir)), F.lit("2024-01-30T12:00:00"))


@query("valid_messages", f"""WITH {SNAPSHOTS}
SELECT city, stamp AS timestamp, temperature, windspeed, latitude, longitude FROM snap WHERE NOT second""")
def valid_messages(spark, sf_dir):
    """City messages are kept, the statistics messages among them are not."""
    source = payloads(spark, sf_dir)
    city = messages.weather_messages(source, F.col("timestamp"))
    statistics = messages.statistics_message(
        source.groupBy("extraction_date").agg(
            F.avg("current_weather.temperature").alias("avg_temp"),
            F.min("current_weather.temperature").alias("min_temp"),
            F.max("current_weather.temperature").alias("max_temp"),
        ),
        F.lit("2024-01-30T12:00:00"),
    )
    valid = filters.with_current(messages.decode(city.unionByName(statistics)))
    return valid.select(
        "city", "timestamp", "current_weather.temperature", "current_weather.windspeed",
        "coordinates.latitude", "coordinates.longitude",
    )
