"""The jobs from files to files."""

import json
from datetime import datetime

from samples import drop, payload, second_dialect

from weatherlake import __main__ as cli
from weatherlake.plans import jobs
from weatherlake.sources import reports, tables
from weatherlake.streaming import connect


def test_daily_then_monthly(spark, tmp_path):
    for day, temperature in (("20250924", 10.0), ("20250925", 20.0)):
        current = {**payload()["current_weather"], "temperature": temperature}
        drop(tmp_path / "raw", f"weather_{day}_090000.json", [payload(current_weather=current)])
        drop(tmp_path / "raw", f"weather_{day}_100000.json", [payload(current_weather=current)])
        jobs.run_daily(spark, f"{day[:4]}-{day[4:6]}-{day[6:]}", str(tmp_path / "raw"), str(tmp_path / f"daily_{day}"))
    assert spark.read.parquet(str(tmp_path / "daily_20250924/current")).count() == 2
    monthly = jobs.run_monthly(spark, "2025-09", str(tmp_path), str(tmp_path / "monthly"))
    assert [(r.city, r.monthly_avg_temperature) for r in monthly.collect()] == [("Paris", 15.0)]
    csv = next((tmp_path / "monthly/city_monthly_summary").glob("part-*")).read_text().splitlines()
    assert csv[0].startswith("city,monthly_avg_temperature") and csv[1].startswith("Paris,15.0")


def test_no_data_writes_nothing(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    assert jobs.run_daily(spark, "2025-09-24", str(tmp_path / "raw"), str(tmp_path / "out")) is None
    assert jobs.run_monthly(spark, "2025-09", str(tmp_path), str(tmp_path / "out")) is None
    assert jobs.run_alerts(spark, "2025-09-24", str(tmp_path / "raw"), str(tmp_path / "out")) is None
    assert jobs.run_analysis(spark, "2025-09-24", str(tmp_path / "raw"), str(tmp_path / "out")) == {}
    assert jobs.run_snapshot_stats(spark, "2025-09-24", str(tmp_path / "raw"), str(tmp_path / "out")) is None
    assert jobs.run_monthly_report(spark, "2025-09", str(tmp_path / "out"), str(tmp_path / "out")) is None
    assert not (tmp_path / "out").exists()


def test_daily_sets_truncated_files_apart(spark, tmp_path):
    drop(tmp_path / "raw", "weather_20250924_090000.json", [payload()])
    drop(tmp_path / "raw", "weather_20250924_100000.json", '[{"city": "To')
    jobs.run_daily(spark, "2025-09-24", str(tmp_path / "raw"), str(tmp_path / "out"))
    assert [r.city for r in spark.read.parquet(str(tmp_path / "out/city_stats")).collect()] == ["Paris"]
    assert spark.read.parquet(str(tmp_path / "out/rejected")).count() == 1


def test_snapshot_stats_then_report(spark, tmp_path):
    for day in ("20250924", "20250925"):
        drop(tmp_path / "raw", f"weather_{day}_090000.json", [payload("Paris"), payload("Tokyo")])
    out = str(tmp_path / "out")
    profile = [jobs.run_snapshot_stats(spark, d, str(tmp_path / "raw"), out).collect()[0] for d in ("2025-09-24", "2025-09-25")]
    assert [(r.n_rows, r.n_cities, str(r.last_date)) for r in profile] == [(2, 2, "2025-09-24"), (2, 2, "2025-09-25")]
    report = jobs.run_monthly_report(spark, "2025-09", out, out).collect()
    assert [(r.city, r.precipitation) for r in report] == [("Paris", 4.0), ("Tokyo", 4.0)]
    assert (tmp_path / "out/monthly_weather_summary_202509").exists()


def test_analysis_writes_each_table_on_its_own(spark, tmp_path):
    hourly = {k: v for k, v in payload()["hourly"].items() if k != "winddirection_10m"}
    drop(tmp_path / "raw", "weather_20250924_090000.json", [payload(hourly=hourly)])
    drop(tmp_path / "raw", "weather_20250916_090000.json", [payload("Tokyo")])
    found = jobs.run_analysis(spark, "2025-09-24", str(tmp_path / "raw"), str(tmp_path / "out"))
    assert found["temperature"].count() == 3 and found["wind"].count() == 0
    assert [tuple(r) for r in found["temperature_by_city"].collect()] == [("Paris", 13.0)]
    assert found["wind_rose"].count() == 0


def test_alert_job(spark, tmp_path):
    drop(tmp_path / "raw", "weather_20250924_090000.json", [second_dialect("Lyon", temperature_2m=41.0), payload()])
    stored = jobs.run_alerts(spark, "2025-09-24", str(tmp_path / "raw"), str(tmp_path / "out"))
    assert stored.count() == 5
    digest = "".join(p.read_text("utf-8") for p in sorted((tmp_path / "out/digest").glob("part-*")))
    assert digest == "Température élevée à Lyon: 41.0°C (seuil: 35.0°C)\n"
    summary = spark.read.json(str(tmp_path / "out/alert_summary_2025-09-24")).collect()
    assert json.loads(summary[0].summary)["temperature_high"] == 1
    message = spark.read.json(str(tmp_path / "out/messages")).where("key = 'Lyon'").collect()[0]
    assert message.key == "Lyon" and len(json.loads(message.value)["alerts"]) == 5


def test_alert_job_keeps_to_its_day_and_replaces_its_own_run(spark, tmp_path):
    out = str(tmp_path / "out")
    hot = {"temperature_2m": 41.0}
    drop(tmp_path / "raw", "weather_20250924_090000.json", [second_dialect("Lyon", **hot)])
    drop(tmp_path / "raw", "weather_20250925_090000.json", [second_dialect("Lille", **hot)])
    counts = []
    for day in ("2025-09-24", "2025-09-25", "2025-09-25"):
        stored = jobs.run_alerts(spark, day, str(tmp_path / "raw"), out)
        table = tables.read_alerts(spark, f"{out}/alerts")
        counts.append((stored.count(), table.count(), table.select("id").distinct().count(), spark.read.json(f"{out}/messages").count()))
    assert counts == [(5, 5, 5, 1), (5, 10, 10, 2), (5, 10, 10, 2)]
    assert {r.city for r in stored.collect()} == {"Lille"}


def test_an_unreadable_stamp_is_set_apart(spark, tmp_path):
    bad = {**second_dialect("Lille", temperature_2m=41.0), "timestamp": "n/a"}
    drop(tmp_path / "raw", "weather_20250924_090000.json", [second_dialect("Lyon", temperature_2m=41.0), bad])
    stored = jobs.run_alerts(spark, "2025-09-24", str(tmp_path / "raw"), str(tmp_path / "out"))
    assert {r.city for r in stored.collect()} == {"Lyon"}
    apart = spark.read.json(str(tmp_path / "out/unstamped_alerts_2025-09-24"))
    assert {r.city for r in apart.collect()} == {"Lille"} and apart.count() == 5


def test_analysis_reads_its_own_days_only(spark, tmp_path):
    for day in ("20250901", "20250924"):
        drop(tmp_path / "raw", f"weather_{day}_090000.json", [payload()])
    for end in ("2025-09-01", "2025-09-24"):
        found = jobs.run_analysis(spark, end, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert {str(r.date) for r in found["temperature"].collect()} == {"2025-09-24"}
    assert found["temperature_pivot"].columns[:2] == ["date", "Paris"] and found["top_temperature_series"].count() == 3


def test_command_line_publishes_and_processes(spark, tmp_path):
    drop(tmp_path / "raw", "weather_20250924_090000.json", [payload(), payload("Tokyo")])
    cli.main(["publish", "--date", "2025-09-24", "--input-path", str(tmp_path / "raw"), "--path", str(tmp_path / "weather")])
    cli.main(["processed-stream", "--source-path", str(tmp_path / "weather"), "--sink-path", str(tmp_path / "flat"), "--checkpoint", str(tmp_path / "c")])
    flat = [json.loads(r.value) for r in spark.read.json(str(tmp_path / "flat")).collect()]
    assert sorted(row["city"] for row in flat) == ["Paris", "Tokyo"]


def test_publish_then_alert_stream(spark, tmp_path):
    hot = {**payload()["current_weather"], "temperature": 36.0}
    drop(tmp_path / "raw", "weather_20250924_090000.json", [payload(), payload("Tokyo", current_weather=hot)])
    source, sink = (connect.Channel(path=str(tmp_path / name)) for name in ("weather", "alerts"))
    jobs.run_publish(spark, "2025-09-24", str(tmp_path / "raw"), source)
    assert spark.read.json(source.path).count() == 3
    jobs.run_alert_stream(spark, source, sink, str(tmp_path / "checkpoint")).awaitTermination()
    alert = json.loads(spark.read.json(sink.path).collect()[0].value)
    assert alert["city"] == "Tokyo" and alert["alert"]["message"] == "Température élevée détectée à Tokyo: 36.0°C"
    assert alert["coordinates"] == {"latitude": 48.85, "longitude": 2.35}


def test_publishing_again_replaces_the_days_messages(spark, tmp_path):
    channel = connect.Channel(path=str(tmp_path / "weather"))
    drop(tmp_path / "raw", "weather_20250924_090000.json", [payload(), payload("Tokyo")])
    drop(tmp_path / "raw", "weather_20250925_090000.json", [payload()])
    for day in ("2025-09-24", "2025-09-25", "2025-09-24"):
        jobs.run_publish(spark, day, str(tmp_path / "raw"), channel)
    assert spark.read.json(channel.path).count() == 3 + 2


def test_publishing_without_data_writes_nothing(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    jobs.run_publish(spark, "2025-09-24", str(tmp_path / "raw"), connect.Channel(path=str(tmp_path / "weather")))
    drop(tmp_path / "raw", "weather_20250925_090000.json", '[{"city": "To')
    jobs.run_publish(spark, "2025-09-25", str(tmp_path / "raw"), connect.Channel(path=str(tmp_path / "weather")))
    assert not (tmp_path / "weather").exists()


def test_snapshots_without_a_good_record_leave_no_old_figures(spark, tmp_path):
    out = str(tmp_path / "out")
    for day in ("20250924", "20250925"):
        drop(tmp_path / "raw", f"weather_{day}_090000.json", [payload()])
        jobs.run_snapshot_stats(spark, day, str(tmp_path / "raw"), out)
    drop(tmp_path / "raw", "weather_20250924_090000.json", '[{"city": "To')
    assert jobs.run_snapshot_stats(spark, "2025-09-24", str(tmp_path / "raw"), out) is None
    left = spark.read.parquet(f"{out}/daily_weather_stats")
    assert {str(r.date) for r in left.collect()} == {"2025-09-25"}


def test_analysis_replaces_its_tables(spark, tmp_path):
    for n, day in ((1, "20250901"), (2, "20250924")):
        drop(tmp_path / "raw", f"weather_{day}_090000.json", [payload(f"City {i}") for i in range(n)])
    for end, n in (("2025-09-01", 1), ("2025-09-24", 2)):
        jobs.run_analysis(spark, end, str(tmp_path / "raw"), str(tmp_path / "out"), tables_prefix="analysis_")
        assert spark.table("analysis_temperature_by_city").count() == n
        assert {str(r.date) for r in spark.table("analysis_temperature").collect()} == {f"{end}"}


def test_notification(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    assert jobs.run_notification(spark, "2025-09-23", str(tmp_path / "raw"), str(tmp_path / "out")).first().message == reports.NO_DATA
    drop(tmp_path / "raw", "weather_20250924_090000.json", [payload()])
    jobs.run_notification(spark, "2025-09-24", str(tmp_path / "raw"), str(tmp_path / "out"), datetime(2025, 9, 24, 12))
    text = next((tmp_path / "out/notification_2025-09-24").glob("part-*")).read_text("utf-8")
    assert "24/09/2025 12:00" in text and "17.6" in text


def test_upkeep_jobs(spark, tmp_path):
    path = str(tmp_path / "data")
    rows = spark.range(9).selectExpr("id % 3 AS station", "id AS value", "date_add(DATE '2024-01-01', CAST(id DIV 3 AS INT)) AS obs_date")
    rows.write.partitionBy("obs_date").parquet(path)
    (tmp_path / "ids.csv").write_text("station\n2\n")
    cli.main(["retain", "--path", path, "--date", "2024-01-03", "--days", "1"])
    cli.main(["erase", "--path", path, "--ids", str(tmp_path / "ids.csv"), "--key", "station"])
    assert sorted(r.value for r in spark.read.parquet(path).collect()) == [3, 4, 6, 7]


def test_command_line():
    options = cli.parse(["daily", "--date", "2025-09-24", "--input-path", "/in", "--output-path", "/out"])
    assert (options.job, options.period, options.input_path) == ("daily", "2025-09-24", "/in")
    assert cli.parse(["alert-stream", "--servers", "s", "--checkpoint", "/c"]).sink_topic == "weather-alerts"


def test_command_line_runs_a_job(spark, tmp_path):
    drop(tmp_path / "raw", "weather_20250924_090000.json", [payload()])
    cli.main(["daily", "--date", "2025-09-24", "--input-path", str(tmp_path / "raw"), "--output-path", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out/city_stats")).count() == 1
