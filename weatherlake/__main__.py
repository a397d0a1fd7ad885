"""Command line: spark-submit with this file, or python -m weatherlake <job> ..."""

from __future__ import annotations

import argparse

from weatherlake.plans import jobs
from weatherlake.session import get_session
from weatherlake.streaming.connect import ALERT_TOPIC, BUNDLE_TOPIC, PROCESSED_TOPIC, WEATHER_TOPIC, Channel

DAY_JOBS = {"daily": jobs.run_daily, "snapshots": jobs.run_snapshot_stats, "alerts": jobs.run_alerts,
            "analysis": jobs.run_analysis, "notify": jobs.run_notification}
MONTH_JOBS = {"monthly": jobs.run_monthly, "report": jobs.run_monthly_report}


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="weatherlake")
    commands = parser.add_subparsers(dest="job", required=True)
    for names, period in ((DAY_JOBS, "--date"), (MONTH_JOBS, "--month")):
        for name in names:
            command = commands.add_parser(name)
            command.add_argument(period, dest="period", required=True)
            command.add_argument("--input-path", required=True)
            command.add_argument("--output-path", required=True)
    commands.choices["alerts"].add_argument("--servers", help="send bundles to a topic instead of files")
    commands.choices["alerts"].add_argument("--topic", default=BUNDLE_TOPIC)
    publish = commands.add_parser("publish")
    publish.add_argument("--date", dest="period", required=True)
    publish.add_argument("--input-path", required=True)
    publish.add_argument("--topic", default=WEATHER_TOPIC)
    _channel(publish, "")
    retain = commands.add_parser("retain", help="delete day folders that are too old")
    retain.add_argument("--path", required=True)
    retain.add_argument("--date", dest="period", required=True)
    retain.add_argument("--days", type=int, required=True)
    retain.add_argument("--day-column", default="obs_date")
    erase = commands.add_parser("erase", help="remove the rows of listed identifiers")
    erase.add_argument("--path", required=True)
    erase.add_argument("--ids", required=True, help="CSV file with a header that has the key")
    erase.add_argument("--key", required=True)
    erase.add_argument("--day-column", default="obs_date")
    for name, sink in (("alert-stream", ALERT_TOPIC), ("processed-stream", PROCESSED_TOPIC)):
        stream = commands.add_parser(name)
        stream.add_argument("--servers")
        stream.add_argument("--source-topic", default=WEATHER_TOPIC)
        stream.add_argument("--sink-topic", default=sink)
        stream.add_argument("--source-path", help="folder of messages instead of a topic")
        stream.add_argument("--sink-path", help="folder of messages instead of a topic")
        stream.add_argument("--checkpoint", required=True)
    return parser.parse_args(arguments)


def _channel(command: argparse.ArgumentParser, prefix: str) -> None:
    place = command.add_mutually_exclusive_group(required=True)
    place.add_argument("--servers")
    place.add_argument(f"--{prefix}path", dest="path", help="folder of messages instead of a topic")


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    spark = get_session(f"weatherlake-{options.job}")
    if options.job in ("alert-stream", "processed-stream"):
        run = jobs.run_alert_stream if options.job == "alert-stream" else jobs.run_processed_stream
        source = _place(options.source_topic, options.servers, options.source_path)
        sink = _place(options.sink_topic, options.servers, options.sink_path)
        run(spark, source, sink, options.checkpoint).awaitTermination()
    elif options.job == "publish":
        channel = _place(options.topic, options.servers, options.path)
        jobs.run_publish(spark, options.period, options.input_path, channel)
    elif options.job == "retain":
        jobs.run_retention(spark, options.path, options.period, options.days, options.day_column)
    elif options.job == "erase":
        jobs.run_erasure(spark, options.path, options.ids, options.key, day=options.day_column)
    elif options.job == "alerts" and options.servers:
        channel = Channel(topic=options.topic, servers=options.servers)
        jobs.run_alerts(spark, options.period, options.input_path, options.output_path, channel=channel)
    else:
        job = {**DAY_JOBS, **MONTH_JOBS}[options.job]
        job(spark, options.period, options.input_path, options.output_path)


def _place(topic: str, servers: str | None, path: str | None) -> Channel:
    if path is None and servers is None:
        raise SystemExit("give --servers or a folder")
    return Channel(path=path) if path is not None else Channel(topic=topic, servers=servers)


if __name__ == "__main__":
    main()
