"""Event-time windows with a watermark, late rows, and the compaction of batch folders."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from test_streaming import publish

from weatherlake.streaming import batches, connect, weather, windows

START = datetime(2025, 9, 24)


def shuffled(n, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["Paris", "Tokyo"]), START + timedelta(minutes=rng.randint(0, 1200), seconds=rng.randint(0, 59)), 1.0, 2.0) for _ in range(n)]
    return rows


def expected(rows):
    hours = {}
    for _, ts, *_ in rows:
        count, seconds = hours.get(ts.replace(minute=0, second=0), (0, 0))
        hours[ts.replace(minute=0, second=0)] = (count + 1, seconds + ts.second)
    return {hour: (n, total / n) for hour, (n, total) in hours.items()}


def totals(spark, path):
    return {row.window_start: (row.messages, row.mean_delay_seconds) for row in windows.corrected_windows(spark, path).collect()}


@pytest.mark.parametrize(("per_trigger", "delay"), [(1, "0 seconds"), (3, "2 hours"), (4, "100 days"), (100, "0 seconds")])
def test_window_rows_and_late_rows_are_all_rows(spark, tmp_path, per_trigger, delay):
    rows = shuffled(60, 3)
    source = str(tmp_path / "in")
    for first in range(0, 60, 30):
        publish(spark, connect.Channel(path=source), rows[first : first + 30])
    out = str(tmp_path / "out")
    stream = connect.stream_source(spark, connect.Channel(path=source, options={"maxFilesPerTrigger": str(per_trigger)}))
    windows.update_windows(stream, out, str(tmp_path / "checkpoint"), delay, buckets=3).awaitTermination()
    assert totals(spark, out) == expected(rows)
    counted = windows.read_windows(spark, out).groupBy().sum("messages").first()[0]
    late = windows.read_late(spark, out).count()
    assert counted + late == 60
    assert (late == 0) == (delay == "100 days" or per_trigger == 100)
    # Late rows are those of closed windows only: a row of the newest hour is never late.
    newest = max(ts for _, ts, *_ in rows).replace(minute=0, second=0)
    assert windows.read_late(spark, out).where(f"window_start >= '{newest}'").count() == 0


def test_resumes_with_its_state_and_compacts(spark, tmp_path):
    rows = shuffled(60, 5)
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    for first in range(0, 60, 20):
        publish(spark, connect.Channel(path=source), rows[first : first + 20])
        stream = connect.stream_source(spark, connect.Channel(path=source))
        windows.update_windows(stream, out, checkpoint, "1 hour", buckets=2).awaitTermination()
        assert totals(spark, out) == expected(rows[: first + 20])
        late = windows.read_late(spark, out).count()
        assert windows.compact_windows(spark, out) is not None
        assert totals(spark, out) == expected(rows[: first + 20]) and windows.read_late(spark, out).count() == late
        assert windows.compact_windows(spark, out) is None
    assert late > 0


def test_state_has_partitions_by_its_buckets(spark, tmp_path):
    source, out, setting = str(tmp_path / "in"), str(tmp_path / "out"), "spark.sql.shuffle.partitions"
    rows, before = shuffled(20, 7), spark.conf.get(setting)
    publish(spark, connect.Channel(path=source), rows)
    spark.conf.set(setting, 50)
    try:
        stream = connect.stream_source(spark, connect.Channel(path=source))
        run = windows.update_windows(stream, out, str(tmp_path / "checkpoint"), buckets=3)
        run.awaitTermination()
        assert spark.conf.get(setting) == "50"
    finally:
        spark.conf.set(setting, before)
    assert {state["numShufflePartitions"] for progress in run.recentProgress for state in progress["stateOperators"]} == {6}
    assert totals(spark, out) == expected(rows)


def test_unreadable_stamps_are_counted_under_no_window(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    publish(spark, connect.Channel(path=source), shuffled(5, 1))
    bad = '{"city": "Paris", "timestamp": "n/a", "current_weather": {"temperature": 1.0, "time": "2025-09-24T00:00"}}'
    connect.write_messages(spark.createDataFrame([("Paris", bad)] * 3, connect.MESSAGE_COLUMNS), connect.Channel(path=source))
    stream = connect.stream_source(spark, connect.Channel(path=source))
    windows.update_windows(stream, out, str(tmp_path / "checkpoint")).awaitTermination()
    rows = {row.window_start: row.messages for row in windows.read_windows(spark, out).collect()}
    assert rows[None] == 3 and sum(rows.values()) == 8


def test_state_keeps_open_windows_only():
    import pandas as pd

    class State:
        exists, value, watermark = False, None, 0

        @property
        def get(self):
            return self.value

        def update(self, value):
            self.exists, self.value = True, value

        def getCurrentWatermarkMs(self):
            return self.watermark

    state, fold = State(), windows._folder(3600)

    def run(*starts):
        frame = pd.DataFrame({"start": starts, "ts_micros": 0, "micros": -(2**60), "with_delay": 1, "city": "x"})
        return pd.concat([*fold((1,), iter([frame]), state), pd.DataFrame({"kind": []})])

    assert run(0, 0, 3600)["kind"].tolist() == ["open", "open"]
    assert run(0)["micros"].tolist() == [str(-3 * 2**60)]
    state.watermark = 3_600_000
    assert sorted(run(0, 3600, 7200)["kind"]) == ["late", "open", "open"]
    assert sorted(windows.json.loads(state.value[0])) == ["3600", "7200"]
    state.watermark = 10**12
    run(10**10, windows.NO_TIME)
    assert sorted(windows.json.loads(state.value[0])) == [str(10**10), str(windows.NO_TIME)]


def parts(spark, rows):
    return spark.createDataFrame([(START + timedelta(hours=h), n, None, 0) for h, n in rows], "window_start TIMESTAMP, messages LONG, micros DECIMAL(38,0), with_delay LONG")


def test_compaction_at_any_point_changes_nothing_that_is_read(spark, tmp_path):
    path = str(tmp_path / "parts")

    def table():
        return {row.window_start.hour: row.messages for row in weather.read_throughput(spark, path).collect()}

    assert table() == {} and weather.compact_throughput(spark, path) is None
    for batch in range(4):
        parts(spark, [(0, 1), (batch, 10)]).write.parquet(batches.batch_path(path, batch))
    want = {0: 14, 1: 10, 2: 10, 3: 10}
    assert table() == want
    assert weather.compact_throughput(spark, path) == 3 and table() == want
    # What a broken run or a repeated batch leaves behind is passed over.
    parts(spark, [(9, 9)]).write.parquet(f"{path}/upto=4")
    Path(f"{path}/upto=4/_SUCCESS").unlink()
    parts(spark, [(0, 1), (3, 10)]).write.mode("overwrite").parquet(batches.batch_path(path, 3))
    assert table() == want
    parts(spark, [(5, 5)]).write.parquet(batches.batch_path(path, 4))
    assert table() == want | {5: 5}
    assert weather.compact_throughput(spark, path) == 4 and table() == want | {5: 5}
    assert sorted(p.name for p in Path(path).iterdir()) == ["batch=4", "upto=3", "upto=4"]
    parts(spark, [(6, 6)]).write.parquet(batches.batch_path(path, 5))
    assert weather.compact_throughput(spark, path) == 5 and table() == want | {5: 5, 6: 6}
    assert sorted(p.name for p in Path(path).iterdir()) == ["batch=5", "upto=4", "upto=5"]
