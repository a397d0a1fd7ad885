"""Scans of raw snapshots, and what becomes of odd records."""

import json
from datetime import date

from pyspark.sql import functions as F
from samples import TIMES, drop, payload, second_dialect

from weatherlake import schemas
from weatherlake.operators import reshape
from weatherlake.sources import raw


def read(spark, folder, day="2025-09-24"):
    return raw.read_raw(spark, str(folder), day)


def test_array_of_cities_gives_a_row_each(spark, tmp_path):
    drop(tmp_path, "weather_20250924_090000.json", [payload("Paris"), payload("Tokyo")])
    drop(tmp_path, "weather_20250924_100000.json", [])
    drop(tmp_path, "weather_20250925_090000.json", [payload("Sydney")])
    rows = read(spark, tmp_path).select("city", "extraction_date").collect()
    assert sorted(tuple(r) for r in rows) == [("Paris", date(2025, 9, 24)), ("Tokyo", date(2025, 9, 24))]


def test_missing_day_is_an_empty_frame_of_the_same_schema(spark, tmp_path):
    drop(tmp_path, "weather_20250924_090000.json", [payload()])
    found, missing = read(spark, tmp_path), read(spark, tmp_path, "2020-01-01")
    assert missing.isEmpty() and missing.schema.simpleString() == found.schema.simpleString()
    assert reshape.current_flat(missing).collect() == []


def test_range_has_both_ends(spark, tmp_path):
    for day in range(14, 26):
        drop(tmp_path, f"weather_202509{day}_000000.json", [payload()])
    days = raw.read_raw_range(spark, str(tmp_path), "2025-09-24", 7).select("extraction_date").distinct().collect()
    assert sorted(r[0].day for r in days) == list(range(17, 25))


def test_truncated_file_is_rejected_with_its_text(spark, tmp_path):
    drop(tmp_path, "weather_20250924_090000.json", [payload("Paris")])
    drop(tmp_path, "weather_20250924_100000.json", '[{"city": "Tokyo", "latitude": 35.')
    good, rejected = raw.split_corrupt(read(spark, tmp_path))
    assert [r.city for r in good.collect()] == ["Paris"]
    assert [r[schemas.CORRUPT] for r in rejected.collect()] == ['[{"city": "Tokyo", "latitude": 35.']


def test_file_cut_anywhere_is_rejected(spark, tmp_path):
    text = json.dumps([payload("Tokyo")])
    for cut in range(1, len(text), 7):
        drop(tmp_path, f"weather_20250924_{cut:06}.json", text[:cut])
    drop(tmp_path, "weather_20250924_000000.json", '"no object"')
    drop(tmp_path, "weather_20250924_999999.json", text)
    good, rejected = raw.split_corrupt(read(spark, tmp_path))
    assert [r.city for r in good.collect()] == ["Tokyo"]
    assert len(rejected.collect()) == rejected.count() == len(range(1, len(text), 7)) + 1


def test_a_wrong_type_beside_a_repeated_key_rejects_nothing(spark, tmp_path):
    text = json.dumps(payload("Tokyo", latitude="north"))
    drop(tmp_path, "weather_20250924_090000.json", text[:-1] + ', "timezone": "UTC"}')
    good, rejected = raw.split_corrupt(read(spark, tmp_path))
    assert [(r.city, r.latitude) for r in good.collect()] == [("Tokyo", None)] and rejected.count() == 0


def test_field_of_the_wrong_type_is_null_and_rejects_nothing(spark, tmp_path):
    drop(tmp_path, "weather_20250924_090000.json", [payload("Paris"), payload("Tokyo", latitude="north")])
    raw.compact_raw(read(spark, tmp_path), str(tmp_path / "compacted"))
    for source in (read(spark, tmp_path), raw.read_compacted(spark, str(tmp_path / "compacted"))):
        good, rejected = raw.split_corrupt(source)
        assert sorted(tuple(r) for r in good.select("city", "latitude", "longitude").collect()) == [
            ("Paris", 48.85, 2.35), ("Tokyo", None, 2.35)]
        assert good.count() == 2 and rejected.count() == 0


def test_compacting_a_day_again_replaces_only_that_day(spark, tmp_path):
    drop(tmp_path, "weather_20250924_090000.json", [payload("Paris")])
    drop(tmp_path, "weather_20250925_090000.json", [payload("Tokyo")])
    path = str(tmp_path / "compacted")
    for day in ("2025-09-24", "2025-09-25", "2025-09-25"):
        raw.compact_raw(read(spark, tmp_path, day), path)
    assert sorted(r.city for r in raw.read_compacted(spark, path).collect()) == ["Paris", "Tokyo"]
    assert [r.city for r in raw.read_compacted(spark, path, "2025-09-24").collect()] == ["Paris"]


def test_landed_snapshots_come_back(spark, tmp_path):
    drop(tmp_path, "weather_20250924_090000.json", [payload("Paris"), second_dialect()])
    good, _ = raw.split_corrupt(read(spark, tmp_path))
    raw.land_raw(good, str(tmp_path / "landed"))
    back, _ = raw.split_corrupt(raw.read_landed(spark, str(tmp_path / "landed")))
    assert sorted(map(str, back.select(*good.columns).collect())) == sorted(map(str, good.collect()))


def frame(spark, tmp_path, *payloads):
    drop(tmp_path, "weather_20250924_090000.json", list(payloads))
    return read(spark, tmp_path)


def test_fractional_humidity_keeps_the_whole_array(spark, tmp_path):
    hourly = {**payload()["hourly"], "relative_humidity_2m": [50, 60.5, 70]}
    row = reshape.snapshot_stats(frame(spark, tmp_path, payload(hourly=hourly))).collect()[0]
    assert row.avg_humidity == 180.5 / 3


def test_series_stops_at_the_shortest_array(spark, tmp_path):
    hourly = {**payload()["hourly"], "temperature_2m": [1.0, 2.0]}
    rows = reshape.hourly_temperature(frame(spark, tmp_path, payload(hourly=hourly))).collect()
    assert [(r.hour, r.temperature) for r in rows] == [("09:00", 1.0), ("10:00", 2.0)]


def test_series_of_a_null_array_is_empty_and_the_others_stay(spark, tmp_path):
    hourly = {**payload()["hourly"], "winddirection_10m": None}
    raws = frame(spark, tmp_path, payload(hourly=hourly))
    assert reshape.hourly_wind(raws).count() == 0
    assert reshape.hourly_precipitation(raws).count() == 3


def test_null_element_keeps_its_place(spark, tmp_path):
    hourly = {**payload()["hourly"], "temperature_2m": [None, 12.0, 18.0]}
    raws = frame(spark, tmp_path, payload(hourly=hourly))
    assert [r.temperature for r in reshape.hourly_temperature(raws).collect()] == [None, 12.0, 18.0]
    stats = reshape.snapshot_stats(raws).collect()[0]
    assert (stats.avg_temp, stats.min_temp, stats.max_temp) == (15.0, 12.0, 18.0)


def test_hour_is_of_the_forecast_and_date_of_the_snapshot(spark, tmp_path):
    rows = reshape.hourly_temperature(frame(spark, tmp_path, payload())).collect()
    assert [(str(r.date), r.hour, r.ts.isoformat()[:16]) for r in rows] == [
        ("2025-09-24", time[-5:], time) for time in TIMES
    ]


def test_payload_without_city_or_hourly(spark, tmp_path):
    raws = frame(spark, tmp_path, payload(city=None), payload("Tokyo", hourly=...))
    assert {r.city for r in reshape.hourly_temperature(raws).collect()} == {"Unknown"}
    assert [r.city for r in reshape.snapshot_stats(raws).collect()] == ["Unknown"]
    assert sorted(r.city or "" for r in reshape.current_flat(raws).collect()) == ["", "Tokyo"]


def test_snapshot_stats(spark, tmp_path):
    row = reshape.snapshot_stats(frame(spark, tmp_path, payload())).collect()[0]
    assert row.asDict() == {
        "city": "Paris", "date": date(2025, 9, 24), "avg_temp": 13.0, "min_temp": 10.0, "max_temp": 17.0,
        "avg_humidity": 60.0, "precipitation": 2.0, "avg_windspeed": 10.0,
    }


def test_overlapping_snapshots_give_a_row_each_but_one_latest_hour(spark, tmp_path):
    older = payload(timestamp="2025-09-24T08:00:00")
    newer = payload(timestamp="2025-09-24T09:00:00", hourly={**payload()["hourly"], "temperature_2m": [20.0, 21.0]})
    raws = frame(spark, tmp_path, older, newer)
    assert reshape.snapshot_stats(raws).count() == 2
    latest = {r.ts.isoformat()[:16]: r.temperature for r in reshape.hourly_latest(raws).collect()}
    assert latest == {TIMES[0]: 20.0, TIMES[1]: 21.0, TIMES[2]: 17.0}


def test_latest_hour_goes_by_instant_and_unreadable_hours_are_set_apart(spark, tmp_path):
    hourly = {**payload()["hourly"], "temperature_2m": [1.0, 2.0, 3.0]}
    earlier = payload(timestamp="2025-09-24T10:00:00+02:00", hourly=hourly)
    later = payload(timestamp="2025-09-24T09:00:00+00:00")
    unstamped = payload(timestamp="n/a", hourly={**hourly, "time": [TIMES[0], "soon", None]})
    raws = frame(spark, tmp_path, later, earlier, unstamped)
    latest = {r.ts.isoformat()[:16]: (r.temperature, r.snapshot.hour) for r in reshape.hourly_latest(raws).collect()}
    assert latest == dict(zip(TIMES, [(10.0, 9), (12.0, 9), (17.0, 9)]))
    assert [(r.time, r.temperature) for r in reshape.unreadable_hours(raws).orderBy("pos").collect()] == [("soon", 2.0), (None, 3.0)]
    assert "SortAggregate" not in reshape.hourly_latest(raws)._jdf.queryExecution().executedPlan().toString()


def test_both_dialects_become_one(spark, tmp_path):
    rows = reshape.unified_current(frame(spark, tmp_path, payload(), second_dialect())).orderBy("city").collect()
    assert [(r.city, r.temperature, r.windspeed, r.timestamp[:16]) for r in rows] == [
        ("Lyon", 36.0, 20.0, "2025-09-24T09:30"), ("Paris", 17.6, 11.9, "2025-09-24T09:00"),
    ]
    assert rows[0].humidity == 40.0 and rows[1].humidity is None


def test_pivot_has_a_column_per_given_city(spark, tmp_path):
    hourly = reshape.hourly_temperature(frame(spark, tmp_path, payload("Paris"), payload("Tokyo")))
    rows = reshape.pivot_by_city(hourly, ["Paris", "Rome"], F.avg("temperature")).collect()
    assert [(r.Paris, r.Rome) for r in rows] == [(13.0, None)]
