"""Versions, replaced tables, retention and erasure of stored data."""

import os
from pathlib import Path

import pytest

from weatherlake.sources import daily, tables, upkeep
from weatherlake.sources.folders import Folder
from weatherlake.sources.versions import latest_version, publish_version, read_version

SCHEMA = "station LONG, value DOUBLE, obs_date DATE"


def days(spark, path, n=6, stations=5):
    rows = spark.range(n * stations).selectExpr(
        f"id % {stations} AS station", "CAST(id AS DOUBLE) AS value", f"date_add(DATE '2024-01-01', CAST(id DIV {stations} AS INT)) AS obs_date"
    )
    daily.write_daily(rows, path)
    return rows


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def ids(spark, *stations):
    return spark.createDataFrame([(s,) for s in stations], "station LONG")


def values(df):
    return sorted(row.value for row in df.collect())


def test_old_days_are_dropped_without_reading(spark, tmp_path):
    path = str(tmp_path / "data")
    days(spark, path)
    for file in files(path):
        (tmp_path / "data" / file).write_bytes(b"no parquet")
    (tmp_path / "data/obs_date=__HIVE_DEFAULT_PARTITION__").mkdir()
    assert upkeep.drop_days(spark, path, "2024-01-06", 2) == [f"obs_date=2024-01-0{i}" for i in (1, 2, 3)]
    assert sorted(p.name for p in (tmp_path / "data").glob("obs_date=*")) == [
        "obs_date=2024-01-04", "obs_date=2024-01-05", "obs_date=2024-01-06", "obs_date=__HIVE_DEFAULT_PARTITION__"
    ]
    assert upkeep.drop_days(spark, path, "2024-01-06", 2) == []
    assert upkeep.drop_days(spark, str(tmp_path / "none"), "2024-01-06", 2) == []


def test_erasure_rewrites_only_files_with_listed_rows(spark, tmp_path):
    path = str(tmp_path / "data")
    days(spark, path)
    extra = spark.createDataFrame([(77, 1000.0, "2024-01-03")], "station LONG, value DOUBLE, obs_date STRING").selectExpr(
        "station", "value", "CAST(obs_date AS DATE) AS obs_date"
    )
    extra.write.mode("append").partitionBy("obs_date").parquet(path)
    before = files(path)
    removed = upkeep.erase_stored(spark, path, ids(spark, 77, 999), "station", SCHEMA)
    assert len(removed) == 1 and "obs_date=2024-01-03" in removed[0]
    after = files(path)
    assert {name: time for name, time in before.items() if name not in removed} == after
    assert values(upkeep.read_stored(spark, path, SCHEMA)) == [float(i) for i in range(30)]
    # A run again, or with other identifiers that are not there, changes nothing.
    assert upkeep.erase_stored(spark, path, ids(spark, 77, 999), "station", SCHEMA) == [] and files(path) == after
    assert not list(Path(path).glob("_*erasure*"))

    removed = upkeep.erase_stored(spark, path, ids(spark, 3), "station", SCHEMA)
    assert len(removed) == 6
    assert values(upkeep.read_stored(spark, path, SCHEMA)) == [float(i) for i in range(30) if i % 5 != 3]
    assert values(spark.read.schema(SCHEMA).parquet(path)) == [float(i) for i in range(30) if i % 5 != 3]


def test_rows_without_an_identifier_and_days_without_a_name_stay(spark, tmp_path):
    path = str(tmp_path / "data")
    rows = spark.createDataFrame([(None, 1.0, None), (1, 2.0, None), (None, 3.0, "a")], "station LONG, value DOUBLE, obs_date STRING")
    rows.write.partitionBy("obs_date").parquet(path)
    schema = "station LONG, value DOUBLE, obs_date STRING"
    upkeep.erase_stored(spark, path, ids(spark, 1), "station", schema)
    assert values(upkeep.read_stored(spark, path, schema)) == [1.0, 3.0]


@pytest.mark.parametrize("steps", range(8))
def test_an_erasure_that_breaks_off_is_undone_or_finished(spark, tmp_path, monkeypatch, steps):
    """It breaks off after each number of renames and deletions; a reader sees the old or the new rows, a rerun the new."""
    path = str(tmp_path / "data")
    days(spark, path, n=2)
    old, new = [float(i) for i in range(10)], [float(i) for i in range(10) if i % 5 != 3]
    left = [steps]
    real = {name: getattr(Folder, name) for name in ("move", "delete")}

    def counted(name):
        def run(self, *args):
            if left[0] == 0:
                raise OSError("stopped")
            left[0] -= 1
            return real[name](self, *args)

        return run

    for name in real:
        monkeypatch.setattr(Folder, name, counted(name))
    try:
        upkeep.erase_stored(spark, path, ids(spark, 3), "station", SCHEMA)
        ended = True
    except OSError:
        ended = False
    for name, method in real.items():
        monkeypatch.setattr(Folder, name, method)
    committed = steps >= 1  # the first rename is the commit
    assert values(upkeep.read_stored(spark, path, SCHEMA)) == (new if committed else old)
    upkeep.erase_stored(spark, path, ids(spark, 3), "station", SCHEMA)
    assert values(upkeep.read_stored(spark, path, SCHEMA)) == values(spark.read.schema(SCHEMA).parquet(path)) == new
    assert not list(Path(path).glob("_*erasure*")) and (ended or steps < 7)


def test_erasure_of_an_empty_data_set(spark, tmp_path):
    assert upkeep.erase_stored(spark, str(tmp_path / "none"), ids(spark, 1), "station", SCHEMA) == []
    assert upkeep.read_stored(spark, str(tmp_path / "none"), SCHEMA).count() == 0


def test_versions_count_once_they_are_complete(spark, tmp_path):
    path = str(tmp_path / "versions")
    assert latest_version(spark, path) is None and read_version(spark, path, "id LONG").count() == 0
    assert [publish_version(spark.range(n), path) for n in (1, 2, 3)] == [1, 2, 3]
    assert sorted(os.listdir(path)) == ["version=2", "version=3"]
    (tmp_path / "versions/version=3/_SUCCESS").unlink()
    assert latest_version(spark, path) == 2 and read_version(spark, path, "id LONG").count() == 2
    # An incomplete version is never written over.
    assert publish_version(spark.range(5), path) == 4


def test_a_replaced_table_is_never_half_written(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.replace_table(spark.range(3), "swapped_table", path)
    reader = spark.table("swapped_table")
    tables.replace_table(spark.range(4).selectExpr("id AS other", "'x' AS more"), "swapped_table", path)
    assert reader.count() == 3
    assert spark.table("swapped_table").columns == ["other", "more"] and spark.table("swapped_table").count() == 4

    failing = spark.range(10).selectExpr("id AS other", "CAST(raise_error('broken') AS STRING) AS more")
    with pytest.raises(Exception, match="broken"):
        tables.replace_table(failing, "swapped_table", path)
    assert spark.table("swapped_table").count() == 4
    tables.replace_table(spark.range(1), "swapped_table", path)
    assert spark.table("swapped_table").count() == 1


def test_small_files_are_whole(spark, tmp_path):
    folder = Folder(spark, str(tmp_path))
    folder.write("a/b", "é1")
    assert folder.read("a/b") == "é1" and folder.has("a/b") and not folder.has("a/c")
    assert folder.names("*") == ["a"] and folder.data_files() == ["a/b"]
