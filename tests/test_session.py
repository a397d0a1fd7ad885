"""The scratch folder and literal frames."""

from pathlib import Path

import pytest

from weatherlake.session import clear_scratch, literal_frame, scratch_path


class Session:
    """What scratch_path uses of a session."""

    def __init__(self, master="local[2]", **conf):
        self.conf = {"spark.sql.warehouse.dir": "/work/warehouse", **conf}
        self.sparkContext = type("Context", (), {"applicationId": "app-1", "master": master})


def test_scratch_is_under_the_shared_folder_and_new_each_time():
    session = Session(**{"spark.checkpoint.dir": "hdfs://shared/scratch/"})
    first, second = scratch_path(session, "x"), scratch_path(session, "x")
    assert first.startswith("hdfs://shared/scratch/weatherlake/app-1/x-") and first != second


def test_a_local_session_without_a_checkpoint_folder_uses_its_warehouse():
    for master in ("local", "local[*]", "local[4,2]"):
        assert scratch_path(Session(master), "x").startswith("/work/warehouse/weatherlake/app-1/x-")


def test_a_cluster_needs_a_shared_folder():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            scratch_path(Session(master), "x")


def test_clear_scratch_removes_what_was_written(spark):
    path = scratch_path(spark, "x")
    spark.range(1).write.parquet(path)
    assert Path(path).exists()
    clear_scratch(spark)
    assert not Path(path).exists()


def test_literal_frame_has_a_size_and_may_be_empty(spark):
    df = literal_frame(spark, [("a", 1.0), ("b", None)], "k STRING, v DOUBLE")
    assert df.collect() == [("a", 1.0), ("b", None)]
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1000
    assert literal_frame(spark, [], "k STRING, v DOUBLE").columns == ["k", "v"]
