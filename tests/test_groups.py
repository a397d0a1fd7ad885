"""Consumer groups with resume points, and streams that read their rules again."""

import json

import pytest
from pyspark.sql import functions as F
from test_streaming import publish, rows

from weatherlake.operators.rules import BASIC, Rule, rule_frame
from weatherlake.sources import tables
from weatherlake.streaming import connect, groups, weather


class Consumer:
    """Keeps what a group was given, a folder a batch."""

    def __init__(self, spark, folder, group):
        self.spark, self.out, self.group = spark, f"{folder}/out-{group}", group
        self.channel, self.offsets, self.fails = connect.Channel(path=f"{folder}/in"), f"{folder}/offsets", None

    def handle(self, batch, number):
        if self.fails == "before":
            raise OSError("stopped")
        batch.write.mode("overwrite").json(f"{self.out}/{number}")
        if self.fails == "after":
            raise OSError("stopped")

    def drain(self, starting="earliest", **options):
        return groups.drain(self.spark, self.channel, self.group, self.offsets, self.handle, starting, **options)

    def had(self):
        try:
            return sorted(r.value for r in self.spark.read.schema(connect.MESSAGE_COLUMNS).json(f"{self.out}/*").collect())
        except Exception as error:
            assert "PATH_NOT_FOUND" in str(error)
            return []


def sent(spark, channel):
    return sorted(r.value for r in spark.read.schema(connect.MESSAGE_COLUMNS).json(channel.path).collect())


def test_two_groups_have_each_message_once(spark, tmp_path):
    first, second = Consumer(spark, tmp_path, "first"), Consumer(spark, tmp_path, "second")
    assert first.drain() == 0
    publish(spark, first.channel, rows(0, 10))
    assert first.drain() == 1 and first.had() == sent(spark, first.channel)
    before = sent(spark, first.channel)
    assert second.drain("latest") == 0 and second.had() == []
    assert first.drain() == 0
    for start in (10, 20):
        publish(spark, first.channel, rows(start, 10))
    # "latest" is only where a new group begins.
    assert second.drain("latest", max_files=1) >= 2 and first.drain() == 1
    publish(spark, first.channel, rows(30, 10))
    assert second.drain() >= 1 and first.drain() == 1
    everything = sent(spark, first.channel)
    assert first.had() == everything
    assert sorted(second.had() + before) == everything
    skipped = groups.positions(spark, second.offsets, "second").where("skipped")
    assert {row.batch for row in skipped.collect()} == {0}


@pytest.mark.parametrize("fails", ["before", "after"])
def test_a_run_that_broke_off_is_repeated_with_the_same_files(spark, tmp_path, fails):
    consumer = Consumer(spark, tmp_path, "g")
    publish(spark, consumer.channel, rows(0, 10))
    consumer.fails = fails
    with pytest.raises(OSError):
        consumer.drain()
    publish(spark, consumer.channel, rows(10, 10))
    planned = {row.file for row in groups.positions(spark, consumer.offsets, "g").collect()}
    consumer.fails = None
    assert consumer.drain() == 2 and consumer.had() == sent(spark, consumer.channel)
    position = groups.positions(spark, consumer.offsets, "g")
    assert {row.file for row in position.where("batch = 0").collect()} == planned
    assert position.count() == position.select("file").distinct().count()


def test_a_plan_that_is_not_complete_has_not_happened(spark, tmp_path):
    consumer = Consumer(spark, tmp_path, "g")
    publish(spark, consumer.channel, rows(0, 10))
    spark.createDataFrame([("g", 0, "x", False)], groups.PLANNED).write.parquet(f"{consumer.offsets}/group=g/batch=0")
    (tmp_path / "offsets/group=g/batch=0/_SUCCESS").unlink()
    assert consumer.drain() == 1 and consumer.had() == sent(spark, consumer.channel)


def test_a_group_that_began_at_latest_and_broke_off(spark, tmp_path):
    consumer = Consumer(spark, tmp_path, "g")
    publish(spark, consumer.channel, rows(0, 10))
    consumer.drain("latest")
    (tmp_path / "offsets/group=g/done-0").unlink()
    publish(spark, consumer.channel, rows(10, 10))
    assert consumer.drain("latest") == 1
    assert 0 < len(consumer.had()) < len(sent(spark, consumer.channel))


def test_names_and_channels(spark, tmp_path):
    for group in ("", "a/b", "_x"):
        with pytest.raises(ValueError, match="no name"):
            groups.positions(spark, str(tmp_path), group)
    with pytest.raises(ValueError, match="topic"):
        groups.drain(spark, connect.Channel(topic="t", servers="s"), "g", str(tmp_path), print)
    with pytest.raises(ValueError, match="starting"):
        groups.drain(spark, connect.Channel(path=str(tmp_path)), "g", str(tmp_path), print, "middle")


def test_rules_are_read_again_for_each_micro_batch(spark, tmp_path):
    source, rules, out, checkpoint = (str(tmp_path / name) for name in ("in", "rules", "out", "checkpoint"))
    channel = connect.Channel(path=source)

    def drain():
        stream = connect.stream_source(spark, connect.Channel(path=source, options={"maxFilesPerTrigger": "1"}))
        weather.update_rule_alerts(stream, rules, out, checkpoint, "basic").awaitTermination()
        return weather.read_rule_alerts(spark, out)

    publish(spark, channel, rows(0, 8))
    assert drain().count() == 0  # no table yet
    tables.publish_rules(rule_frame(spark, BASIC), rules)
    publish(spark, channel, rows(8, 20))
    first = drain()
    assert {r.rules_version for r in first.collect()} == {1}
    landed = spark.createDataFrame([(m,) for m in sent(spark, channel)], "value STRING")
    late = [json.loads(r.value) for r in weather.alert_message_stream(landed).collect()]
    assert first.count() == sum(m["timestamp"] >= "2025-09-24T02:40:00" for m in late) > 0
    before = sorted(map(str, first.collect()))

    cold = Rule("basic", "COLD", "temperature", "below", 100.0, "{city}: {value}")
    tables.publish_rules(rule_frame(spark, [cold]), rules)
    publish(spark, channel, rows(28, 6))
    second = drain()
    assert sorted(map(str, second.where("rules_version = 1").collect())) == before
    new = [json.loads(r.value) for r in second.where("rules_version = 2").collect()]
    assert len(new) == 6 and {m["alert"]["type"] for m in new} == {"COLD"}


def test_rules_change_between_two_micro_batches_of_one_run(spark, tmp_path, monkeypatch):
    source, rules, out = (str(tmp_path / name) for name in ("in", "rules", "out"))
    for first in (0, 20):
        publish(spark, connect.Channel(path=source), rows(first, 20))
    tables.publish_rules(rule_frame(spark, BASIC), rules)
    real, versions = weather.latest_version, []

    def replaced(spark, path):
        if versions:
            tables.publish_rules(rule_frame(spark, []), path)
        versions.append(real(spark, path))
        return versions[-1]

    monkeypatch.setattr(weather, "latest_version", replaced)
    stream = connect.stream_source(spark, connect.Channel(path=source, options={"maxFilesPerTrigger": "1"}))
    weather.update_rule_alerts(stream, rules, out, str(tmp_path / "checkpoint")).awaitTermination()
    assert versions[:2] == [1, 2] and len(versions) >= 2
    found = weather.read_rule_alerts(spark, out)
    assert found.where(F.col("rules_version") > 1).count() == 0
