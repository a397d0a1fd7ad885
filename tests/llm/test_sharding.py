import zlib

import cases
import pytest

from weatherlake.llm import queries, sharding


def assigned(spark, docs, shards=5, slots=64):
    records = sharding.records_of(docs, slots=slots)
    totals = sharding.slot_totals(records)
    return records, totals, sharding.first_map(totals, shards, slots)


@pytest.mark.parametrize("table", [cases.edge, cases.documents, cases.clashing])
def test_every_row_has_a_place(spark, table):
    docs = table(spark)
    records, totals, slot_map = assigned(spark, docs)
    got = sharding.assign(records, totals, slot_map).collect()
    want = [(r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect()]
    assert sorted(map(repr, ((r.doc_id, r["size"], r.text_crc32) for r in got))) == sorted(map(repr, want))
    for shard in range(5):
        places = sorted(r.slot for r in got if r.shard == shard)
        assert places == list(range(len(places)))


def test_sizes_are_near_equal(spark):
    got = queries.op5_sharding(spark, "/root/testdata/sf0.01").groupBy("shard").sum("size").collect()
    sizes = [row[1] for row in got]
    assert len(sizes) == 40 and max(sizes) < 1.02 * min(sizes)


def test_empty_table(spark):
    records, totals, slot_map = assigned(spark, cases.empty(spark))
    assert sharding.assign(records, totals, slot_map).count() == 0
    assert slot_map.count() == 64


def test_map_versions_are_kept_and_edits_move_little(spark, tmp_path):
    docs = cases.documents(spark)
    records, totals, slot_map = assigned(spark, docs, 5, 512)
    path = str(tmp_path / "map")
    sharding.write_map(slot_map, path)
    old = sharding.read_map(spark, path, 1)
    sharding.write_map(sharding.edited_map(old, totals, 6, 2), path)
    new = sharding.read_map(spark, path, 2)
    assert old.count() == new.count() == 512
    assert sharding.read_map(spark, path, 1).exceptAll(slot_map).isEmpty()
    sizes = [row[1] for row in sharding.assign(records, totals, new).groupBy("shard").sum("size").collect()]
    assert len(sizes) == 6 and max(sizes) < 1.3 * min(sizes)
    moved = old.alias("o").join(new.alias("n"), "vslot").join(totals, "vslot").where("o.shard <> n.shard")
    bytes_moved, everything = moved.groupBy().sum("bytes").first()[0], totals.groupBy().sum("bytes").first()[0]
    assert bytes_moved < 0.4 * everything


def test_fewer_shards_empty_the_last(spark):
    _, totals, slot_map = assigned(spark, cases.documents(spark), 5, 512)
    new = sharding.edited_map(slot_map, totals, 4, 2)
    assert {row.shard for row in new.select("shard").distinct().collect()} == {0, 1, 2, 3}


def test_no_shards_are_refused(spark):
    with pytest.raises(ValueError):
        assigned(spark, cases.empty(spark), 0)


def test_rows_that_share_an_id_or_have_none_are_spread(spark):
    rows = [(None if i % 3 else 7, f"{i} {cases.PROSE}", "en", "s", 1) for i in range(2000)]
    records, totals, slot_map = assigned(spark, spark.createDataFrame(rows, cases.SCHEMA), 5, 512)
    got = sharding.assign(records, totals, slot_map).groupBy("shard").sum("size").collect()
    sizes = [row[1] for row in got]
    assert len(sizes) == 5 and max(sizes) < 1.1 * min(sizes)


def test_a_version_is_written_once(spark, tmp_path):
    docs = cases.documents(spark)
    records, totals, slot_map = assigned(spark, docs)
    path = str(tmp_path / "map")
    sharding.write_map(slot_map, path)
    with pytest.raises(FileExistsError):
        sharding.write_map(sharding.first_map(totals, 3, 64), path)
    assert sharding.read_map(spark, path, 1).exceptAll(slot_map).isEmpty() and sharding.read_map(spark, path, 1).count() == 64
    # A broken write of the next version does not stand in the way.
    slot_map.select("vslot", "shard").write.parquet(f"{path}/version=2")
    (tmp_path / "map/version=2/_SUCCESS").unlink()
    sharding.write_map(sharding.edited_map(slot_map, totals, 6, 2), path)
    assert sharding.read_map(spark, path, 2).count() == 64
    assert sharding.assign(records, totals, sharding.read_map(spark, path, 2)).count() == docs.count()


@pytest.mark.parametrize("table", [cases.edge, cases.documents])
def test_shards_equal_a_plain_placement(spark, table):
    """Slots largest first, each on the lightest shard; rows numbered in their shard by slot, then id."""
    records, totals, slot_map = assigned(spark, table(spark), 5, 64)
    rows = [r.asDict() for r in records.collect()]
    loads, shard_of = [0] * 5, {slot: slot % 5 for slot in range(64)}
    sizes = {}
    for row in rows:
        sizes[row["vslot"]] = sizes.get(row["vslot"], 0) + row["size"]
    for slot in sorted(sizes, key=lambda s: (-sizes[s], s)):
        shard_of[slot] = loads.index(min(loads))
        loads[shard_of[slot]] += sizes[slot]
    counted = [0] * 5
    want = []
    for row in sorted(rows, key=lambda r: (r["vslot"], r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"], r["size"])):
        shard = shard_of[row["vslot"]]
        want.append((row["doc_id"], row["text_crc32"], shard, counted[shard]))
        counted[shard] += 1
    got = sharding.assign(records, totals, slot_map)
    assert sorted(map(repr, (tuple(r) for r in got.select("doc_id", "text_crc32", "shard", "slot").collect()))) == sorted(map(repr, want))
