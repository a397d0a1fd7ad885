"""Shards through fixed virtual slots: records hash to slots for ever, and a stored map sends slots to shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weatherlake.sources.folders import Folder
from weatherlake.sources.versions import version_path

SLOTS = 8192
ROW_BYTES = 16


def slot_of(key: Column, text: Column, slots: int = SLOTS) -> Column:
    """The slot by id and text, so that rows without an id or with one id are spread, if their texts differ."""
    return F.pmod(F.xxhash64(key, text), F.lit(slots)).cast("int")


def slot_totals(records: DataFrame) -> DataFrame:
    """Bytes and rows of each slot that has any, from columns `vslot` and `size`: at most as many rows as slots."""
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def placed(pool: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """Puts the pool's slots, largest first, each on the shard with the fewest bytes so far.

    `pool` has vslot and bytes, `loads` has shard and bytes. Both are no larger than the number of slots, so the
    choice is one expression over one row.
    """
    both = pool.select("vslot", "bytes", F.lit(None).cast("int").alias("shard")).unionByName(
        loads.select(F.lit(None).cast("int").alias("vslot"), "bytes", "shard")
    )
    largest_first = F.struct((-F.col("bytes")).alias("less"), F.col("vslot").alias("vslot"))
    one = both.agg(
        F.sort_array(F.collect_list(F.when(F.col("shard").isNull(), largest_first))).alias("pool"),
        F.map_from_entries(F.collect_list(F.when(F.col("shard").isNotNull(), F.struct("shard", "bytes")))).alias("held"),
    )
    start = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0).cast("long"))
    )

    def step(state: Column, slot: Column) -> Column:
        lightest = F.array_position(state["loads"], F.array_min(state["loads"])) - 1
        return F.struct(
            F.transform(state["loads"], lambda load, i: F.when(i == lightest, load - slot["less"]).otherwise(load)).alias("loads"),
            F.concat(state["out"], F.array(F.struct(slot["vslot"].alias("vslot"), lightest.cast("int").alias("shard")))).alias("out"),
        )

    empty = F.array().cast("array<struct<vslot:int,shard:int>>")
    return one.withColumn("start", start).select(
        F.inline(F.aggregate("pool", F.struct(F.col("start").alias("loads"), empty.alias("out")), step, lambda s: s["out"]))
    )


def first_map(totals: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1 of the map, for all slots: version, vslot, shard. Slots without rows are dealt in turn."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    spark = totals.sparkSession
    none = spark.range(0).select(F.col("id").cast("int").alias("shard"), F.col("id").alias("bytes"))
    return _whole(spark.range(slots), placed(totals, none, shards), F.pmod("vslot", F.lit(shards)), 1)


def edited_map(old: DataFrame, totals: DataFrame, shards: int, version: int) -> DataFrame:
    """The next version for new totals or another number of shards; only slots that must move do.

    A shard keeps its smallest slots up to the mean load. The slots above it, and those of shards that no longer
    exist, go to the lightest shards.
    """
    now = old.join(totals, "vslot", "left").select(
        "vslot", "shard", F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes")
    )
    rising = Window.partitionBy("shard").orderBy("bytes", "vslot")
    marked = now.withColumns({"upto": F.sum("bytes").over(rising), "all": F.sum("bytes").over(Window.partitionBy())})
    stays = (F.col("shard") < shards) & (F.col("upto") * shards <= F.col("all"))
    kept = marked.where(stays).select("vslot", "shard", "bytes")
    moved = marked.where(~stays).select("vslot", "bytes")
    loads = kept.groupBy("shard").agg(F.sum("bytes").alias("bytes"))
    chosen = kept.select("vslot", "shard").unionByName(placed(moved, loads, shards))
    return chosen.select(F.lit(version).alias("version"), "vslot", "shard")


def _whole(slots: DataFrame, chosen: DataFrame, spare: Column, version: int) -> DataFrame:
    every = slots.select(F.col("id").cast("int").alias("vslot"))
    return every.join(chosen, "vslot", "left").select(
        F.lit(version).alias("version"), "vslot", F.coalesce("shard", spare).cast("int").alias("shard")
    )


def write_map(slot_map: DataFrame, path: str) -> None:
    """Adds a version to the stored map. A version that is there is never changed: writing it again is an error.

    What a run that broke off left of a version does not count and is replaced.
    """
    versions = [row.version for row in slot_map.select("version").distinct().limit(2).collect()]
    if len(versions) != 1:
        raise ValueError("a map has one version")
    folder = Folder(slot_map.sparkSession, path)
    if versions[0] in folder.numbered("version"):
        raise FileExistsError(f"version {versions[0]} of the map is there")
    slot_map.select("vslot", "shard").coalesce(1).write.mode("overwrite").parquet(version_path(path, versions[0]))


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    rows = spark.read.schema("vslot INT, shard INT").parquet(version_path(path, version))
    return rows.select(F.lit(version).alias("version"), "vslot", "shard")


def records_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text and 16), text_crc32 and vslot of each row; null text has no bytes."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    key = F.col(f"`{id_column}`")
    return docs.select(
        key.alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        slot_of(key, text, slots).alias("vslot"),
    )


def assign(records: DataFrame, totals: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Each record with its shard, and its place in the shard counted from 0 without gaps.

    A shard is never gathered: the map knows how many rows lie before each slot, and rows are numbered inside
    their slot by id. The table sent to all executors has one row a slot.
    """
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slot_map.join(totals, "vslot").select(
        "vslot", "shard", "version", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    numbered = records.withColumn("place", F.row_number().over(inside))
    return numbered.join(F.broadcast(offsets), "vslot").select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("before") + F.col("place") - 1).cast("long").alias("slot"),
        "vslot",
        F.col("version").alias("map_version"),
    )
