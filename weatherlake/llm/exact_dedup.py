"""Exact duplicates: group by a 128-bit content hash and compare bytes inside the groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherlake.llm.common import HOT_KEYS, ascii_lower, packed, stored

# Hashes or groups up to this number are sent to all executors (about 100 bytes each).
FEW_GROUPS = 200_000
# Parts that rows of a hot group are dealt over where groups are joined by hash.
PARTS = 64


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def _normal(text_column: str, normalise: Callable[[Column], Column]) -> Column:
    return normalise(F.coalesce(F.col(f"`{text_column}`"), F.lit("")))


def copy_groups(
    docs: DataFrame, id_column: str, text_column: str, normalise: Callable[[Column], Column], hash_of: Callable[[Column], Column]
) -> DataFrame:
    """hash, text_sha256, keep_id, group_size, tied: a row for each text of the hashes that two rows or more have.

    Rows are counted by hash first, without their texts. Only texts of hashes that occur again are moved, after the
    copies in a task have become one; the grouping's key holds the text after the hash, so texts that
    share a hash are compared byte by byte, and a collision only gives two groups. `tied` tells that several rows of
    the group have the id that is kept.
    """
    norm, key = _normal(text_column, normalise), F.col(f"`{id_column}`")
    hashes = stored(docs.select(key.alias("id"), hash_of(norm).alias("hash")), "hashes")
    again = stored(hashes.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "repeated-hashes")
    few = again.count() <= FEW_GROUPS
    texts = docs.select(key.alias("id"), norm.alias("norm")).withColumn("hash", hash_of(F.col("norm")))
    texts = texts.join(F.broadcast(again) if few else again, "hash", "left_semi")
    groups = texts.groupBy("hash", "norm").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = stored(groups.select("hash", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size"), "groups")
    # Rows that share hash and id: copies that repeat the id, or of a collision, where this says tied once too often.
    repeats = hashes.groupBy("hash", F.col("id").alias("keep_id")).agg(F.count("*").alias("n")).where("n > 1")
    tied = repeats.select("hash", F.col("keep_id").alias("tied_id"), F.lit(True).alias("tied"))
    same = (groups["hash"] == tied["hash"]) & groups["keep_id"].eqNullSafe(tied["tied_id"])
    marked = groups.join(tied, same, "left").select(groups["*"], F.coalesce("tied", F.lit(False)).alias("tied"))
    return stored(marked, "copy-groups")


def mark_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    normalise: Callable[[Column], Column] = ascii_lower,
    hash_of: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: `row` (the input row as a struct), `keep_id`, `group_size`, `kept`, `text_sha256`.

    Texts are equal when their normalised bytes are; null text counts as empty, so null and empty texts are copies
    of each other. Of equal texts the row with the largest id stays; a null id is smaller than any other. Rows that
    repeat an id and its text count as copies, and exactly one of them is kept. An empty table gives an empty result.

    The groups of copies, found by `copy_groups`, are joined back by hash and digest. If they are few, no row is
    moved for that; else rows meet them by hash, with those of groups of more than a thousandth of all rows dealt over parts.
    """
    groups = copy_groups(docs, id_column, text_column, normalise, hash_of)
    norm = _normal(text_column, normalise)
    rows = docs.select(packed(docs).alias("row"), F.col(f"`{id_column}`").alias("id"), norm.alias("norm"))
    rows = rows.select("row", "id", hash_of(F.col("norm")).alias("hash"), F.sha2("norm", 256).alias("text_sha256"))
    keys = ["hash", "text_sha256"]
    if groups.count() <= FEW_GROUPS:
        joined = rows.join(F.broadcast(groups), keys, "left")
    else:
        # Fewer than HOT_KEYS groups are hot. Their rows get parts of their own, and so do copies of the groups.
        total = docs.count()
        hot = F.broadcast(groups.where(F.col("group_size") * HOT_KEYS > total).select(*keys, F.lit(PARTS).alias("parts")))
        part = F.pmod(F.monotonically_increasing_id(), F.coalesce("parts", F.lit(1))).cast("int")
        dealt = rows.join(hot, keys, "left").withColumn("part", part).drop("parts")
        every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
        copied = groups.join(hot, keys, "left").withColumn("part", every).drop("parts")
        joined = dealt.join(copied, [*keys, "part"], "left")
    in_group = F.col("group_size").isNotNull()
    chosen = ~in_group | F.col("id").eqNullSafe(F.col("keep_id"))
    columns = [
        "row",
        F.when(in_group, F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("kept"),
        "text_sha256",
    ]
    if groups.where("tied").isEmpty():
        return joined.withColumn("kept", chosen).select(*columns)
    # Rows that repeat the kept id are numbered, once and for all, and the first of each group stays.
    repeats = F.coalesce("tied", F.lit(False)) & chosen
    numbered = stored(joined.where(repeats).withColumn("number", F.monotonically_increasing_id()), "tied-rows")
    first = numbered.groupBy(*keys).agg(F.min("number").alias("number")).withColumn("kept", F.lit(True))
    tied = numbered.join(first, [*keys, "number"], "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    return joined.where(~repeats).withColumn("kept", chosen).select(*columns).unionByName(tied.select(*columns))


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with the input's columns."""
    return mark_copies(docs, id_column, text_column).where("kept").select("row.*")
