"""Expressions and table helpers that several operators use."""

from __future__ import annotations

import ctypes
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherlake.session import scratch_path

# White space of the word rule: the six ASCII blanks and nothing else.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"

# A key counts as hot when it holds more than this fraction of all rows, so fewer than HOT_KEYS keys can be hot.
HOT_KEYS = 1000

# Rows that a Python task works on at a time, whose working data and result it holds at once.
PART_ROWS = 1000


def ascii_lower(text: Column) -> Column:
    """Text with A-Z lower-cased and every other character as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """The runs of characters that are not blank, in order; null or blank text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def packed(df: DataFrame) -> Column:
    """The whole row as one struct, so that no working column can clash with a column of the input."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns])


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: its work is done once and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_keys(counts: DataFrame, rows: int, column: str = "n") -> DataFrame:
    """The keys with more than 1 / HOT_KEYS of `rows`, and the number of parts to split each into.

    `counts` has one row a key and its number of rows in `column`. Fewer than HOT_KEYS keys pass, whatever the
    size of the input, which bounds a broadcast of them; each part then holds about as many rows as the largest
    key that is not hot.
    """
    limit = max(1, rows // HOT_KEYS)
    return (
        counts.where(F.col(column) * HOT_KEYS > rows)
        .withColumn("parts", F.ceil(F.col(column) / limit).cast("int"))
        .drop(column)
    )


def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' rows in batches of up to PART_ROWS, without copying them."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(at, PART_ROWS)


def release_memory() -> None:
    """Gives back what earlier tasks of this worker freed; Arrow and the C library keep it for themselves otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)
