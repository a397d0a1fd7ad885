"""Small tables for the tests, with the rows that are easily got wrong."""

from __future__ import annotations

import re

LONG = " ".join(f"w{i % 997}x{i}" for i in range(40_000))
PROSE = "The quick brown fox jumps over the lazy dog and runs to the river, which is wide and deep at this time of the year."
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"

EDGE_ROWS = [
    (1, PROSE, "en", "a", 1),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \t\n ", "en", "b", 4),
    (5, PROSE, "en", "a", 1),
    (5, PROSE, "en", "a", 1),
    (6, PROSE.upper(), "xx", "", 1),
    (7, LONG, "en", "b", 1),
    (None, PROSE + " More.", "en", None, 1),
    (8, "one two", "de", "c", 7),
    (9, "é　ß\x00 中文字 😀 ﻿ x y", "de", "é", 7),
    (10, "one two three four five\none two three four five\none two three four five", "en", "c", 3),
]


def edge(spark):
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows."""
    return spark.createDataFrame(EDGE_ROWS, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


CLASHING = ["row", "id", "hash", "norm", "part", "size", "n", "node", "bucket", "bands", "set_key", "words", "kind", "match", "s", "old", "kept", "text_sha256", "target", "times", "below", "component_id"]


def clashing(spark):
    """The edge rows with further columns named like those that operators work with."""
    return edge(spark).selectExpr("*", *[f"'{name}' AS `{name}`" for name in CLASHING])


def documents(spark, n=None):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs if n is None else docs.orderBy("doc_id").limit(n)


WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate(LOWER)


def rows(df):
    return [row.asDict() for row in df.collect()]


def by_id(df):
    return {row["doc_id"]: row for row in rows(df)}
