"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_CITY = "Unknown"


def city_or_unknown(city: Column) -> Column:
    return F.coalesce(city, F.lit(UNKNOWN_CITY))


def fill(template: str, **columns: Column) -> Column:
    """Text with each {name} of the template replaced by that column's text."""
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [columns[part] if i % 2 else F.lit(part) for i, part in enumerate(parts) if part]
    return F.concat(*pieces)


def fill_column(template: Column, **columns: Column) -> Column:
    """The same with a column of templates; a name without a column stays as it is."""
    parts = F.split(template, r"(?=\{\w+\})|(?<=\})")

    def piece(part: Column) -> Column:
        chosen = F
        for name, column in columns.items():
            chosen = chosen.when(part == f"{{{name}}}", column)
        return chosen.otherwise(part)

    return F.array_join(F.transform(parts, piece), "")


def display_name(code: Column) -> Column:
    """heavy_rain -> Heavy Rain"""
    return F.initcap(F.replace(code, F.lit("_"), F.lit(" ")))


def pseudonym(identifier: Column, salt: str) -> Column:
    """Hex digest that stands for an identifier; the salt keeps it from being looked up."""
    return F.sha2(F.concat(F.lit(salt), identifier.cast("string")), 256)
