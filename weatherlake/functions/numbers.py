"""Rounding and number-to-text rules of the reports and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round to the nearest even, scale back: the rounding of data frame libraries."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def number_text(value: Column) -> Column:
    """Shortest decimal text of a double, such as 35.0, 0.00015, 1e-05 or 1.5e+16.

    Below 1e-3 and from 1e7 on, Spark's cast switches to an exponent. Down to 1e-4 and up to 1e16 those values go through
    a decimal; beyond, the exponent is written with a sign and two digits at least.
    """
    size, text = F.abs(value), value.cast("string")
    plain = ((size < 1e-3) & (size >= 1e-4)) | ((size >= 1e7) & (size < 1e16))
    digits = value.cast("decimal(38,22)").cast("string")
    decimal = F.regexp_replace(digits, r"(\.\d+?)0+$", "$1")
    power = F.regexp_extract(text, r"E-?(\d+)$", 1)
    sign = F.when(text.contains("E-"), "e-").otherwise("e+")
    mantissa = F.regexp_extract(text, r"^(.*?)(?:\.0)?E", 1)
    exponent = F.concat(mantissa, sign, F.when(F.length(power) < 2, F.concat(F.lit("0"), power)).otherwise(power))
    return F.when(plain, decimal).when(text.contains("E"), exponent).otherwise(text)


def fixed_text(value: Column, digits: int = 1) -> Column:
    """Text with a fixed number of decimals, ties rounded to even; null for null."""
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f", round_half_even(value, digits)))
