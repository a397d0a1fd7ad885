"""Expressions over the parallel arrays of one row; nothing here shuffles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zip_shortest(time: Column, **values: Column) -> Column:
    """Array of structs of `time` and the named values, as long as the shortest input; null counts as empty.

    `arrays_zip` alone pads the shorter arrays with nulls and is null if any input is null.
    """
    arrays = {"time": F.coalesce(time, F.array().cast("array<string>"))}
    for name, value in values.items():
        arrays[name] = F.coalesce(value, F.array().cast("array<double>"))
    length = F.least(*[F.size(a) for a in arrays.values()])
    return F.slice(F.arrays_zip(*[a.alias(name) for name, a in arrays.items()]), 1, length)


def array_sum(values: Column) -> Column:
    """Sum of the non-null elements; null if there are none."""
    return F.aggregate(
        values,
        F.lit(None).cast("double"),
        lambda total, x: F.coalesce(total + x, total, x),
    )


def array_mean(values: Column) -> Column:
    """Mean of the non-null elements; null if there are none."""
    return F.try_divide(array_sum(values), F.size(F.array_compact(values)))


def non_empty(values: Column) -> Column:
    return F.coalesce(F.size(values) > 0, F.lit(False))
