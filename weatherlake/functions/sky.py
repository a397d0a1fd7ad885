"""Wind directions, wind speed classes and weather codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Compass points, clockwise from north, one per 22.5 degrees.
SECTORS = ["N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE", "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW"]
# Lower bounds of the wind speed classes in km/h.
SPEED_BINS = [0, 10, 20, 40, 60, 80]
# Groups of WMO weather codes (name, first code, last code).
CONDITIONS = [
    ("clear", 0, 0),
    ("cloudy", 1, 3),
    ("fog", 45, 48),
    ("drizzle", 51, 57),
    ("rain", 61, 67),
    ("snow", 71, 77),
    ("rain", 80, 82),
    ("snow", 85, 86),
    ("thunderstorm", 95, 99),
]


def sector_index(direction: Column) -> Column:
    """0..15, with north centred on 0 degrees."""
    return F.floor(F.pmod(direction + 11.25, F.lit(360.0)) / 22.5).cast("int")


def sector_name(index: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in SECTORS]), index)


def speed_bin(speed: Column) -> Column:
    """Lower bound of the speed class; null for a null speed."""
    label = F.when(speed < SPEED_BINS[1], SPEED_BINS[0])
    for lower, upper in zip(SPEED_BINS[1:], SPEED_BINS[2:]):
        label = label.when(speed < upper, lower)
    return label.when(speed >= SPEED_BINS[-1], SPEED_BINS[-1])


def condition(code: Column) -> Column:
    name, first, last = CONDITIONS[0]
    label = F.when(code.between(first, last), name)
    for name, first, last in CONDITIONS[1:]:
        label = label.when(code.between(first, last), name)
    return label.otherwise("unknown")
