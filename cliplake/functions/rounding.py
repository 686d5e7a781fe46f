"""Decimal rounding of doubles, exact: half to even on the binary value, as Dekker's product decides it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLIT = 134217729.0  # 2 ** 27 + 1, splits a double into two halves


def _units(x: Column, digits: int) -> Column:
    m = F.lit(float(10**digits))
    high = F.lit(SPLIT) * x - (F.lit(SPLIT) * x - x)
    low = x - high
    product = x * m
    error = (high * m - product) + low * m
    floor = F.floor(product).cast("double")
    above = (product - floor - 0.5) + error
    even = F.when(F.pmod(floor, F.lit(2.0)) == 0, floor).otherwise(floor + 1)
    return F.when(above > 0, floor + 1).when(above < 0, floor).otherwise(even)


def exact_round(x: Column, digits: int) -> Column:
    """``x`` rounded to 1 or 2 digits as the correctly rounded decimal of its binary value."""
    x = x.cast("double")
    return F.when(x < 0, -_units(-x, digits) / 10**digits).otherwise(_units(x, digits) / 10**digits)


def fixed2(x: Column) -> Column:
    """Text with exactly two decimals."""
    return F.format_string("%.2f", exact_round(x, 2))


def seconds(ms: Column) -> Column:
    """Milliseconds to seconds with one decimal."""
    return exact_round(ms / F.lit(1000.0), 1)


def hms(x: Column) -> Column:
    """Seconds as HH:MM:SS; hours may exceed 23."""
    s = F.floor(x).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("long"), F.floor((s % 3600) / 60).cast("long"), s % 60)
