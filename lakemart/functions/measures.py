"""Column expressions of the trip models. All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapsed_seconds(start: str, end: str) -> Column:
    """Whole seconds between two timestamps."""
    return F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))


def in_units(seconds: Column, unit_seconds: int) -> Column:
    """`round(seconds / unit_seconds, 2)` of whole seconds, from 0 on.

    Counting half-up in whole hundredths gives the same value as `round` on a double, which builds a decimal object
    for every row.
    """
    return F.floor((seconds * 200 + unit_seconds) / (2 * unit_seconds)) / F.lit(100)


def seconds_range(low: float, high: float, unit_seconds: int) -> tuple[int, int]:
    """The whole seconds whose `in_units` value lies between `low` and `high`, both inclusive."""
    half = Fraction(1, 200)
    first = math.ceil((Fraction(str(low)) - half) * unit_seconds)
    last = math.ceil((Fraction(str(high)) + half) * unit_seconds) - 1
    return first, last


def percent_of(part: str, whole: str) -> Column:
    """`part` as a percentage of `whole`, rounded to two places. The caller guards a zero `whole`."""
    return F.round(F.col(part) / F.col(whole) * 100, 2).cast("double")


def month_of(day: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "month")
