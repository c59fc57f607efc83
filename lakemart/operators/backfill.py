"""What a backfill has to cover, and proof that it touched only that."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.measures import month_of


def _dates(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("date").alias(column)).where(F.col(column).isNotNull()).distinct()


def missing_dates(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Dates that the source has and the target lacks. Both sides are at most one row per calendar day."""
    return _dates(source, column).join(_dates(target, column), column, "left_anti")


def missing_intervals(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """The fewest intervals that hold all missing dates and no date that the target has: low, high, days.

    Dates that neither side has do not end an interval. `days` counts the missing dates in it.
    """
    days = _dates(source, column).withColumn("s", F.lit(True)).join(
        _dates(target, column).withColumn("t", F.lit(True)), column, "full"
    )
    # One row for each calendar day: missing dates with the same number of present ones before them are neighbours.
    present = F.sum(F.when(F.col("t"), 1).otherwise(0)).over(Window.orderBy(column))
    missing = days.withColumn("_island", present).where(F.col("t").isNull())
    found = missing.groupBy("_island").agg(
        F.min(column).alias("low"), F.max(column).alias("high"), F.count(F.lit(1)).alias("days")
    )
    return found.select("low", "high", "days")


def within(column: str, intervals: Sequence[tuple[dt.date, dt.date]]) -> Column:
    """Whether the date of `column` lies in one of the intervals. Literals, so that they reach the scan."""
    day = F.col(column).cast("date")
    return reduce(Column.__or__, [day.between(F.lit(a), F.lit(b)) for a, b in intervals], F.lit(False))


def date_range(df: DataFrame, column: str) -> DataFrame:
    """One row: oldest and newest date."""
    day = F.col(column).cast("date")
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def find_gap(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """One row: date ranges of source and target, number of missing dates, oldest missing date and the lookback
    in days that reaches it (0 when nothing is missing before the newest target date)."""
    # One row per calendar day and side; a full join of the two then tells which dates are missing where.
    days = _dates(source, column).withColumn("s", F.lit(True)).join(
        _dates(target, column).withColumn("t", F.lit(True)), column, "full"
    )
    in_source, in_target, day = F.col("s").isNotNull(), F.col("t").isNotNull(), F.col(column)
    found = days.agg(
        F.min(F.when(in_source, day)).alias("source_min"),
        F.max(F.when(in_source, day)).alias("source_max"),
        F.min(F.when(in_target, day)).alias("target_min"),
        F.max(F.when(in_target, day)).alias("target_max"),
        F.coalesce(F.sum(F.when(in_target, 0).otherwise(1)), F.lit(0)).alias("missing_dates"),
        F.min(F.when(~in_target, day)).alias("oldest_missing"),
    )
    reach = F.greatest(F.date_diff("target_max", "oldest_missing"), F.lit(0))
    return found.withColumn("lookback_days", F.coalesce(reach, F.lit(0)))


def load_times_by_month(mart: DataFrame, date_column: str = "trip_date", loaded_at: str = "_loaded_at") -> DataFrame:
    """Rows and first and last load time per month, in order. After a backfill only its months are recent."""
    return (
        mart.groupBy(month_of(date_column).alias("month"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(loaded_at).alias("first_loaded"),
            F.max(loaded_at).alias("last_loaded"),
        )
        .orderBy("month")
    )
