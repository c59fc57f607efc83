"""Daily and hourly aggregates. Each is one partial and one final hash aggregate around a single shuffle.

The partial step leaves at most one row per group and task, so a borough that holds most trips costs no more to
shuffle than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.enrich import TripRules

DAILY_KEYS = ["trip_date", "pickup_borough"]
HOURLY_KEYS = ["trip_date", "pickup_hour", "pickup_borough"]


def _count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def daily_measures(rules: TripRules = TripRules()) -> list[Column]:
    card = F.col("payment_type") == rules.card
    return [
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("fare_amount").alias("total_fare_usd"),
        F.sum("tip_amount").alias("total_tips_usd"),
        F.sum("total_amount").alias("total_revenue_usd"),
        F.avg("trip_distance").alias("avg_trip_distance_miles"),
        F.avg("trip_duration_minutes").alias("avg_trip_duration_min"),
        F.avg(F.when(card, F.col("tip_pct"))).alias("avg_tip_pct_credit_card"),
        _count_where(card).alias("credit_card_trips"),
        _count_where(F.col("payment_type") == rules.cash).alias("cash_trips"),
    ]


def hourly_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_trips"),
        F.avg("trip_duration_minutes").alias("avg_duration_min"),
        F.sum("total_amount").alias("total_revenue_usd"),
    ]


# Sums and counts that both marts can be finished from. The averages are kept as their two parts.
_SUMS = {"fare": "fare_amount", "tip": "tip_amount", "total": "total_amount"}
_MEANS = {"distance": "trip_distance", "duration": "trip_duration_minutes"}


def rollup(enriched: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Partial aggregates at the hourly grain. When both marts are rebuilt, the trips are read once for both."""
    card = F.col("payment_type") == rules.card
    means = {**{n: F.col(c) for n, c in _MEANS.items()}, "tip_pct": F.when(card, F.col("tip_pct"))}
    return enriched.groupBy(*HOURLY_KEYS).agg(
        F.count(F.lit(1)).alias("trips"),
        *[F.sum(c).alias(f"sum_{n}") for n, c in _SUMS.items()],
        *[F.sum(c).alias(f"sum_{n}") for n, c in means.items()],
        *[F.count(c).alias(f"n_{n}") for n, c in means.items()],
        _count_where(card).alias("card"),
        _count_where(F.col("payment_type") == rules.cash).alias("cash"),
    )


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))


def daily_from_rollup(parts: DataFrame) -> DataFrame:
    """The daily mart, finished from `rollup`."""
    return parts.groupBy(*DAILY_KEYS).agg(
        F.sum("trips").alias("total_trips"),
        F.sum("sum_fare").alias("total_fare_usd"),
        F.sum("sum_tip").alias("total_tips_usd"),
        F.sum("sum_total").alias("total_revenue_usd"),
        _mean("distance").alias("avg_trip_distance_miles"),
        _mean("duration").alias("avg_trip_duration_min"),
        _mean("tip_pct").alias("avg_tip_pct_credit_card"),
        F.sum("card").alias("credit_card_trips"),
        F.sum("cash").alias("cash_trips"),
    )


def hourly_from_rollup(parts: DataFrame) -> DataFrame:
    """The hourly mart, which has the grain of `rollup`: no further shuffle."""
    return parts.select(
        *HOURLY_KEYS,
        F.col("trips").alias("total_trips"),
        F.try_divide("sum_duration", "n_duration").alias("avg_duration_min"),
        F.col("sum_total").alias("total_revenue_usd"),
    )


def daily(enriched: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """One row per date and pickup borough; trips without a borough form their own group."""
    return enriched.groupBy(*DAILY_KEYS).agg(*daily_measures(rules))


def hourly(enriched: DataFrame) -> DataFrame:
    """One row per date, hour and pickup borough."""
    return enriched.groupBy(*HOURLY_KEYS).agg(*hourly_measures())
