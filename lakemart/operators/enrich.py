"""Trips joined to pickup and dropoff zones, with duration and tip percentage, without outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.measures import elapsed_seconds, in_units, percent_of, seconds_range
from lakemart.operators.joins import HotKeys, hot_lookup_keys, lookup_join, profile_side
from lakemart.operators.scd import join_as_of, require_disjoint

# Output columns, in order.
ENRICHED_COLUMNS = [
    "trip_date",
    "pickup_at",
    "dropoff_at",
    "pickup_hour",
    "day_of_week",
    "trip_distance",
    "passenger_count",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "payment_type",
    "trip_duration_minutes",
    "tip_pct",
    "pickup_location_id",
    "pickup_zone",
    "pickup_borough",
    "dropoff_location_id",
    "dropoff_zone",
    "dropoff_borough",
    "vendor_id",
]
ROLES = ("pickup", "dropoff")
# The marts group by pickup borough only. Leaving the other role out also leaves its column unread.
MART_ROLES = ("pickup",)


@dataclass(frozen=True)
class TripRules:
    """Outlier limits (inclusive) and codes. 1 to 300 minutes, 100 miles, card 1, cash 2."""

    min_duration: float = 1
    max_duration: float = 300
    max_distance: float = 100
    card: int = 1
    cash: int = 2
    duration_unit_seconds: int = 60


def measured(trips: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Add duration and tip percentage and drop outliers. It runs before any join, on trip columns alone.

    The limits apply to the rounded duration; they are compared as whole seconds, so only kept rows are rounded.
    """
    card_fare = (F.col("payment_type") == rules.card) & (F.col("fare_amount") > 0)
    seconds = elapsed_seconds("pickup_at", "dropoff_at")
    limits = seconds_range(max(rules.min_duration, 0), rules.max_duration, rules.duration_unit_seconds)
    kept = trips.where(F.col("trip_distance") <= rules.max_distance).where(seconds.between(*limits))
    return kept.withColumns(
        {
            "trip_duration_minutes": in_units(seconds, rules.duration_unit_seconds),
            "tip_pct": F.when(card_fare, percent_of("tip_amount", "fare_amount")),
        }
    )


def _columns(roles: Sequence[str]) -> list[str]:
    unused = {f"{r}_{c}" for r in ROLES if r not in roles for c in ("zone", "borough")}
    return [c for c in ENRICHED_COLUMNS if c not in unused]


def enrich(
    trips: DataFrame,
    zones: DataFrame,
    rules: TripRules = TripRules(),
    roles: Sequence[str] = ROLES,
    hot: Mapping[str, HotKeys] | None = None,
) -> DataFrame:
    """One row per kept trip with the zone and borough of both ends; an unknown zone gives nulls.

    `roles` limits the lookups to the ends that are needed. Where the zones are too large to be broadcast, one pass over
    the trips sketches the keys of all roles first; a stream of trips can pass the `hot` keys of a stored sketch.
    """
    profile = profile_side(zones, ["location_id"])
    rows = measured(trips, rules)
    keys = {role: f"{role}_location_id" for role in roles}
    if hot is None and not profile.broadcastable and not rows.isStreaming:
        hot = hot_lookup_keys(rows, zones, list(keys.values()), "location_id")
    for role in roles:
        rows = lookup_join(
            rows,
            zones,
            keys[role],
            "location_id",
            {"zone_name": f"{role}_zone", "borough": f"{role}_borough"},
            profile,
            hot=hot.get(keys[role]) if hot is not None else None,
        )
    return rows.select(*_columns(roles))


def enrich_as_of(
    trips: DataFrame, zone_history: DataFrame, rules: TripRules = TripRules(), roles: Sequence[str] = ROLES
) -> DataFrame:
    """Like `enrich`, but with the zone attributes that were valid at each end of the trip."""
    profile = profile_side(zone_history, ["location_id"])
    require_disjoint(zone_history, "location_id", profile)
    rows = measured(trips, rules)
    for role in roles:
        rows = join_as_of(
            rows,
            zone_history,
            f"{role}_location_id",
            "location_id",
            f"{role}_at",
            {"zone_name": f"{role}_zone", "borough": f"{role}_borough"},
            profile,
            validate=False,
        )
    return rows.select(*_columns(roles))
