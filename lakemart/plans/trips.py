"""The taxi-trip project: sources, staging, models and their tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakemart.config import DimensionConfig, FreshnessConfig, IncrementalConfig, Project, StagingConfig
from lakemart.operators.marts import DAILY_KEYS, HOURLY_KEYS
from lakemart.operators.quality import TableTests
from lakemart.operators.staging import stage

# Raw column names, accepted codes and boroughs, lookback days and freshness hours of the trip data.
PASSED_THROUGH = [
    "passenger_count",
    "trip_distance",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
]
PAYMENT_TYPES = [0, 1, 2, 3, 4, 5, 6]
BOROUGHS = ["Manhattan", "Queens", "Brooklyn", "Bronx", "Staten Island", "EWR", "N/A", "Unknown"]
YELLOW_SINCE = dt.date(2020, 1, 1)
LATE_ARRIVAL_DAYS = 3


def _trip_staging(table: str, pickup: str, dropoff: str, extra_filters: list[str]) -> StagingConfig:
    return StagingConfig(
        table=table,
        source_name="raw",
        rename={
            "VendorID": "vendor_id",
            pickup: "pickup_at",
            dropoff: "dropoff_at",
            "PULocationID": "pickup_location_id",
            "DOLocationID": "dropoff_location_id",
        },
        passthrough=PASSED_THROUGH,
        derived_columns={
            "trip_date": f"CAST({pickup} AS DATE)",
            "pickup_hour": f"HOUR({pickup})",
            "day_of_week": f"DAYOFWEEK({pickup})",
        },
        filters=[
            f"{pickup} IS NOT NULL",
            f"{dropoff} IS NOT NULL",
            f"{pickup} < {dropoff}",
            "trip_distance > 0",
            "total_amount > 0",
            *extra_filters,
        ],
    )


def yellow_trips(as_of: dt.date | None = None, since: dt.date = YELLOW_SINCE) -> StagingConfig:
    """Yellow trips between `since` and midnight of `as_of` (today by default)."""
    today = f"DATE'{as_of.isoformat()}'" if as_of else "CURRENT_DATE()"
    pickup = "tpep_pickup_datetime"
    limits = [f"{pickup} >= TIMESTAMP_NTZ'{since.isoformat()} 00:00:00'", f"{pickup} <= {today}"]
    return _trip_staging("yellow_trips_raw", pickup, "tpep_dropoff_datetime", limits)


def green_trips() -> StagingConfig:
    """Green trips: other raw time columns and no date limits."""
    return _trip_staging("green_trips_raw", "lpep_pickup_datetime", "lpep_dropoff_datetime", [])


def zone_lookup() -> StagingConfig:
    """Zones. The rescue column of the CSV load is left out by not listing it."""
    return StagingConfig(
        table="taxi_zone_lookup",
        source_name="raw",
        rename={"LocationID": "location_id", "Borough": "borough", "Zone": "zone_name"},
        passthrough=["service_zone"],
    )


def _fields(pairs: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs.items()])


def raw_trip_schema(prefix: str = "tpep") -> T.StructType:
    money = T.DoubleType()
    return _fields(
        {
            "VendorID": T.LongType(),
            f"{prefix}_pickup_datetime": T.TimestampNTZType(),
            f"{prefix}_dropoff_datetime": T.TimestampNTZType(),
            "passenger_count": T.DoubleType(),
            "trip_distance": T.DoubleType(),
            "PULocationID": T.LongType(),
            "DOLocationID": T.LongType(),
            "payment_type": T.LongType(),
            "fare_amount": money,
            "tip_amount": money,
            "tolls_amount": money,
            "total_amount": money,
        }
    )


ZONE_SCHEMA = _fields(
    {
        "LocationID": T.IntegerType(),
        "Borough": T.StringType(),
        "Zone": T.StringType(),
        "service_zone": T.StringType(),
    }
)

ZONES = DimensionConfig(
    name="taxi_zones",
    scd_type=2,
    business_key="location_id",
    tracked_columns=["zone_name", "borough", "service_zone"],
    reason="zones are renamed and reassigned, and old reports must stay explainable",
)
VENDORS = DimensionConfig(
    name="vendors",
    scd_type=1,
    business_key="vendor_id",
    reason="renames are rare and their history is not needed",
)
DRIVER_STATUS = DimensionConfig(
    name="driver_status",
    scd_type=2,
    business_key="driver_id",
    tracked_columns=["status", "license_type"],
    reason="past status is needed for compliance reports",
)
TRIP_FRESHNESS = FreshnessConfig("tpep_pickup_datetime", warn_after_hours=25, error_after_hours=49)


def trip_project(as_of: dt.date | None = None) -> Project:
    staging = [yellow_trips(as_of), green_trips(), zone_lookup()]
    incremental = [
        IncrementalConfig("fct_trips_daily", "trip_date", LATE_ARRIVAL_DAYS, DAILY_KEYS),
        IncrementalConfig("fct_trips_hourly", "trip_date", LATE_ARRIVAL_DAYS, HOURLY_KEYS),
    ]
    return Project(
        staging={c.table: c for c in staging},
        incremental={c.model: c for c in incremental},
        dimensions={d.name: d for d in (ZONES, VENDORS, DRIVER_STATUS)},
    )


def stg_trips(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return stage(raw, yellow_trips(as_of))


def stg_zones(raw: DataFrame) -> DataFrame:
    return stage(raw, zone_lookup())


STAGED_TRIP_TESTS = TableTests(
    "stg_trips",
    not_null=["pickup_at", "dropoff_at", "trip_distance", "pickup_location_id", "total_amount"],
    accepted_values={"payment_type": PAYMENT_TYPES},
    no_future=["pickup_at"],
    relationships=[("pickup_location_id", "stg_zones", "location_id")],
)
STAGED_ZONE_TESTS = TableTests(
    "stg_zones",
    not_null=["location_id", "borough"],
    unique=["location_id"],
    accepted_values={"borough": BOROUGHS},
)
DAILY_TESTS = TableTests(
    "fct_trips_daily",
    not_null=["trip_date", "pickup_borough", "total_trips"],
    unique_combination=[DAILY_KEYS],
)
HISTORY_TESTS = TableTests("zones_snapshot", not_null=["location_id", "valid_from"])
DIMENSION_TESTS = TableTests(
    "dim_taxi_zones", not_null=["location_id", "zone_name", "effective_from"], unique=["location_id"]
)
