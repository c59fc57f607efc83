import datetime as dt

import pytest
from helpers import rows, ts

from lakemart.config import StagingConfig
from lakemart.operators.staging import stage, union_sources
from lakemart.plans import trips as t

AS_OF = dt.date(2024, 5, 1)


def raw_trips(spark, cases, prefix="tpep"):
    base = dict(
        vendor=1, pickup=ts("2024-04-10 08:00"), dropoff=ts("2024-04-10 08:20"), passengers=1.0, distance=2.0,
        pu=1, do=2, pay=1, fare=10.0, tip=2.0, tolls=0.0, total=12.0,
    )
    data = [tuple({**base, **c}.values()) for c in cases]
    return spark.createDataFrame(data, t.raw_trip_schema(prefix))


def test_predicates_keep_exactly_the_valid_rows(spark):
    after = {"dropoff": ts("2024-06-01 00:00")}
    cases = [
        {},
        {"pickup": None},
        {"dropoff": None},
        {"dropoff": ts("2024-04-10 08:00")},
        {"distance": 0.0},
        {"distance": None},
        {"total": 0.0},
        {"total": -1.0},
        {"pickup": ts("2019-12-31 23:59:59")},
        {"pickup": ts("2020-01-01 00:00:00")},
        {"pickup": ts("2024-05-01 00:00:00"), **after},
        {"pickup": ts("2024-05-01 00:00:01"), **after},
    ]
    kept = rows(stage(raw_trips(spark, cases), t.yellow_trips(AS_OF)), "pickup_at")
    assert kept == [(ts("2020-01-01 00:00"),), (ts("2024-04-10 08:00"),), (ts("2024-05-01 00:00"),)]


def test_columns_come_in_configured_order_and_others_are_dropped(spark):
    raw = raw_trips(spark, [{}]).withColumnRenamed("VendorID", "vendorid").selectExpr("*", "1 AS unused")
    staged = t.stg_trips(raw, AS_OF)
    assert staged.columns == [
        "vendor_id", "pickup_at", "dropoff_at", "pickup_location_id", "dropoff_location_id", "passenger_count",
        "trip_distance", "payment_type", "fare_amount", "tip_amount", "tolls_amount", "total_amount", "trip_date",
        "pickup_hour", "day_of_week",
    ]
    assert rows(staged, "trip_date", "pickup_hour", "day_of_week") == [(dt.date(2024, 4, 10), 8, 4)]
    assert dict(staged.dtypes)["pickup_at"] == "timestamp_ntz"


def test_day_of_week_counts_from_sunday(spark):
    days = [{"pickup": ts(f"2024-04-0{d} 08:00")} for d in (6, 7, 8)]
    staged = stage(raw_trips(spark, days), t.yellow_trips(AS_OF))
    assert rows(staged, "pickup_at", "day_of_week") == [
        (ts("2024-04-06 08:00"), 7),
        (ts("2024-04-07 08:00"), 1),
        (ts("2024-04-08 08:00"), 2),
    ]


def test_second_source_by_configuration_only(spark):
    raw = raw_trips(spark, [{"pickup": ts("2019-01-01 10:00")}, {"total": 0.0}], "lpep")
    green = stage(raw, t.green_trips())
    yellow = stage(raw_trips(spark, [{}]), t.yellow_trips(AS_OF))
    assert green.columns == yellow.columns
    both = union_sources({"yellow": yellow, "green": green})
    assert rows(both, "source", "pickup_at") == [
        ("green", ts("2019-01-01 10:00")),
        ("yellow", ts("2024-04-10 08:00")),
    ]


def test_union_fills_columns_a_source_lacks(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2,)], "a int")
    assert rows(union_sources({"a": a, "b": b}), "a", "b", "source") == [(1, "x", "a"), (2, None, "b")]


def test_unusual_column_names_and_empty_filters(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "c.d"])
    config = StagingConfig("t", "raw", rename={"a b": "x", "c.d": "y"}, derived_columns={"z": "`a b` + 1"})
    assert rows(stage(df, config)) == [(1, 2, 2)]


def test_zone_staging_leaves_the_rescue_column_out(spark):
    raw = spark.createDataFrame(
        [(1, "N/A", "Z", "S", "junk")],
        "LocationID int, Borough string, Zone string, service_zone string, _rescued_data string",
    )
    assert t.stg_zones(raw).columns == ["location_id", "borough", "zone_name", "service_zone"]


@pytest.mark.parametrize("as_of", [None, dt.date(2024, 5, 1)])
def test_filters_reach_the_scan(spark, tmp_path, as_of):
    path = f"{tmp_path}/raw"
    raw_trips(spark, [{}]).write.parquet(path)
    staged = t.stg_trips(spark.read.parquet(path), as_of).select("trip_date", "total_amount")
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2020-01-01T00:00)" in plan
    assert "LessThanOrEqual(tpep_pickup_datetime" in plan
    assert "GreaterThan(trip_distance,0.0)" in plan
    assert "PULocationID" not in plan.split("ReadSchema")[1]
