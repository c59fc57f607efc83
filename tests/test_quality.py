import datetime as dt

import pytest
from helpers import rows, ts

from lakemart.config import ConfigError, FreshnessConfig
from lakemart.operators import quality, reconcile
from lakemart.operators.quality import DataTestError, TableTests, enforce, freshness, run_tests
from lakemart.plans.trips import DAILY_TESTS, PAYMENT_TYPES, STAGED_TRIP_TESTS, TRIP_FRESHNESS


def test_row_and_value_tests(spark):
    df = spark.createDataFrame([(1, 0), (1, 6), (2, 7), (None, None), (None, 7)], "id int, code int")
    assert quality.not_null(df, "id").count() == 2
    assert rows(quality.unique(df, "id")) == [(1, 2)]
    assert rows(quality.accepted_values(df, "code", PAYMENT_TYPES)) == [(7, 2)]
    pairs = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert rows(quality.unique_combination(pairs, ["a", "b"])) == [(1, None, 2)]
    parents = spark.createDataFrame([(1,), (None,)], "pk int")
    assert rows(quality.relationships(df, "id", parents, "pk")) == [(2, 1)]
    assert quality.singular(df.where("code > 6")).count() == 2


def test_no_future(spark):
    now = ts("2024-01-01 12:00")
    df = spark.createDataFrame([(now,), (now + dt.timedelta(microseconds=1),), (None,)], "at timestamp_ntz")
    assert quality.no_future(df, "at", now).count() == 1
    assert quality.no_future(df, "at").count() == 0


@pytest.mark.parametrize("hours, status", [(24, "pass"), (25, "pass"), (26, "warn"), (49, "warn"), (50, "error")])
def test_freshness_limits(spark, hours, status):
    now = ts("2024-01-10")
    df = spark.createDataFrame([(now - dt.timedelta(hours=hours),)], "tpep_pickup_datetime timestamp_ntz")
    row = freshness(df, TRIP_FRESHNESS, now).first()
    assert (row.status, row.age_hours, row.future_rows) == (status, float(hours), 0)


def test_freshness_is_not_hidden_by_future_rows_or_emptiness(spark):
    now, config = ts("2024-01-10"), FreshnessConfig("at", 25, 49)
    df = spark.createDataFrame([(ts("2024-01-01"),), (ts("2088-01-01"),)], "at timestamp_ntz")
    assert tuple(freshness(df, config, now).first())[1::2] == (1, "error")
    assert freshness(df, config, now, ignore_future=False).first().status == "pass"
    assert freshness(df.where("false"), config, now).first().status == "error"


def test_suite_counts_failures_in_one_frame(spark):
    df = spark.createDataFrame(
        [(1, 0, ts("2024-01-01")), (1, 9, ts("2024-01-05")), (None, None, None)],
        "id int, code int, at timestamp_ntz",
    )
    tests = TableTests(
        "t", not_null=["id"], unique=["id"], accepted_values={"code": [0]},
        unique_combination=[["id", "code"]], no_future=["at"],
    )
    results = run_tests(df, tests, ts("2024-01-02"))
    assert rows(results, "test", "failures") == [
        ("accepted_values:code", 1), ("no_future:at", 1), ("not_null:id", 1), ("unique:id", 1),
        ("unique_combination:id,code", 0),
    ]
    with pytest.raises(DataTestError, match="unique:id: 1"):
        enforce(results)
    enforce(run_tests(df.where("id = 1 AND code = 0"), tests, ts("2024-01-02")))
    assert run_tests(df.where("false"), tests).where("failures > 0").count() == 0


def test_single_row_tests_share_one_scan(spark, tmp_path):
    spark.range(5).selectExpr("CAST(id AS INT) trip_date", "'x' pickup_borough", "id total_trips").write.parquet(
        f"{tmp_path}/m"
    )
    df = spark.read.parquet(f"{tmp_path}/m")
    plan = run_tests(df, TableTests("m", not_null=df.columns))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_declared_census():
    assert list(STAGED_TRIP_TESTS.not_null) == [
        "pickup_at", "dropoff_at", "trip_distance", "pickup_location_id", "total_amount",
    ]
    assert list(DAILY_TESTS.not_null) == ["trip_date", "pickup_borough", "total_trips"]


def test_latest_rows(spark):
    df = spark.createDataFrame([(1, "b"), (2, "b"), (2, "a"), (2, None)], "d int, k string")
    assert [tuple(r) for r in quality.latest_rows(df, "d", ["k"], 3).collect()] == [(2, None), (2, "a"), (2, "b")]


def test_reconciling_equal_and_different_tables(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "n int, s string")
    same = spark.createDataFrame([(None, 2), ("x", 1), ("x", 1)], "s string, n int")
    more = a.unionByName(a.where("n = 2"))
    assert reconcile.is_equal(a, same)
    assert tuple(reconcile.same_content(a, same).first()) == (3, 3, True)
    assert rows(reconcile.two_way_diff(a, more)) == [(2, None, 1, 2)]
    assert tuple(reconcile.same_content(a, more).first()) == (3, 4, False)
    assert tuple(reconcile.row_counts(a, more).first()) == (3, 4)
    assert tuple(reconcile.row_counts(a.where("false"), a).first()) == (0, 3)
    with pytest.raises(ConfigError, match="columns differ"):
        reconcile.two_way_diff(a, a.withColumnRenamed("s", "t"))


def test_hash_tells_swapped_nulls_apart(spark):
    a = spark.createDataFrame([("x", None)], "a string, b string")
    b = spark.createDataFrame([(None, "x")], "a string, b string")
    assert not reconcile.same_content(a, b).first().equal
