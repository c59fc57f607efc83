import datetime as dt

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from lakemart.config import ConfigError
from lakemart.functions.audit import AUDIT_COLUMNS, with_audit
from lakemart.functions.measures import in_units, seconds_range
from lakemart.operators import joins
from lakemart.operators.enrich import ENRICHED_COLUMNS, enrich
from lakemart.operators.joins import DuplicateKeyError, lookup_join, profile_side, spread_hot_keys
from lakemart.operators.marts import daily, daily_from_rollup, hourly, hourly_from_rollup, rollup

PICKUP = ts("2024-04-10 08:00:00")


def lasting(seconds):
    return {"dropoff_at": PICKUP + dt.timedelta(seconds=seconds)}


def test_duration_limits_are_inclusive(trip, zones):
    found = enrich(trip(lasting(59), lasting(60), lasting(18_000), lasting(18_001)), zones)
    assert rows(found, "trip_duration_minutes") == [(1.0,), (300.0,)]


@pytest.mark.parametrize("unit", [60, 3_600, 86_400])
def test_durations_agree_with_rounding(spark, unit):
    """Whole-number arithmetic gives the value of round() and the limits on it, at ties too."""
    around = [edge * unit + d for edge in (0, 1, 7, 300) for d in range(-unit // 100 - 40, unit // 100 + 40)]
    seconds = [s for s in around if s >= 0] + [10**9 + d for d in range(50)] + [unit * k // 200 for k in range(999)]
    first, last = seconds_range(1, 300, unit)
    s = F.col("s")
    checked = spark.createDataFrame([(x,) for x in seconds], "s long").select(
        F.round(s / unit, 2).alias("rounded"), in_units(s, unit).alias("counted"), s.between(first, last).alias("kept")
    )
    assert checked.where("rounded <> counted").count() == 0
    assert checked.where("kept <> (rounded BETWEEN 1 AND 300)").count() == 0
    assert checked.where("kept").count() > 0


def test_distance_limit_is_inclusive_and_null_is_dropped(trip, zones):
    found = enrich(trip({"trip_distance": 100.0}, {"trip_distance": 100.01}, {"trip_distance": None}), zones)
    assert rows(found, "trip_distance") == [(100.0,)]


def test_tip_percentage_needs_a_card_and_a_fare(trip, zones):
    cases = [
        {"vendor_id": 1},
        {"vendor_id": 2, "fare_amount": 0.0},
        {"vendor_id": 3, "payment_type": 2, "tip_amount": 0.0},
        {"vendor_id": 4, "tip_amount": None},
    ]
    assert rows(enrich(trip(*cases), zones), "vendor_id", "tip_pct") == [(1, 20.0), (2, None), (3, None), (4, None)]


def test_both_roles_and_unmatched_zone(trip, zones):
    found = enrich(trip({"vendor_id": 1}, {"vendor_id": 2, "pickup_location_id": 999}), zones)
    assert found.columns == ENRICHED_COLUMNS
    assert rows(found, "vendor_id", "pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough") == [
        (1, "Astoria", "Queens", "Norwood", "Bronx"),
        (2, None, None, "Norwood", "Bronx"),
    ]
    assert rows(daily(found), "pickup_borough", "total_trips") == [(None, 1), ("Queens", 1)]


def test_duplicate_zone_key_raises(trip, zones):
    with pytest.raises(DuplicateKeyError):
        enrich(trip({}), zones.unionByName(zones.limit(1)))


def test_null_zone_keys_do_not_count_as_duplicates(trip, zones):
    nulls = zones.withColumn("location_id", F.lit(None).cast("int"))
    assert enrich(trip({}), zones.unionByName(nulls)).count() == 1


def test_daily_measures(trip, zones):
    found = daily(
        enrich(
            trip(
                {},
                {"payment_type": 2, "tip_amount": 0.0, "total_amount": 10.0, "pickup_location_id": 3},
                {"fare_amount": 20.0, "tip_amount": 2.0, "total_amount": 22.0, "trip_distance": 5.0},
                {"payment_type": 0},
            ),
            zones,
        )
    )
    row = found.first().asDict()
    assert row == {
        "trip_date": dt.date(2024, 4, 10), "pickup_borough": "Queens", "total_trips": 4, "total_fare_usd": 50.0,
        "total_tips_usd": 6.0, "total_revenue_usd": 56.0, "avg_trip_distance_miles": 2.75,
        "avg_trip_duration_min": 20.0, "avg_tip_pct_credit_card": 15.0, "credit_card_trips": 2, "cash_trips": 1,
    }


def test_hourly_measures(trip, zones):
    later = {"pickup_at": ts("2024-04-10 09:30"), "dropoff_at": ts("2024-04-10 10:00")}
    found = hourly(enrich(trip({}, {}, later), zones))
    assert found.columns == [
        "trip_date", "pickup_hour", "pickup_borough", "total_trips", "avg_duration_min", "total_revenue_usd",
    ]
    assert rows(found.drop("trip_date")) == [(8, "Queens", 2, 20.0, 24.0), (9, "Queens", 1, 30.0, 12.0)]


def test_both_marts_from_one_rollup(trip, zones):
    later = {"pickup_at": ts("2024-04-10 09:30"), "dropoff_at": ts("2024-04-10 10:00"), "payment_type": 2}
    no_card = {"pickup_location_id": 2, "payment_type": 2}
    found = enrich(trip({}, {}, later, no_card, {"pickup_location_id": 9, "tip_amount": None}), zones)
    parts = rollup(found)
    assert rows(daily_from_rollup(parts)) == rows(daily(found))
    assert rows(hourly_from_rollup(parts)) == rows(hourly(found))
    assert daily_from_rollup(parts).columns == daily(found).columns


def test_unneeded_role_is_neither_joined_nor_read(spark, trip, zones, tmp_path):
    trip({}).write.parquet(f"{tmp_path}/t")
    found = daily(enrich(spark.read.parquet(f"{tmp_path}/t"), zones, roles=("pickup",)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1
    assert "dropoff_location_id" not in plan and "vendor_id" not in plan and "tolls_amount" not in plan


def test_audit_columns_are_constant_per_run(trip, zones):
    now = ts("2024-05-01 06:00")
    found = with_audit(daily(enrich(trip({}), zones)), "fct", "run-7", now)
    assert rows(found, *AUDIT_COLUMNS) == [(now, "run-7", "fct")]


# --- joins at scale -------------------------------------------------------------------------------------------


def test_profile_measures_rows_bytes_and_copies(spark):
    df = spark.createDataFrame([(1, "abc"), (1, "de"), (None, None), (None, "x"), (None, "y")], "k int, s string")
    profile = profile_side(df, ["k"])
    assert (profile.rows, profile.max_copies) == (5, 2)
    assert profile.bytes > 5
    empty = profile_side(df.where("k > 5"), ["k"])
    assert (empty.rows, empty.bytes, empty.max_copies) == (0, 0, 0)


@pytest.fixture
def tiny_bounds(monkeypatch):
    """Bounds so small that a few rows take the path of a big side with hot keys."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(joins, "HOT_ROWS", 10)


def test_large_side_with_hot_and_null_keys_gives_the_same_rows(spark, tiny_bounds):
    facts = spark.range(0, 600, numPartitions=7).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 3 = 1 THEN NULL ELSE CAST(id AS INT) END AS k"
    )
    dim = spark.range(0, 300).selectExpr("id AS key", "concat('n', id) AS name")
    found = lookup_join(facts, dim, "k", "key", {"name": "label"})
    assert found.columns == ["id", "k", "label"]
    expected = facts.join(dim.selectExpr("key", "name AS label"), facts.k == dim.key, "left").select("id", "k", "label")
    assert rows(found) == rows(expected)


def test_hot_key_is_spread_over_several_salts(spark, tiny_bounds):
    facts = spark.range(0, 250, numPartitions=10).selectExpr("id", "CASE WHEN id % 5 > 0 THEN 7L ELSE id END AS k")
    facts = facts.unionByName(spark.range(0, 30, numPartitions=6).selectExpr("id", "8L AS k"))
    dim = spark.createDataFrame([(7, "x"), (8, "y"), (9, "z")], "key long, name string")
    left, right = spread_hot_keys(facts, dim, ["k"], ["key"])
    # 200 rows need 20 salts of 10 rows, 30 rows need 3; the next powers of four are 64 and 4.
    assert rows(right.groupBy("key").count()) == [(7, 64), (8, 4), (9, 1)]
    spread = {r.k: r.n for r in left.groupBy("k").agg(F.count_distinct("_salt").alias("n")).collect()}
    assert spread[7] == 10 and spread[8] == 4
    assert set(n for k, n in spread.items() if k not in (7, 8)) == {1}


def test_key_types_are_brought_together_or_refused(spark, tiny_bounds):
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "key int, name string")
    for kind in ("double", "long", "int"):
        facts = spark.createDataFrame([(1,), (3,)], "k int").selectExpr(f"CAST(k AS {kind}) AS k")
        assert rows(lookup_join(facts, dim, "k", "key", {"name": "n"}), "n") == [(None,), ("x",)]
    with pytest.raises(ConfigError, match="key types differ"):
        lookup_join(facts.selectExpr("CAST(k AS STRING) AS k"), dim, "k", "key", {"name": "n"})


def test_join_strategy_follows_the_measured_size(spark, zones, trip, monkeypatch):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    small = plan(enrich(trip({}), zones))
    assert small.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
        large = plan(enrich(trip({}), zones))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in large and "CartesianProduct" not in large and "NestedLoop" not in large


def test_daily_mart_has_one_shuffle_and_partial_aggregation(trip, zones):
    plan = daily(enrich(trip({}), zones))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan


# --- sketches of keys -----------------------------------------------------------------------------------------


def test_sketches_merge_and_tell_hot_keys_by_weight(spark, tiny_bounds):
    left = spark.range(0, 250, numPartitions=10).selectExpr("CASE WHEN id % 5 > 0 THEN 7L ELSE id END AS k", "'a' AS s")
    right = spark.range(0, 30).selectExpr("8L AS k", "CAST(NULL AS STRING) AS s")
    keys = {"k": F.col("k"), "s": F.col("s")}
    parts = joins.key_sketches(left, keys).unionByName(joins.key_sketches(right, keys))
    assert parts.count() == 4
    hashes = {v: spark.range(1).select(F.xxhash64(F.lit(v).cast(t))).first()[0] for v, t in ((7, "bigint"), (8, "bigint"), ("a", "string"), (None, "string"))}
    found = joins.hot_in(joins.merged_sketches(parts))
    assert dict(found["k"]) == {hashes[7]: 64, hashes[8]: 4}
    assert dict(found["s"]) == {hashes["a"]: 64, hashes[None]: 4}
    assert joins.hot_in(joins.key_sketches(left.limit(0), keys)) == {"k": [], "s": []}


def test_both_roles_are_sketched_in_one_pass(spark, trip, zones, tiny_bounds, monkeypatch):
    trips = trip(*[{"pickup_location_id": 1 + i % 2, "dropoff_location_id": 3 if i % 4 else None} for i in range(80)])
    want = rows(enrich(trips, zones))
    passes = []
    sketch = joins.key_sketches
    monkeypatch.setattr(joins, "key_sketches", lambda df, keys: passes.append(list(keys)) or sketch(df, keys))
    monkeypatch.setattr(joins, "hot_keys", lambda *args: pytest.fail("keys are counted a second time"))
    found = enrich(trips, zones)
    assert rows(found) == want and passes == [["pickup_location_id", "dropoff_location_id"]]


def test_a_stream_splits_only_the_hot_keys_of_a_stored_sketch(spark, schema, tmp_path, tiny_bounds):
    data = spark.range(0, 60, numPartitions=4).selectExpr("CASE WHEN id % 3 > 0 THEN 1L ELSE id END AS k")
    data.write.parquet(str(tmp_path / "in"))
    dim = spark.range(0, 60).selectExpr("id AS key", "concat('n', id) AS v")
    hot = joins.hot_in(joins.key_sketches(data, {"k": F.col("k")}))["k"]
    stream = spark.readStream.schema("k long").parquet(str(tmp_path / "in"))
    _, right = spread_hot_keys(stream, dim, ["k"], ["key"], hot)
    copies = {r["key"]: r["count"] for r in right.groupBy("key").count().collect()}
    assert copies[1] == 4 and set(copies.values()) == {1, 4}
    joined = lookup_join(stream, dim, "k", "key", {"v": "v"}, hot=hot)
    query = joined.writeStream.format("memory").queryName("by_sketch").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("by_sketch")) == rows(data.selectExpr("k", "concat('n', k) AS v"))


def test_copies_of_a_side_that_is_too_large_are_not_broadcast_to_a_stream(spark, tmp_path, capsys):
    spark.range(20).select(F.col("id").alias("k")).write.parquet(f"{tmp_path}/in")
    dim = spark.range(5).select(F.col("id").alias("d"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    large = joins.SideProfile(joins.BROADCAST_ROWS + 1, 0, 1, ("d",))
    stream = spark.readStream.schema("k long").parquet(f"{tmp_path}/in")
    found = lookup_join(stream, dim, "k", "d", {"name": "name"}, large)
    found.explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    query = found.writeStream.format("memory").queryName("copies").trigger(availableNow=True)
    query.option("checkpointLocation", f"{tmp_path}/checkpoint").start().awaitTermination()
    assert rows(spark.table("copies")) == rows(spark.createDataFrame([(i, f"n{i}" if i < 5 else None) for i in range(20)], "k long, name string"))
