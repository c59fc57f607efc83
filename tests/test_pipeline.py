import datetime as dt
import uuid

import pytest
from helpers import rows, ts

from lakemart.config import ConfigError
from lakemart.functions.audit import without_audit
from lakemart.operators.quality import DataTestError
from lakemart.plans import trips as t
from lakemart.plans.pipeline import Warehouse
from lakemart.session import build_session, scratch_path, shared_dir, stable
from lakemart.sources.ingest import IngestConfig, ingest_files


@pytest.fixture
def warehouse(spark, tmp_path):
    mark = uuid.uuid4().hex
    raw = f"raw_{mark}"
    spark.sql(f"CREATE DATABASE {raw} LOCATION '{tmp_path}/{raw}'")
    return Warehouse(
        spark, f"dev_{mark}", raw, t.trip_project(dt.date(2024, 6, 1)), location=f"{tmp_path}/warehouse"
    )


def trips(spark, *cases):
    data = [
        (1, ts(at), ts(at) + dt.timedelta(minutes=20), 1.0, 2.0, zone, 2, 1, 10.0, 2.0, 0.0, 12.0)
        for at, zone in cases
    ]
    return spark.createDataFrame(data, t.raw_trip_schema())


def test_whole_warehouse_from_landed_files(spark, tmp_path, warehouse):
    zones = tmp_path / "zones.csv"
    zones.write_text(
        "LocationID,Borough,Zone,service_zone\n1,Queens,Astoria,Boro\n2,Bronx,Norwood,Boro\n"
    )
    from lakemart.sources.landed import load_reference_csv

    load_reference_csv(spark, str(zones), f"{warehouse.raw_schema}.taxi_zone_lookup", t.ZONE_SCHEMA)
    ingest = IngestConfig(
        f"{tmp_path}/landing", f"{warehouse.raw_schema}.yellow_trips_raw", t.raw_trip_schema(),
        f"{tmp_path}/checkpoint", "tpep_pickup_datetime",
    )
    trips(spark, ("2024-04-01 08:00", 1), ("2024-04-02 09:00", 2)).coalesce(1).write.parquet(ingest.landing)
    first = warehouse.build(ingest, now=ts("2024-05-01"))
    assert first["files"] == 1 and first["daily"].full and first["snapshot_run"] == 1
    assert rows(spark.table(warehouse.table("marts", "dim_taxi_zones")), "location_id", "effective_from") == [
        (1, ts("2024-05-01")),
        (2, ts("2024-05-01")),
    ]
    more = trips(spark, ("2024-04-02 10:00", 2), ("2024-04-05 09:00", 1), ("2024-01-05 09:00", 1))
    more.coalesce(1).write.mode("append").parquet(ingest.landing)
    second = warehouse.build(ingest, now=ts("2024-05-02"))
    assert second["daily"].low == dt.date(2024, 3, 30) and second["snapshot_run"] == 1  # zones unchanged
    mart = warehouse.daily_mart().read()
    assert [(str(d), b, n) for d, b, n in rows(mart, "trip_date", "pickup_borough", "total_trips")] == [
        ("2024-04-01", "Queens", 1),
        ("2024-04-02", "Bronx", 2),
        ("2024-04-05", "Queens", 1),
    ]
    assert warehouse.hourly_mart().read().count() == 5
    assert "_loaded_at" in mart.columns and "_loaded_at" not in warehouse.hourly_mart().read().columns
    assert second["tests"].where("failures > 0").count() == 0
    assert spark.table("stg_trips").count() == 5
    # The old January trip needs a wider lookback, for one run.
    warehouse.run_daily(late_arrival_days=100, now=ts("2024-05-03"))
    assert warehouse.daily_mart().read().count() == 4
    assert warehouse.run_hourly(incremental=True).low == dt.date(2024, 4, 2)


def test_failed_ingest_stops_the_build(spark, tmp_path, warehouse):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "broken.parquet").write_bytes(b"not parquet")
    ingest = IngestConfig(
        str(landing), f"{warehouse.raw_schema}.yellow_trips_raw", t.raw_trip_schema(), f"{tmp_path}/checkpoint"
    )
    with pytest.raises(Exception):
        warehouse.build(ingest)
    assert not warehouse.daily_mart().exists()


def test_gate_raises_on_failing_tests(spark, tmp_path, warehouse):
    zones = spark.createDataFrame([(1, "Atlantis", "Z", "S")], t.ZONE_SCHEMA)
    zones.write.saveAsTable(f"{warehouse.raw_schema}.taxi_zone_lookup")
    trips(spark, ("2024-04-01 08:00", 1)).write.saveAsTable(f"{warehouse.raw_schema}.yellow_trips_raw")
    with pytest.raises(DataTestError, match="accepted_values:borough"):
        warehouse.build(enforce_tests=True)


def test_incremental_window_prunes_raw_partitions(spark, tmp_path, warehouse):
    ingest = IngestConfig(
        f"{tmp_path}/landing", f"{warehouse.raw_schema}.yellow_trips_raw", t.raw_trip_schema(),
        f"{tmp_path}/checkpoint", "tpep_pickup_datetime",
    )
    trips(spark, ("2024-04-01 08:00", 1), ("2024-04-09 09:00", 2)).write.parquet(ingest.landing)
    ingest_files(spark, ingest)
    pruned = warehouse.staged("yellow_trips_raw", dt.date(2024, 4, 6))
    assert len(pruned.inputFiles()) < len(warehouse.staged("yellow_trips_raw").inputFiles())
    assert pruned.count() == 1


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == root and scratch_path(spark, "x").startswith(f"{root}/lakemart/x-")
    assert build_session() .conf.get("spark.checkpoint.dir") == root
    cut = stable(spark.range(3).selectExpr("id * 2 AS n"))
    assert rows(cut) == [(0,), (2,), (4,)]
    assert "Range" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_unknown_model_and_audit_free_read(spark, warehouse):
    with pytest.raises(ConfigError):
        warehouse.project.incremental_for("fct_unknown")
    assert without_audit(spark.range(1).withColumnRenamed("id", "_run_id")).columns == []


def test_backfill_opens_only_the_dates_the_mart_lacks(spark, tmp_path, warehouse):
    zones = spark.createDataFrame([(1, "Queens", "Z", "S"), (2, "Bronx", "Y", "S")], t.ZONE_SCHEMA)
    zones.write.saveAsTable(f"{warehouse.raw_schema}.taxi_zone_lookup")
    ingest = IngestConfig(
        f"{tmp_path}/landing", f"{warehouse.raw_schema}.yellow_trips_raw", t.raw_trip_schema(),
        f"{tmp_path}/checkpoint", "tpep_pickup_datetime",
    )
    trips(spark, ("2024-04-01 08:00", 1), ("2024-04-09 09:00", 2)).write.parquet(ingest.landing)
    warehouse.build(ingest)
    old = trips(spark, ("2024-02-20 08:00", 1), ("2019-05-05 08:00", 1))
    old.write.mode("append").parquet(ingest.landing)
    warehouse.build(ingest)
    assert warehouse.daily_mart().read().count() == 2
    # 2019 is before the staging limit, so it is neither found nor searched for.
    assert warehouse.backfill_daily().low == dt.date(2024, 2, 20)
    assert warehouse.daily_mart().read().count() == 3
    assert warehouse.backfill_daily().low == dt.date(2024, 4, 6)


def test_each_landed_file_starts_a_build(spark, tmp_path, warehouse):
    zones = spark.createDataFrame([(1, "Queens", "Z", "S")], t.ZONE_SCHEMA)
    zones.write.saveAsTable(f"{warehouse.raw_schema}.taxi_zone_lookup")
    ingest = IngestConfig(
        f"{tmp_path}/landing", f"{warehouse.raw_schema}.yellow_trips_raw", t.raw_trip_schema(),
        f"{tmp_path}/checkpoint", "tpep_pickup_datetime",
    )
    trips(spark, ("2024-04-01 08:00", 1)).coalesce(1).write.parquet(ingest.landing)
    run = warehouse.follow(ingest, every="1 second")
    try:
        run.query.processAllAvailable()
        assert rows(warehouse.daily_mart().read(), "total_trips") == [(1,)]
        trips(spark, ("2024-04-01 09:00", 1)).coalesce(1).write.mode("append").parquet(ingest.landing)
        run.query.processAllAvailable()
        assert rows(warehouse.daily_mart().read(), "total_trips") == [(2,)]
    finally:
        run.query.stop()
    assert len(run.loads) == 2
    age = warehouse.freshness(ts("2024-04-03 09:00")).first()
    assert (age.status, age.age_hours) == ("warn", 48.0)
