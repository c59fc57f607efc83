import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from helpers import ts  # noqa: E402

from lakemart.session import SESSION_DEFAULTS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("lakemart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.maxMetadataStringLength", "100000")
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.checkpoint.dir", str(work / "shared"))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def schema(spark, tmp_path):
    """A new catalog schema in its own folder."""
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/tables'")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@pytest.fixture
def trip(spark):
    """Build staged trips from a few overridden fields."""
    base = {
        "vendor_id": 1,
        "pickup_at": ts("2024-04-10 08:00:00"),
        "dropoff_at": ts("2024-04-10 08:20:00"),
        "pickup_location_id": 1,
        "dropoff_location_id": 2,
        "passenger_count": 1.0,
        "trip_distance": 2.0,
        "payment_type": 1,
        "fare_amount": 10.0,
        "tip_amount": 2.0,
        "tolls_amount": 0.0,
        "total_amount": 12.0,
    }
    kinds = (
        "vendor_id long, pickup_at timestamp_ntz, dropoff_at timestamp_ntz, pickup_location_id long, "
        "dropoff_location_id long, passenger_count double, trip_distance double, payment_type long, "
        "fare_amount double, tip_amount double, tolls_amount double, total_amount double"
    )

    def build(*overrides):
        data = [tuple({**base, **o}.values()) for o in overrides]
        df = spark.createDataFrame(data, kinds)
        return df.selectExpr(
            "*", "CAST(pickup_at AS DATE) trip_date", "HOUR(pickup_at) pickup_hour", "DAYOFWEEK(pickup_at) day_of_week"
        )

    return build


@pytest.fixture
def zones(spark):
    data = [(1, "Queens", "Astoria", "Boro"), (2, "Bronx", "Norwood", "Boro"), (3, "Queens", "Corona", "Boro")]
    return spark.createDataFrame(data, "location_id int, borough string, zone_name string, service_zone string")
