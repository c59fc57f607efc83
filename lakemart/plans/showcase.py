"""Every operator as a query over the given tables.

Trips are derived from lineitem, orders, customer and supplier (dates at midnight, so durations are in days), and
from events (real times of day, durations in minutes). Amounts are doubles, as in the raw trip files. Their sums depend
on the order of adding in the last digits, so they are rounded far below a cent for comparison with other engines.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.config import DimensionConfig, FreshnessConfig, IncrementalConfig, StagingConfig
from lakemart.functions.audit import with_audit, without_audit
from lakemart.operators import backfill, incremental, marts, quality, ranking, reconcile, scd
from lakemart.operators.enrich import MART_ROLES, ROLES, TripRules, enrich, enrich_as_of, measured
from lakemart.operators.marts import DAILY_KEYS, HOURLY_KEYS, daily, daily_measures, hourly
from lakemart.operators.staging import stage, union_sources
from lakemart.plans import trips as t
from lakemart.plans.pipeline import backfill as run_backfill
from lakemart.plans.pipeline import Warehouse, run_incremental
from lakemart.plans.pipeline import backfill_intervals as run_intervals
from lakemart.session import scratch_path, stable
from lakemart.sources.history import HistoryTable
from lakemart.sources.ingest import IngestConfig, ingest_files
from lakemart.sources.landed import RESCUED, load_reference_csv
from lakemart.sources.published import PublishedMart
from lakemart.sources.tables import PARTITION, MartTable, write_table
from lakemart.sources.test_state import StoredTests
from lakemart.streaming.live import (
    LateRoute,
    event_time_daily,
    event_time_hourly,
    record_on_load,
    refresh_on_load,
    start_event_time_mart,
)

Query = Callable[[SparkSession, str], DataFrame]

SINCE, AS_OF = dt.date(1995, 2, 1), dt.date(2001, 6, 30)
DAYS = TripRules(duration_unit_seconds=86_400)
YELLOW = t.yellow_trips(as_of=AS_OF, since=SINCE)
EVENT_YELLOW = t.yellow_trips(as_of=dt.date(2024, 1, 29), since=dt.date(2024, 1, 2))
DAILY = IncrementalConfig("fct_trips_daily", "trip_date", t.LATE_ARRIVAL_DAYS, DAILY_KEYS)
HOURLY = IncrementalConfig("fct_trips_hourly", "trip_date", t.LATE_ARRIVAL_DAYS, HOURLY_KEYS)
# Load boundaries: what had arrived by the first and second run.
GAPS = ((dt.date(1996, 3, 1), dt.date(1996, 3, 9)), (dt.date(1999, 5, 5), dt.date(1999, 6, 1)))
LATE_DAY = dt.date(1997, 8, 8)
FIRST_LOAD, SECOND_LOAD = dt.date(1998, 6, 30), dt.date(2000, 6, 30)
LOAD_TIMES = (dt.datetime(2001, 7, 1), dt.datetime(2001, 7, 2))
T1, T2, T3 = dt.datetime(1996, 1, 1), dt.datetime(1998, 1, 1), dt.datetime(2000, 1, 1)
EVENTS_NOW = dt.datetime(2024, 1, 20, 12)

CUSTOMERS = DimensionConfig("customers", 2, "customer_id", ["segment", "nation_id"], "segments are reported by date")

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


# --- inputs ---------------------------------------------------------------------------------------------------


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(mart: DataFrame) -> DataFrame:
    """Sums of amounts to six places. The exact sums have no more, so any order of adding gives the same value."""
    sums = [c for c in ("total_fare_usd", "total_tips_usd", "total_revenue_usd") if c in mart.columns]
    return mart.withColumns({c: F.round(c, 6) for c in sums})


def raw_trips(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = read(spark, sf, "lineitem"), read(spark, sf, "orders")
    customers, suppliers = read(spark, sf, "customer"), read(spark, sf, "supplier")
    # Adding 0.0 turns the negative zeros of the data into plain ones.
    fare, discount, tax = F.col("l_extendedprice"), F.col("l_discount") + 0.0, F.col("l_tax") + 0.0
    # Each side gets its own lookup first, so that lines are shuffled once and orders without them.
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    shipped = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    joined = shipped.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("l_linenumber").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("c_nationkey").alias("PULocationID"),
        F.col("s_nationkey").alias("DOLocationID"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type"),
        fare.alias("fare_amount"),
        (fare * discount).alias("tip_amount"),
        (fare * tax).alias("tolls_amount"),
        (fare * (1 - discount) * (1 + tax)).alias("total_amount"),
        F.col("l_linestatus"),
    )


def raw_zones(spark: SparkSession, sf: str, complete: bool = True) -> DataFrame:
    """Nations as zones. Without `complete` one of them is missing, so its trips have no borough."""
    nations, regions = read(spark, sf, "nation"), read(spark, sf, "region")
    zones = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.concat(F.lit("REGION_"), F.col("n_regionkey").cast("string")).alias("service_zone"),
    )
    return zones if complete else zones.where("Zone <> 'NATION_0'")


def trips_from_events(events: DataFrame) -> DataFrame:
    quarters = F.floor(F.col("value") * 4)
    seconds = (quarters * 15).cast("decimal(18,6)")
    zero = F.lit(0)
    fare = F.col("value")
    tip = fare * 0.1
    codes = {"error": 0, "purchase": 1, "view": 2, "click": 3}
    payment = F.lit(4)
    for name, code in codes.items():
        payment = F.when(F.col("event_type") == name, code).otherwise(payment)
    return events.select(
        F.col("event_id").alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(zero, zero, zero, seconds)).alias("tpep_dropoff_datetime"),
        F.length("event_type").alias("passenger_count"),
        (quarters / F.lit(8)).alias("trip_distance"),
        F.col("user_id").alias("PULocationID"),
        F.col("user_id").alias("DOLocationID"),
        payment.alias("payment_type"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        (fare + tip).alias("total_amount"),
    )


def raw_customer_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as zones of the event trips; those in debt are missing."""
    return read(spark, sf, "customer").where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("LocationID"),
        F.col("c_mktsegment").alias("Borough"),
        F.col("c_name").alias("Zone"),
        F.col("c_nationkey").cast("string").alias("service_zone"),
        F.lit(None).cast("string").alias(RESCUED),
    )


def zones_from_customers(spark: SparkSession, sf: str) -> DataFrame:
    return t.stg_zones(raw_customer_zones(spark, sf))


def staged_trips(spark: SparkSession, sf: str) -> DataFrame:
    return stage(raw_trips(spark, sf), YELLOW)


def staged_zones(spark: SparkSession, sf: str, complete: bool = False) -> DataFrame:
    return t.stg_zones(raw_zones(spark, sf, complete))


def enriched_trips(spark: SparkSession, sf: str, roles=ROLES) -> DataFrame:
    return enrich(staged_trips(spark, sf), staged_zones(spark, sf), DAYS, roles)


def enriched_events(spark: SparkSession, sf: str, roles=ROLES) -> DataFrame:
    trips = stage(trips_from_events(read(spark, sf, "events")), EVENT_YELLOW)
    return enrich(trips, zones_from_customers(spark, sf), roles=roles)


def full_daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily(enriched_trips(spark, sf, MART_ROLES), DAYS)


def customer_states(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The customer dimension at three times: as given, one segment renamed, some segments unset."""
    first = read(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_id"),
        F.col("c_acctbal").alias("_balance"),
    )
    renamed = F.when(F.col("segment") == "HOUSEHOLD", "HOME").otherwise(F.col("segment"))
    second = first.withColumn("segment", renamed)
    third = second.withColumn("segment", F.when(F.col("_balance") >= 0, F.col("segment")))
    return [s.drop("_balance") for s in (first, second, third)]


def customer_history(spark: SparkSession, sf: str, versions: int = 3) -> DataFrame:
    history = None
    for state, now in list(zip(customer_states(spark, sf), (T1, T2, T3)))[:versions]:
        history = scd.snapshot(history, state, CUSTOMERS, now)
    return history


# --- stored tables of a query ---------------------------------------------------------------------------------


class Scratch:
    """A new schema and folder in the shared directory, for queries that write."""

    def __init__(self, spark: SparkSession, label: str):
        self.path = scratch_path(spark, label)
        self.schema = f"lakemart_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.schema} LOCATION '{self.path}/tables'")

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}"

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def daily_mart(self, spark: SparkSession) -> MartTable:
        return MartTable(spark, self.table("fct_trips_daily"), partition_on="trip_date")


def landing_of(spark: SparkSession, sf: str, table: str) -> tuple[str, str]:
    """Folder and file pattern of a given table, which is one file or a folder of files."""
    name = f"{table}.parquet"
    first = spark.read.format("binaryFile").load(f"{sf}/{name}").select("path").first()["path"]
    return (sf, name) if first.endswith(f"/{name}") else (f"{sf}/{name}", "*.parquet")


def event_ingest(spark: SparkSession, sf: str, scratch: Scratch) -> IngestConfig:
    landing, pattern = landing_of(spark, sf, "events")
    return IngestConfig(
        landing, scratch.table("events_raw"), EVENT_SCHEMA, scratch.folder("checkpoint"), "ts", pattern
    )


def stored_trips(spark: SparkSession, sf: str, scratch: Scratch) -> DataFrame:
    """The staged trips as a table, for runs that read them several times: the joins behind them are done once."""
    return write_table(staged_trips(spark, sf), scratch.table("stg_trips"))


def staged_build(spark: SparkSession, sf: str) -> Callable[[DataFrame], DataFrame]:
    zones = staged_zones(spark, sf)
    return lambda trips: daily(enrich(trips, zones, DAYS, MART_ROLES), DAYS)


def run_loads(spark: SparkSession, sf: str, label: str, arrived: list) -> DataFrame:
    """Run the daily mart once per condition in `arrived`: the rows that had landed by then."""
    scratch, build = Scratch(spark, label), staged_build(spark, sf)
    mart, trips = scratch.daily_mart(spark), stored_trips(spark, sf, scratch)
    for landed in arrived:
        run_incremental(mart, trips.where(landed), build, DAILY)
    return rounded(without_audit(mart.read()))


# --- queries --------------------------------------------------------------------------------------------------


def stg_trips(spark, sf):
    return staged_trips(spark, sf)


def stg_zones(spark, sf):
    return zones_from_customers(spark, sf)


def stg_events(spark, sf):
    config = StagingConfig(
        "events",
        "raw",
        rename={"ts": "occurred_at"},
        passthrough=["event_id", "event_type", "value"],
        derived_columns={"event_hour": "HOUR(ts)", "event_date": "CAST(ts AS DATE)"},
        filters=["ts IS NOT NULL", "value > 1", "event_type <> 'error'"],
    )
    return stage(read(spark, sf, "events"), config)


def trips_enriched(spark, sf):
    return enriched_trips(spark, sf)


def event_trips_enriched(spark, sf):
    return enriched_events(spark, sf)


def zone_versions(spark, sf):
    """Zone history with one change: from T2 on, every zone of ASIA belongs to EUROPE."""
    zones = staged_zones(spark, sf)
    moved = F.when(F.col("borough") == "ASIA", "EUROPE").otherwise(F.col("borough"))
    first = scd.snapshot(None, zones, t.ZONES, T1)
    return scd.snapshot(first, zones.withColumn("borough", moved), t.ZONES, T2)


def trips_enriched_as_of(spark, sf):
    return enrich_as_of(staged_trips(spark, sf), stable(zone_versions(spark, sf)), DAYS)


def daily_mart(spark, sf):
    trips = enrich(staged_trips(spark, sf), staged_zones(spark, sf, complete=True), DAYS, MART_ROLES)
    return rounded(daily(trips, DAYS))


def daily_mart_null_borough(spark, sf):
    return rounded(full_daily(spark, sf))


def daily_mart_audited(spark, sf):
    return rounded(with_audit(full_daily(spark, sf), "fct_trips_daily", "run-1", LOAD_TIMES[0]))


def event_daily_mart(spark, sf):
    return rounded(daily(enriched_events(spark, sf, MART_ROLES)))


def hourly_mart(spark, sf):
    return rounded(hourly(enriched_events(spark, sf, MART_ROLES)))


def daily_from_rollup(spark, sf):
    return rounded(marts.daily_from_rollup(marts.rollup(enriched_trips(spark, sf, MART_ROLES), DAYS)))


def hourly_from_rollup(spark, sf):
    return rounded(marts.hourly_from_rollup(marts.rollup(enriched_events(spark, sf, MART_ROLES))))


def watermark_window(spark, sf):
    loaded = staged_trips(spark, sf).where(F.col("trip_date") <= SECOND_LOAD)
    return incremental.watermark_filter(staged_trips(spark, sf), loaded, DAILY.resolve())


def watermark_first_run(spark, sf):
    return incremental.watermark_filter(staged_trips(spark, sf), None, DAILY.resolve())


def watermark_empty_target(spark, sf):
    """The target exists but has no rows, as nothing was picked up before the lower bound."""
    loaded = staged_trips(spark, sf).where(F.col("trip_date") < SINCE)
    return incremental.watermark_filter(staged_trips(spark, sf), loaded, DAILY.resolve())


def watermark_zero_lookback(spark, sf):
    loaded = staged_trips(spark, sf).where(F.col("trip_date") <= SECOND_LOAD)
    rule = DAILY.resolve(late_arrival_days=0)
    return incremental.watermark_filter(staged_trips(spark, sf), loaded, rule)


def _mart_halves(spark, sf):
    """A mart of the card trips up to one date, and the whole mart from an earlier date on.

    The source of a merge is read several times, so it is computed once and stored.
    """
    trips = enriched_trips(spark, sf, MART_ROLES)
    older = trips.where((F.col("trip_date") <= SECOND_LOAD) & (F.col("payment_type") == 1))
    newer = trips.where(F.col("trip_date") > FIRST_LOAD)
    return daily(older, DAYS), stable(daily(newer, DAYS))


def merge_upsert(spark, sf):
    """Merge over complete keys: trips without a borough take no part."""
    target, source = (m.where("pickup_borough IS NOT NULL") for m in _mart_halves(spark, sf))
    return rounded(incremental.merge_upsert(target, source, DAILY_KEYS, validate=False))


def merge_null_key(spark, sf):
    """Merge with a null borough as a key value like any other."""
    target, source = _mart_halves(spark, sf)
    return rounded(incremental.merge_upsert(target, source, DAILY_KEYS, validate=False))


def merge_plain_equality(spark, sf):
    """The same merge with plain equality: rows with a null borough never match, so both stay."""
    target, source = _mart_halves(spark, sf)
    return rounded(incremental.merge_upsert(target, source, DAILY_KEYS, null_safe=False, validate=False))


def replace_window(spark, sf):
    """A zone change relabels a borough; replacing the window leaves no row of the old label behind."""
    trips = enriched_trips(spark, sf, MART_ROLES)
    target = daily(trips, DAYS)
    relabelled = trips.withColumn("pickup_borough", F.coalesce("pickup_borough", F.lit("UNKNOWN")))
    source = daily(relabelled.where(F.col("trip_date") >= SECOND_LOAD), DAYS)
    return rounded(incremental.replace_window(target, source, "trip_date", SECOND_LOAD))


def stored_replace_window(spark, sf):
    """The same through the stored mart and an incremental run."""
    scratch, zones = Scratch(spark, "replace-window"), staged_zones(spark, sf)
    mart, trips = scratch.daily_mart(spark), stored_trips(spark, sf, scratch)

    def relabelled(rows):
        named = F.coalesce("pickup_borough", F.lit("UNKNOWN"))
        return daily(enrich(rows, zones, DAYS, MART_ROLES).withColumn("pickup_borough", named), DAYS)

    run_incremental(mart, trips, staged_build(spark, sf), DAILY)
    run_incremental(mart, trips, relabelled, DAILY, strategy="replace_window")
    return rounded(without_audit(mart.read()))


def incremental_equals_full(spark, sf):
    day = F.col("trip_date")
    return run_loads(spark, sf, "loads", [day <= FIRST_LOAD, day <= SECOND_LOAD, F.lit(True)])


def late_arrival_in_window(spark, sf):
    """Trips of the last days before the first load arrive with the second one."""
    day = F.col("trip_date")
    punctual = (day <= SECOND_LOAD - dt.timedelta(days=3)) | ((day <= SECOND_LOAD) & (F.col("vendor_id") < 5))
    return run_loads(spark, sf, "late", [punctual, F.lit(True)])


def old_arrival_ignored(spark, sf):
    """Recent trips are loaded first; older ones, outside the lookback, are not picked up."""
    return run_loads(spark, sf, "old", [F.col("trip_date") > SECOND_LOAD, F.lit(True)])


def backfill_widened(spark, sf):
    """The same, then one run with the lookback that the gap calls for."""
    scratch, build = Scratch(spark, "backfill"), staged_build(spark, sf)
    mart, trips = scratch.daily_mart(spark), stored_trips(spark, sf, scratch)
    run_incremental(mart, trips.where(F.col("trip_date") > SECOND_LOAD), build, DAILY)
    run_incremental(mart, trips, build, DAILY)
    run_backfill(mart, trips, build, DAILY)
    return rounded(without_audit(mart.read()))


def backfill_intervals(spark, sf):
    """Two gaps years apart are filled. Trips of a date between them that came late are left alone."""
    scratch, build, day = Scratch(spark, "intervals"), staged_build(spark, sf), F.col("trip_date")
    mart, trips = scratch.daily_mart(spark), stored_trips(spark, sf, scratch)
    gaps = day.between(*GAPS[0]) | day.between(*GAPS[1])
    late = (day == LATE_DAY) & (F.col("payment_type") == 1)
    run_incremental(mart, trips.where(~gaps & ~late), build, DAILY)
    run_intervals(mart, trips, build, DAILY)
    return rounded(without_audit(mart.read()))


def published_mart(spark, sf):
    """Three loads and a refresh of a mart that is published by versions."""
    scratch, build, day = Scratch(spark, "published"), staged_build(spark, sf), F.col("trip_date")
    mart = PublishedMart(spark, scratch.table("fct_trips_daily"), partition_on="trip_date")
    trips = stored_trips(spark, sf, scratch)
    for landed in (day <= FIRST_LOAD, day <= SECOND_LOAD, F.lit(True)):
        run_incremental(mart, trips.where(landed), build, DAILY)
    run_incremental(mart, trips, build, DAILY, full_refresh=True)
    run_incremental(mart, trips, build, DAILY)
    return rounded(without_audit(spark.table(mart.name)))


def full_refresh(spark, sf):
    """A mart that missed old trips, rebuilt from everything."""
    scratch, build = Scratch(spark, "refresh"), staged_build(spark, sf)
    mart, trips = scratch.daily_mart(spark), stored_trips(spark, sf, scratch)
    run_incremental(mart, trips.where(F.col("trip_date") > SECOND_LOAD), build, DAILY)
    run_incremental(mart, trips, build, DAILY, full_refresh=True)
    return rounded(without_audit(mart.read()))


def hourly_incremental(spark, sf):
    """The hourly mart converted to merging: two loads of the event trips."""
    mart = MartTable(spark, Scratch(spark, "hourly").table("fct_trips_hourly"), partition_on="trip_date")
    zones = zones_from_customers(spark, sf)
    trips = stage(trips_from_events(read(spark, sf, "events")), EVENT_YELLOW)

    def build(rows):
        return hourly(enrich(rows, zones, roles=MART_ROLES))

    for landed in (F.col("trip_date") <= dt.date(2024, 1, 15), F.lit(True)):
        run_incremental(mart, trips.where(landed), build, HOURLY, audit=False)
    return rounded(mart.read())


def find_gap(spark, sf):
    trips = staged_trips(spark, sf)
    mart = full_daily(spark, sf).where(F.col("trip_date") > FIRST_LOAD)
    return backfill.find_gap(trips, mart, "trip_date")


def missing_dates(spark, sf):
    return backfill.missing_dates(staged_trips(spark, sf), full_daily(spark, sf), "trip_date")


def date_range(spark, sf):
    return backfill.date_range(staged_trips(spark, sf), "trip_date")


def load_months(spark, sf):
    """Load times per month after a backfill of the months up to the first load."""
    mart = full_daily(spark, sf)
    old = mart.where(F.col("trip_date") <= FIRST_LOAD)
    new = mart.where(F.col("trip_date") > FIRST_LOAD)
    loaded = with_audit(new, "m", "run-1", LOAD_TIMES[0]).unionByName(with_audit(old, "m", "run-2", LOAD_TIMES[1]))
    return backfill.load_times_by_month(loaded)


def scd2_initial(spark, sf):
    return customer_history(spark, sf, 1)


def scd2_change(spark, sf):
    return customer_history(spark, sf, 2)


def scd2_null_change(spark, sf):
    return customer_history(spark, sf, 3)


def _missing_key_history(spark, sf, hard_deletes):
    first, second, _ = customer_states(spark, sf)
    history = scd.snapshot(None, first, CUSTOMERS, T1)
    return scd.snapshot(history, second.where("segment <> 'HOME'"), CUSTOMERS, T2, hard_deletes)


def scd2_missing_key(spark, sf):
    """Customers that leave the source stay current."""
    return _missing_key_history(spark, sf, "keep")


def scd2_hard_deletes(spark, sf):
    """Customers that leave the source are closed."""
    return _missing_key_history(spark, sf, "close")


def scd2_stored(spark, sf):
    """Three snapshots through the stored history."""
    scratch = Scratch(spark, "history")
    history = HistoryTable(spark, scratch.table("customers_snapshot"), scratch.folder("customers"))
    for state, now in zip(customer_states(spark, sf), (T1, T2, T3)):
        history.snapshot(state, CUSTOMERS, now)
    return history.read()


def _stored_history(spark, label, config, *states):
    scratch = Scratch(spark, label)
    history = HistoryTable(spark, scratch.table("snapshot"), scratch.folder("data"))
    for state, now in zip(states, (T1, T2, T3)):
        history.snapshot(state, config, now)
    return history.read()


def scd2_added_column(spark, sf):
    """The source gains a column: null in the versions from before."""
    first, second, _ = customer_states(spark, sf)
    tier = F.concat(F.lit("t"), F.col("nation_id").cast("string"))
    return _stored_history(spark, "added", CUSTOMERS, first, second.withColumn("tier", tier))


def scd2_dropped_column(spark, sf):
    """The source loses a column that is not tracked: it stays in the history and is null in new versions."""
    first, second, _ = customer_states(spark, sf)
    config = DimensionConfig("customers", 2, "customer_id", ["segment"])
    return _stored_history(spark, "dropped", config, first, second.drop("nation_id"))


def scd2_current(spark, sf):
    return scd.current(customer_history(spark, sf))


def scd2_as_of(spark, sf):
    """Each order with the segment its customer had at the time."""
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    history = stable(customer_history(spark, sf))
    return scd.join_as_of(orders, history, "o_custkey", "customer_id", "o_orderdate", {"segment": "segment"})


def scd2_as_of_pruned(spark, sf):
    """Orders of some years with the segment of their time, from the stored versions that held in these years."""
    scratch = Scratch(spark, "pruned")
    history = HistoryTable(spark, scratch.table("customers_snapshot"), scratch.folder("customers"))
    for state, now in zip(customer_states(spark, sf), (T1, T2, T3)):
        history.snapshot(state, CUSTOMERS, now)
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    orders = orders.where(F.col("o_orderdate") >= F.lit(T2))
    span = orders.agg(F.min("o_orderdate").cast("timestamp_ntz"), F.max("o_orderdate").cast("timestamp_ntz")).first()
    versions = history.valid_between(*span)
    return scd.join_as_of(orders, versions, "o_custkey", "customer_id", "o_orderdate", {"segment": "segment"})


def scd1_upsert(spark, sf):
    """Changed customers overwrite; the others, and those not in the change set, stay."""
    first, second, _ = customer_states(spark, sf)
    changes = second.where("segment = 'HOME' OR nation_id < 5").withColumn("nation_id", F.col("nation_id") + 100)
    return scd.scd1_upsert(first, changes, "customer_id")


def union_of_sources(spark, sf):
    """Yellow and green trips, staged by their own configs and stacked."""
    raw = raw_trips(spark, sf)
    yellow = stage(raw.where("l_linestatus = 'O'"), YELLOW)
    green = raw.where("l_linestatus <> 'O'").withColumnsRenamed(
        {"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"}
    )
    return union_sources({"yellow": yellow, "green": stage(green, t.green_trips())})


def dq_not_null(spark, sf):
    failing = quality.not_null(enriched_trips(spark, sf, MART_ROLES), "pickup_borough")
    return failing.select("trip_date", "pickup_location_id", "total_amount", "vendor_id")


def dq_unique(spark, sf):
    return quality.unique(read(spark, sf, "lineitem"), "l_orderkey")


def dq_accepted_values(spark, sf):
    return quality.accepted_values(read(spark, sf, "events"), "event_type", ["view", "click", "signup"])


def dq_unique_combination(spark, sf):
    return quality.unique_combination(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_no_future(spark, sf):
    return quality.no_future(read(spark, sf, "events"), "ts", EVENTS_NOW)


def dq_singular(spark, sf):
    """Any query for failing rows: trips that earned less than their fare."""
    trips = staged_trips(spark, sf)
    return quality.singular(trips.where("total_amount < fare_amount"))


def dq_relationships(spark, sf):
    solvent = read(spark, sf, "customer").where("c_acctbal >= 0")
    return quality.relationships(read(spark, sf, "orders"), "o_custkey", solvent, "c_custkey")


def dq_freshness(spark, sf):
    return quality.freshness(read(spark, sf, "events"), FreshnessConfig("ts", 25, 49), EVENTS_NOW)


def dq_freshness_with_future(spark, sf):
    stale = dt.datetime(2024, 2, 3)
    return quality.freshness(read(spark, sf, "events"), FreshnessConfig("ts", 25, 49), stale, ignore_future=False)


def dq_suite(spark, sf):
    """The declared tests of the staged trips, the zones and the daily mart."""
    now = dt.datetime(2001, 1, 1)
    # The four-way join behind the trips is done once, for their own tests and for the mart.
    trips, zones = stable(staged_trips(spark, sf)), staged_zones(spark, sf)
    mart = daily(enrich(trips, zones, DAYS, MART_ROLES), DAYS)
    results = [
        quality.run_tests(trips, t.STAGED_TRIP_TESTS, now, {"stg_zones": zones}),
        quality.run_tests(zones, t.STAGED_ZONE_TESTS, now),
        quality.run_tests(mart, t.DAILY_TESTS, now),
    ]
    return results[0].unionByName(results[1]).unionByName(results[2])


def dq_incremental(spark, sf):
    """The tests of the daily mart after three loads, each of which tests only the partitions it changed."""
    scratch, build, day = Scratch(spark, "dq"), staged_build(spark, sf), F.col("trip_date")
    mart = PublishedMart(spark, scratch.table("fct_trips_daily"), partition_on="trip_date")
    state = StoredTests(spark, scratch.table("test_state"), t.DAILY_TESTS)
    trips = stored_trips(spark, sf, scratch)
    for landed in (day <= FIRST_LOAD, day <= SECOND_LOAD, F.lit(True)):
        run_incremental(mart, trips.where(landed), build, DAILY)
        results = state.run(mart.stored(), PARTITION, mart.stamps(), dt.datetime(2001, 1, 1))
    return results


def _handwritten_trips(spark, sf):
    """The staging model written out by hand, with its columns in another order."""
    raw = raw_trips(spark, sf)
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    kept = raw.where(
        (pickup < dropoff)
        & (F.col("trip_distance") > 0)
        & (F.col("total_amount") > 0)
        & (F.to_date(pickup) >= F.lit(SINCE))
        & (pickup <= F.lit(AS_OF))
    )
    return kept.select(
        F.to_date(pickup).alias("trip_date"),
        F.hour(pickup).alias("pickup_hour"),
        F.dayofweek(pickup).alias("day_of_week"),
        pickup.alias("pickup_at"),
        dropoff.alias("dropoff_at"),
        F.col("VendorID").alias("vendor_id"),
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
        *t.PASSED_THROUGH,
    )


def _corrected_trips(spark, sf):
    """The staged trips with a corrected toll on some, and one payment type left out."""
    corrected = F.when(F.col("tolls_amount") == 0, F.lit(1.0)).otherwise(F.col("tolls_amount"))
    return staged_trips(spark, sf).where("payment_type <> 5").withColumn("tolls_amount", corrected)


def reconcile_counts(spark, sf):
    return reconcile.row_counts(staged_trips(spark, sf), _corrected_trips(spark, sf))


def reconcile_equal(spark, sf):
    return reconcile.two_way_diff(staged_trips(spark, sf), _handwritten_trips(spark, sf))


def reconcile_diff(spark, sf):
    return reconcile.two_way_diff(staged_trips(spark, sf), _corrected_trips(spark, sf))


def reconcile_hash(spark, sf):
    return reconcile.same_content(staged_trips(spark, sf), _handwritten_trips(spark, sf))


def reconcile_hash_types(spark, sf):
    """The same rows with whole numbers of another width."""
    trips = staged_trips(spark, sf)
    wider = {c: F.col(c).cast("bigint") for c in ("pickup_hour", "day_of_week", "payment_type")}
    return reconcile.same_content(trips, trips.withColumns(wider))


def reconcile_numeric_types(spark, sf):
    """Whole numbers beyond 2^53 against doubles, of which every other one is off by one; decimals of two scales."""
    lines = read(spark, sf, "lineitem").select((F.col("l_orderkey").cast("bigint") + F.lit(1 << 53)).alias("id"), "l_quantity")
    exact = lines.select("id", F.col("l_quantity").cast("decimal(12,2)").alias("amount"))
    loose = lines.select(F.col("id").cast("double").alias("id"), F.col("l_quantity").cast("decimal(30,4)").alias("amount"))
    return reconcile.two_way_diff(exact, loose).withColumn("amount", F.col("amount").cast("double"))


def reconcile_tree(spark, sf):
    """The differences of `reconcile_diff`, found through the hash trees of both sides."""
    return reconcile.tree_diff(staged_trips(spark, sf), _corrected_trips(spark, sf), "trip_date", ["vendor_id", "pickup_at"])


def zone_revenue_rank(spark, sf):
    """Pickup zones by revenue in whole units, and by month, highest first; an unknown zone is a zone of its own."""
    trips = enrich(staged_trips(spark, sf), staged_zones(spark, sf), DAYS)
    revenue = F.floor(F.sum(F.col("total_amount").cast("decimal(18,2)")) / 100).cast("bigint")
    zones = trips.groupBy(F.month("trip_date").alias("month"), "pickup_borough").agg(revenue.alias("revenue"))
    return ranking.ranked(zones, [("month", False), ("revenue", True)], "revenue_rank", "revenue_dense_rank")


def latest_rows(spark, sf):
    mart = with_audit(full_daily(spark, sf), "fct_trips_daily", "run-1", LOAD_TIMES[0])
    mart = mart.select("trip_date", "pickup_borough", "total_trips", "_loaded_at")
    return quality.latest_rows(mart, "trip_date", ["pickup_borough"], 10)


def ingest_idempotent(spark, sf):
    """Events loaded from their files, twice; the second run finds nothing new."""
    config = event_ingest(spark, sf, Scratch(spark, "ingest"))
    ingest_files(spark, config)
    ingest_files(spark, config)
    return spark.table(config.table).select(*EVENT_SCHEMA.fieldNames())


def ingest_second_checkpoint(spark, sf):
    """The same folder under a new checkpoint: the table knows which files it has."""
    scratch = Scratch(spark, "ingest_again")
    config = event_ingest(spark, sf, scratch)
    ingest_files(spark, config)
    ingest_files(spark, replace(config, checkpoint=scratch.folder("other_checkpoint")))
    return spark.table(config.table).select(*EVENT_SCHEMA.fieldNames())


def ingest_alternating_types(spark, sf):
    """Files that hold a new column as int and as bigint by turns, and `value` as double and as float."""
    scratch = Scratch(spark, "alternate")
    declared = T.StructType(EVENT_SCHEMA.fields[:4])
    config = IngestConfig(
        scratch.folder("landing"), scratch.table("events_raw"), declared, scratch.folder("checkpoint"), "ts"
    )
    events = read(spark, sf, "events").drop("props").withColumn("name_length", F.length("event_type"))
    odd = events.withColumns({"name_length": F.col("name_length").cast("bigint"), "value": F.col("value").cast("float")})
    for i in range(6):
        rows = (odd if i % 2 else events).where(F.pmod(F.col("event_id"), F.lit(6)) == i)
        rows.coalesce(1).write.mode("append").parquet(config.landing)
    ingest_files(spark, config)
    return spark.table(config.table).select(*declared.fieldNames(), "name_length", "value")


def ingest_schema_evolution(spark, sf):
    """Earlier files have a narrow `name_length` and no `value`; later ones widen the first and add the second."""
    scratch = Scratch(spark, "evolve")
    declared = T.StructType([*EVENT_SCHEMA.fields[:4], T.StructField("name_length", T.LongType())])
    config = IngestConfig(
        scratch.folder("landing"), scratch.table("events_raw"), declared, scratch.folder("checkpoint"), "ts"
    )
    events = read(spark, sf, "events").drop("props").withColumn("name_length", F.length("event_type"))
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    events.where(early).drop("value").write.parquet(config.landing)
    ingest_files(spark, config)
    later = events.where(~early).withColumn("name_length", F.col("name_length").cast("bigint"))
    later.write.mode("append").parquet(config.landing)
    ingest_files(spark, config)
    return spark.table(config.table).select(*declared.fieldNames(), "value")


def ingest_column_case(spark, sf):
    """A column that is not declared comes as `value` in the earlier files and as `VALUE` in the later ones."""
    scratch = Scratch(spark, "case")
    declared = T.StructType(EVENT_SCHEMA.fields[:4])
    config = IngestConfig(
        scratch.folder("landing"), scratch.table("events_raw"), declared, scratch.folder("checkpoint"), "ts"
    )
    events = read(spark, sf, "events").drop("props")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for rows in (events.where(early), events.where(~early).withColumnRenamed("value", "VALUE")):
        rows.write.mode("append").parquet(config.landing)
        ingest_files(spark, config)
    return spark.table(config.table).select(*declared.fieldNames(), F.col("value").alias("value"))


def csv_reordered(spark, sf):
    """Customers from CSV whose header names the columns in another order than the schema."""
    scratch = Scratch(spark, "csv-order")
    read(spark, sf, "customer").select("c_name", "c_mktsegment", "c_custkey").write.option("header", True).csv(
        scratch.folder("customers")
    )
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_mktsegment", T.StringType()),
        ]
    )
    load_reference_csv(spark, scratch.folder("customers"), scratch.table("customers_csv"), schema)
    return spark.table(scratch.table("customers_csv"))


def csv_rescue(spark, sf):
    """Customers from CSV. Lines of those in debt have a field too many and a key that is no number."""
    scratch = Scratch(spark, "csv")
    folder = scratch.folder("customers")
    customers = read(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    good = customers.where("c_acctbal >= 0").drop("c_acctbal")
    bad = customers.where("c_acctbal < 0").select(
        F.concat(F.lit("key "), F.col("c_custkey").cast("string")).alias("c_custkey"),
        "c_name",
        "c_mktsegment",
        F.lit("extra").alias("surplus"),
    )
    good.write.option("header", True).csv(f"{folder}/batch=1")
    bad.write.option("header", True).csv(f"{folder}/batch=2")
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_mktsegment", T.StringType()),
        ]
    )
    table = scratch.table("customers_csv")
    load_reference_csv(spark, folder, table, schema)
    load_reference_csv(spark, folder, table, schema)  # does nothing, as the table exists
    return spark.table(table).select("c_custkey", "c_name", "c_mktsegment", RESCUED)


def duration_limits(spark, sf):
    """Trips of about a minute and of about 300, whose duration in minutes has to be rounded."""
    events = read(spark, sf, "events")
    even = F.col("VendorID") % 2 == 0
    seconds = F.when(even, 57 + F.col("VendorID") % 7).otherwise(17_996 + F.col("VendorID") % 9)
    zero = F.lit(0)
    until = F.col("tpep_pickup_datetime") + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))
    trips = stage(trips_from_events(events).withColumn("tpep_dropoff_datetime", until), EVENT_YELLOW)
    return measured(trips, TripRules()).select("vendor_id", "trip_duration_minutes")


def stream_daily(spark, sf):
    """A mart that follows the ingest. The second landing adds trips to dates that were loaded before."""
    scratch = Scratch(spark, "live")
    config = IngestConfig(
        scratch.folder("landing"), scratch.table("events_raw"), EVENT_SCHEMA, scratch.folder("checkpoint"), "ts"
    )
    zones, mart = zones_from_customers(spark, sf), scratch.daily_mart(spark)

    def build(raw):
        return daily(enrich(stage(trips_from_events(raw), EVENT_YELLOW), zones, roles=MART_ROLES))

    hook = refresh_on_load(config, mart, build, DAILY_KEYS, "fct_trips_daily")
    events = read(spark, sf, "events")
    for landed in ("event_type <> 'view'", "event_type = 'view'"):
        events.where(landed).write.mode("append").parquet(config.landing)
        ingest_files(spark, config, hook)
    return rounded(without_audit(mart.read()))


def stream_daily_relabel(spark, sf):
    """A mart whose group label depends on the date's rows, so that the second landing renames groups."""
    scratch = Scratch(spark, "relabel")
    config = IngestConfig(
        scratch.folder("landing"), scratch.table("events_raw"), EVENT_SCHEMA, scratch.folder("checkpoint"), "ts"
    )
    mart = scratch.daily_mart(spark)

    def build(raw):
        per_date = raw.groupBy(F.to_date("ts").alias("trip_date")).agg(F.count(F.lit(1)).alias("total_trips"))
        label = F.concat(F.lit("n"), F.col("total_trips").cast("string"))
        return per_date.select("trip_date", label.alias("pickup_borough"), "total_trips")

    hook = refresh_on_load(config, mart, build, DAILY_KEYS, "fct_trips_daily")
    events = read(spark, sf, "events")
    for landed in ("event_type <> 'view'", "event_type = 'view'"):
        events.where(landed).write.mode("append").parquet(config.landing)
        ingest_files(spark, config, hook)
    return without_audit(mart.read())


def stream_checks(spark, sf):
    """Tests of each load, recorded: a first landing without purchases and a second one of them."""
    scratch = Scratch(spark, "checks")
    config = IngestConfig(
        scratch.folder("landing"), scratch.table("events_raw"), EVENT_SCHEMA, scratch.folder("checkpoint"), "ts"
    )
    tests = quality.TableTests(
        "events_raw",
        not_null=["event_id", "ts"],
        unique=["event_id"],
        accepted_values={"event_type": ["view", "click", "signup", "error"]},
        no_future=["ts"],
    )
    hook = record_on_load(config, tests, scratch.table("test_results"))
    events = read(spark, sf, "events")
    for landed in ("event_type <> 'purchase'", "event_type = 'purchase'"):
        events.where(landed).write.mode("append").parquet(config.landing)
        ingest_files(spark, config, hook)
    return spark.table(scratch.table("test_results")).select("table", "test", "failures")


def dimension_by_type(spark, sf):
    """One change set loaded into two dimensions, whose configurations say whether history is kept."""
    first, second, _ = customer_states(spark, sf)
    latest_only = DimensionConfig("latest", 1, "customer_id")
    kept = scd.load_dimension(scd.load_dimension(None, first, CUSTOMERS, T1), second, CUSTOMERS, T2)
    latest = scd.load_dimension(scd.load_dimension(None, first, latest_only, T1), second, latest_only, T2)
    return union_sources({"type_1": latest, "type_2": kept}, "dimension")


def _event_warehouse(spark, sf, label, yellow=None, **options):
    """A warehouse over raw tables made from events and customers."""
    scratch = Scratch(spark, label)
    staging = {c.table: c for c in (EVENT_YELLOW, t.green_trips(), t.zone_lookup())}
    project = replace(t.trip_project(), staging=staging)
    target = f"dev_{scratch.schema}"
    warehouse = Warehouse(spark, target, scratch.schema, project, location=scratch.folder(target), **options)
    events = read(spark, sf, "events")
    write_table(trips_from_events(events if yellow is None else events.where(yellow)), scratch.table("yellow_trips_raw"))
    write_table(raw_customer_zones(spark, sf), scratch.table("taxi_zone_lookup"))
    return warehouse


def warehouse_tests(spark, sf):
    """The results of the tests of a first build, as it stores them."""
    warehouse = _event_warehouse(spark, sf, "warehouse-tests")
    return warehouse.build(now=dt.datetime(2024, 1, 20, 12), enforce_tests=False)["tests"]


def staging_view(spark, sf):
    """The staged trips through the view that a build registers."""
    _event_warehouse(spark, sf, "views").staging_views()
    return spark.table("stg_trips")


def daily_two_sources(spark, sf):
    """The daily mart from yellow and green trips; the green ones are the page views within the yellow dates."""
    sources = ("yellow_trips_raw", "green_trips_raw")
    warehouse = _event_warehouse(spark, sf, "two-sources", "event_type <> 'view'", trip_sources=sources)
    within = "event_type = 'view' AND ts BETWEEN TIMESTAMP_NTZ'2024-01-02 00:00:00' AND TIMESTAMP_NTZ'2024-01-29 00:00:00'"
    green = trips_from_events(read(spark, sf, "events").where(within)).withColumnsRenamed(
        {"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"}
    )
    write_table(green, f"{warehouse.raw_schema}.green_trips_raw")
    warehouse.prepare()
    warehouse.run_daily(now=LOAD_TIMES[0])
    return rounded(without_audit(warehouse.daily_mart().read()))


def dimension_stored_type1(spark, sf):
    """Suppliers as vendors, some renamed by the second load: a stored dimension without history."""
    warehouse = _event_warehouse(spark, sf, "type1")
    warehouse.prepare()
    vendors = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("vendor_id"), F.col("s_name").alias("vendor_name"), "s_nationkey")
    warehouse.load_dimension("vendors", vendors.drop("s_nationkey"), T1)
    renamed = vendors.where("s_nationkey < 5").select("vendor_id", F.concat("vendor_name", F.lit("!")).alias("vendor_name"))
    return warehouse.load_dimension("vendors", renamed, T2)


def driver_status_history(spark, sf):
    """Customers as drivers whose status changes: a second stored type 2 dimension, by its configuration alone."""
    warehouse = _event_warehouse(spark, sf, "drivers")
    warehouse.prepare()
    for state, now in zip(customer_states(spark, sf)[:2], (T1, T2)):
        license_type = F.concat(F.lit("n"), F.col("nation_id").cast("string")).alias("license_type")
        drivers = state.select(F.col("customer_id").alias("driver_id"), F.col("segment").alias("status"), license_type)
        history = warehouse.load_dimension("driver_status", drivers, now)
    return history


def warehouse_build(spark, sf):
    """The whole warehouse of one environment: raw tables, staging, history, dimension, marts and tests."""
    warehouse = _event_warehouse(spark, sf, "warehouse")
    warehouse.build(now=LOAD_TIMES[0], enforce_tests=False)
    warehouse.build(now=LOAD_TIMES[1], hourly_incremental=True, enforce_tests=False)
    return rounded(without_audit(warehouse.daily_mart().read()))


def _event_stream(spark, sf):
    landing, pattern = landing_of(spark, sf, "events")
    raw = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", pattern).parquet(landing)
    trips = stage(trips_from_events(raw), EVENT_YELLOW)
    return enrich(trips, zones_from_customers(spark, sf), roles=MART_ROLES)


def stream_event_time(spark, sf):
    """The daily mart as an event-time aggregate over the stream of events."""
    scratch = Scratch(spark, "event-time")
    mart = scratch.daily_mart(spark)
    rows = event_time_daily(_event_stream(spark, sf), "pickup_at", ["pickup_borough"], daily_measures())
    start_event_time_mart(rows, mart, DAILY_KEYS, scratch.folder("checkpoint")).awaitTermination()
    return rounded(mart.read())


def stream_late_routed(spark, sf):
    """An event-time mart whose older half lands last, weeks behind the watermark: it comes to equal the batch mart."""
    scratch = Scratch(spark, "late-routed")
    config = IngestConfig(
        scratch.folder("landing"), scratch.table("events_raw"), EVENT_SCHEMA, scratch.folder("checkpoint"), "ts"
    )
    zones, mart = zones_from_customers(spark, sf), scratch.daily_mart(spark)

    def enriched(raw):
        return enrich(stage(trips_from_events(raw), EVENT_YELLOW), zones, roles=MART_ROLES)

    route = LateRoute(config, mart, lambda raw: daily(enriched(raw)), scratch.table("events_late"))
    events, newer = read(spark, sf, "events"), F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    for landed in (newer, ~newer):
        events.where(landed).write.mode("append").parquet(config.landing)
        ingest_files(spark, config, route.on_load)
        stream = spark.readStream.schema(EVENT_SCHEMA).parquet(config.landing)
        rows = event_time_daily(enriched(stream), "pickup_at", ["pickup_borough"], daily_measures())
        start_event_time_mart(rows, mart, DAILY_KEYS, scratch.folder("stream"), late=route).awaitTermination()
    return rounded(mart.read())


def stream_event_time_hourly(spark, sf):
    """Hourly windows over the same stream, counting trips."""
    scratch = Scratch(spark, "event-hour")
    mart = MartTable(spark, scratch.table("fct_trips_hourly"), partition_on="trip_date")
    measures = [F.count(F.lit(1)).alias("total_trips")]
    rows = event_time_hourly(_event_stream(spark, sf), "pickup_at", ["pickup_borough"], measures)
    start_event_time_mart(rows, mart, HOURLY_KEYS, scratch.folder("checkpoint")).awaitTermination()
    return mart.read()


QUERIES: dict[str, Query] = {
    "stg_trips": stg_trips,
    "stg_zones": stg_zones,
    "stg_events": stg_events,
    "trips_enriched": trips_enriched,
    "event_trips_enriched": event_trips_enriched,
    "trips_enriched_as_of": trips_enriched_as_of,
    "daily_mart": daily_mart,
    "daily_mart_null_borough": daily_mart_null_borough,
    "daily_mart_audited": daily_mart_audited,
    "event_daily_mart": event_daily_mart,
    "hourly_mart": hourly_mart,
    "daily_from_rollup": daily_from_rollup,
    "hourly_from_rollup": hourly_from_rollup,
    "watermark_window": watermark_window,
    "watermark_first_run": watermark_first_run,
    "watermark_empty_target": watermark_empty_target,
    "watermark_zero_lookback": watermark_zero_lookback,
    "merge_upsert": merge_upsert,
    "merge_null_key": merge_null_key,
    "merge_plain_equality": merge_plain_equality,
    "replace_window": replace_window,
    "stored_replace_window": stored_replace_window,
    "incremental_equals_full": incremental_equals_full,
    "late_arrival_in_window": late_arrival_in_window,
    "old_arrival_ignored": old_arrival_ignored,
    "backfill_widened": backfill_widened,
    "backfill_intervals": backfill_intervals,
    "published_mart": published_mart,
    "full_refresh": full_refresh,
    "hourly_incremental": hourly_incremental,
    "find_gap": find_gap,
    "missing_dates": missing_dates,
    "date_range": date_range,
    "load_months": load_months,
    "scd2_initial": scd2_initial,
    "scd2_change": scd2_change,
    "scd2_null_change": scd2_null_change,
    "scd2_missing_key": scd2_missing_key,
    "scd2_hard_deletes": scd2_hard_deletes,
    "scd2_stored": scd2_stored,
    "scd2_current": scd2_current,
    "scd2_as_of": scd2_as_of,
    "scd2_as_of_pruned": scd2_as_of_pruned,
    "scd1_upsert": scd1_upsert,
    "union_sources": union_of_sources,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_unique_combination": dq_unique_combination,
    "dq_no_future": dq_no_future,
    "dq_singular": dq_singular,
    "dq_relationships": dq_relationships,
    "dq_freshness": dq_freshness,
    "dq_freshness_with_future": dq_freshness_with_future,
    "dq_suite": dq_suite,
    "dq_incremental": dq_incremental,
    "reconcile_counts": reconcile_counts,
    "reconcile_equal": reconcile_equal,
    "reconcile_diff": reconcile_diff,
    "reconcile_hash": reconcile_hash,
    "reconcile_numeric_types": reconcile_numeric_types,
    "reconcile_tree": reconcile_tree,
    "zone_revenue_rank": zone_revenue_rank,
    "latest_rows": latest_rows,
    "ingest_idempotent": ingest_idempotent,
    "ingest_second_checkpoint": ingest_second_checkpoint,
    "ingest_alternating_types": ingest_alternating_types,
    "ingest_schema_evolution": ingest_schema_evolution,
    "csv_rescue": csv_rescue,
    "stream_daily": stream_daily,
    "stream_checks": stream_checks,
    "dimension_by_type": dimension_by_type,
    "warehouse_build": warehouse_build,
    "warehouse_tests": warehouse_tests,
    "staging_view": staging_view,
    "duration_limits": duration_limits,
    "daily_two_sources": daily_two_sources,
    "dimension_stored_type1": dimension_stored_type1,
    "driver_status_history": driver_status_history,
    "ingest_column_case": ingest_column_case,
    "csv_reordered": csv_reordered,
    "scd2_added_column": scd2_added_column,
    "scd2_dropped_column": scd2_dropped_column,
    "reconcile_hash_types": reconcile_hash_types,
    "stream_daily_relabel": stream_daily_relabel,
    "stream_event_time": stream_event_time,
    "stream_event_time_hourly": stream_event_time_hourly,
    "stream_late_routed": stream_late_routed,
}
