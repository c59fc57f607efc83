"""Time the headline runs. Prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakemart.functions.audit import without_audit
from lakemart.plans import showcase as s
from lakemart.plans.pipeline import run_incremental
from lakemart.session import build_session
from lakemart.sources.history import HistoryTable

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
BACKFILL_DAYS = 45
DENSE_END = dt.datetime(1998, 6, 30)
# Best of so many runs, for the queries that can be repeated.
REPEATS = 2


def session() -> SparkSession:
    spark = build_session(
        "lakemart-bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": CPUS,
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    # Start the JVM's compilers and the Parquet reader before timing.
    consume(s.read(spark, SF_DIR, "events"))
    consume(s.full_daily(spark, SF_DIR))

    seconds: dict[str, float] = {}
    facts: dict[str, object] = {}

    def timed(name, run, repeats=1):
        taken = []
        for _ in range(repeats):
            start = time.perf_counter()
            result = run()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(min(taken), 3)
        return result

    queries = [
        "stg_trips", "trips_enriched", "trips_enriched_as_of", "daily_mart", "hourly_mart", "merge_null_key",
        "scd2_null_change", "scd2_as_of", "dq_suite", "reconcile_diff", "reconcile_hash", "find_gap",
        "ingest_idempotent", "stream_daily",
    ]
    for name in queries:
        timed(name, lambda: consume(s.QUERIES[name](spark, SF_DIR)), REPEATS)

    # The operational comparison: a raw trip table, its full mart, the 3-day run and a 45-day backfill. The table ends
    # in the middle of the data, where a day has as many trips as any: at its end they thin out.
    scratch = s.Scratch(spark, "bench")
    raw_name = scratch.table("yellow_trips_raw")
    trips = s.raw_trips(spark, SF_DIR).where(F.col("tpep_pickup_datetime") <= F.lit(DENSE_END))
    trips = trips.withColumn("_event_date", F.trunc("tpep_pickup_datetime", "month"))
    trips.hint("rebalance", "_event_date").write.partitionBy("_event_date").saveAsTable(raw_name)
    mart, build = scratch.daily_mart(spark), s.staged_build(spark, SF_DIR)

    def staged(low=None):
        raw = spark.table(raw_name)
        # Partitions are months here: the first day of the month that holds `low`.
        return s.stage(raw if low is None else raw.where(F.col("_event_date") >= F.lit(low.replace(day=1))), s.YELLOW)

    def incremental(days):
        return run_incremental(mart, staged, build, s.DAILY, late_arrival_days=days)

    timed("run_daily_full", lambda: run_incremental(mart, staged, build, s.DAILY, full_refresh=True), REPEATS)
    recent = timed("run_daily_incremental_3d", lambda: incremental(3), REPEATS)
    wide = timed("run_daily_backfill_45d", lambda: incremental(BACKFILL_DAYS), REPEATS)
    timed("read_daily_mart", lambda: consume(without_audit(mart.read())), REPEATS)

    def snapshots():
        history = HistoryTable(spark, scratch.table("customers_snapshot"), scratch.folder("customers"))
        for state, now in zip(s.customer_states(spark, SF_DIR), (s.T1, s.T2, s.T3)):
            history.snapshot(state, s.CUSTOMERS, now)

    timed("snapshot_three_runs", snapshots)

    # Rows and files read by a full and by an incremental run: the only figures the baseline states.
    facts["rows_full"] = staged().count()
    facts["rows_incremental_3d"] = staged(recent.low).where(F.col("trip_date") >= F.lit(recent.low)).count()
    facts["rows_backfill_45d"] = staged(wide.low).where(F.col("trip_date") >= F.lit(wide.low)).count()
    for name, low in {"full": None, "incremental_3d": recent.low, "backfill_45d": wide.low}.items():
        files = staged(low).inputFiles()
        sizes = spark.read.format("binaryFile").load(files).agg(F.sum("length").alias("bytes"))
        facts[f"files_{name}"], facts[f"bytes_{name}"] = len(files), sizes.first()["bytes"]

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "spark": spark.version,
                "window": facts,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
