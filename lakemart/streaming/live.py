"""Marts that follow the ingest, and the event-time variant of the daily mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakemart.config import ConfigError, FreshnessConfig
from lakemart.functions.audit import with_audit
from lakemart.operators.joins import HotKeys, hot_in, key_sketches, merged_sketches
from lakemart.operators.quality import TableTests, enforce, freshness, run_tests
from lakemart.sources.ingest import EVENT_DATE, LOAD, IngestConfig, OnLoad
from lakemart.sources.tables import MartTable, add_missing_columns, ensure_table, overwrite_partitions, partition_values


def touched_dates(spark: SparkSession, config: IngestConfig, load: str) -> list[dt.date]:
    """The dates that occur in `load`."""
    # At most one value per calendar day. As literals they select the partition directories exactly, also when a
    # stray date lies years away from the others.
    listed = partition_values(spark, config.table, EVENT_DATE, {LOAD: load})
    return [row[0] for row in listed.select(F.col(EVENT_DATE).cast("date")).dropna().collect()]


def refresh_on_load(
    config: IngestConfig,
    mart: MartTable,
    build: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    model: str,
) -> OnLoad:
    """A hook for `start_ingest`: recompute the dates a load touched, from all raw rows, and replace them.

    Files with old dates are picked up like any other, without a lookback to widen. Replaying a load gives the
    same rows, and a group that the rows no longer yield, say after a relabel, disappears. `build` maps raw rows to
    mart rows; `config.event_time` must be the mart's date, which is one of the `keys` and splits the mart.
    """
    if mart.partition_on not in keys:
        raise ConfigError(f"'{mart.name}' must be split by its date, one of {list(keys)}")

    def on_load(spark: SparkSession, load: str) -> None:
        dates = touched_dates(spark, config, load)
        if not dates:
            return
        recompute_dates(spark, config, mart, build, dates, model)

    return on_load


def sketch_on_load(config: IngestConfig, keys: Mapping[str, Column], sketches: str) -> OnLoad:
    """A hook for `start_ingest`: keep a frequent-items sketch of each load's keys in the table `sketches`."""

    def on_load(spark: SparkSession, load: str) -> None:
        rows = spark.table(config.table).where(F.col(LOAD) == load)
        made = key_sketches(rows, keys).withColumn(LOAD, F.lit(load))
        ensure_table(spark, sketches, made.schema, [LOAD])
        overwrite_partitions(made, sketches, [LOAD])

    return on_load


def stored_hot_keys(spark: SparkSession, sketches: str) -> dict[str, HotKeys]:
    """The hot keys by name, as of the loads sketched so far; for a stream over the same rows that starts now."""
    spark.catalog.refreshTable(sketches)
    return hot_in(merged_sketches(spark.table(sketches).drop(LOAD)))


def recompute_dates(
    spark: SparkSession,
    config: IngestConfig,
    mart: MartTable,
    build: Callable[[DataFrame], DataFrame],
    dates: Sequence[dt.date],
    model: str | None = None,
) -> None:
    """Replace these dates of the mart by what all raw rows of them give. With `model`, audit columns are added."""
    target = mart.on(spark)
    rows = build(spark.table(config.table).where(F.col(EVENT_DATE).isin(list(dates))))
    rows = with_audit(rows, model) if model else rows
    if target.exists():
        target.replace_dates(rows, mart.partition_on, dates)
    else:
        target.replace(rows)


@dataclass(frozen=True)
class LateRoute:
    """What becomes of rows that an event-time mart drops because they are behind its watermark.

    They go to the table `late`, by date and load, and their dates are recomputed from all raw rows, so the mart comes
    to hold what a batch run would give. `on_load` is a hook for the ingest of the raw table, and `after_merge` one for
    `start_event_time_mart`: a merge of a date that has late rows would bring back the state without them.

    The newest event time of each load is kept in `<late>__newest`. A row is late if its date ended `lateness_days`
    before the newest time of all loads up to its own; streams that read the same files in the same order have seen no
    newer time, so every row that they drop is among these. `build` maps raw rows to mart rows, date by date.
    """

    config: IngestConfig
    mart: MartTable
    build: Callable[[DataFrame], DataFrame]
    late: str
    lateness_days: int = 3
    model: str | None = None

    def on_load(self, spark: SparkSession, load: str) -> None:
        rows = spark.table(self.config.table).where(F.col(LOAD) == load)
        newest = self._newest(spark, rows, load)
        ensure_table(spark, self.late, rows.schema, [EVENT_DATE, LOAD])
        add_missing_columns(spark, self.late, rows.schema)
        if newest is None:
            return
        ended = F.date_sub(F.lit(newest).cast("date"), self.lateness_days + 1)
        behind = rows.where(F.col(EVENT_DATE) <= ended)
        for name in spark.table(self.late).columns:
            if name not in behind.columns:
                behind = behind.withColumn(name, F.lit(None))
        overwrite_partitions(behind, self.late, [EVENT_DATE, LOAD])
        self._recompute(spark, self._late_dates(spark, {LOAD: load}))

    def after_merge(self, spark: SparkSession, dates: Sequence[dt.date]) -> None:
        """Recompute those of the merged `dates` that have late rows."""
        if spark.catalog.tableExists(self.late):
            late = set(self._late_dates(spark))
            self._recompute(spark, [d for d in dates if d in late])

    def _newest(self, spark: SparkSession, rows: DataFrame, load: str) -> dt.datetime | None:
        """The newest event time of all loads, this one included. One small row for each load is read."""
        marks = f"{self.late}__newest"
        kind = rows.schema[self.config.event_time].dataType
        schema = T.StructType([T.StructField("newest", kind), T.StructField(LOAD, T.StringType())])
        ensure_table(spark, marks, schema, [LOAD])
        own = rows.agg(F.max(self.config.event_time).alias("newest")).withColumn(LOAD, F.lit(load))
        overwrite_partitions(own, marks, [LOAD])
        spark.catalog.refreshTable(marks)
        return spark.table(marks).agg(F.max("newest").alias("newest")).first()["newest"]

    def _late_dates(self, spark: SparkSession, within: dict[str, str] | None = None) -> list[dt.date]:
        listed = partition_values(spark, self.late, EVENT_DATE, within)
        return [row[0] for row in listed.select(F.col(EVENT_DATE).cast("date")).dropna().collect()]

    def _recompute(self, spark: SparkSession, dates: Sequence[dt.date]) -> None:
        if dates:
            recompute_dates(spark, self.config, self.mart, self.build, dates, self.model)


def check_on_load(
    config: IngestConfig,
    tests: TableTests,
    build: Callable[[DataFrame], DataFrame] = lambda raw: raw,
    fresh: FreshnessConfig | None = None,
    report: Callable[[DataFrame], None] | None = None,
) -> OnLoad:
    """A hook for `start_ingest`: run the tests on the loaded rows. Freshness is reported, not enforced."""

    def on_load(spark: SparkSession, load: str) -> None:
        rows = spark.table(config.table).where(F.col(LOAD) == load)
        if fresh and report:
            report(freshness(rows, fresh))
        enforce(run_tests(build(rows), tests))

    return on_load


def record_on_load(
    config: IngestConfig,
    tests: TableTests,
    results: str,
    build: Callable[[DataFrame], DataFrame] = lambda raw: raw,
) -> OnLoad:
    """A hook for `start_ingest`: store the test results of each load in table `results`, once per load."""
    columns = {"table": T.StringType(), "test": T.StringType(), "failures": T.LongType(), LOAD: T.StringType()}
    schema = T.StructType([T.StructField(name, kind) for name, kind in columns.items()])

    def on_load(spark: SparkSession, load: str) -> None:
        ensure_table(spark, results, schema, [LOAD])
        rows = spark.table(config.table).where(F.col(LOAD) == load)
        overwrite_partitions(run_tests(build(rows), tests).withColumn(LOAD, F.lit(load)), results, [LOAD])

    return on_load


def in_order(*hooks: OnLoad) -> OnLoad:
    """Run several hooks; a later one runs only if the earlier ones succeeded."""

    def on_load(spark: SparkSession, load: str) -> None:
        for hook in hooks:
            hook(spark, load)

    return on_load


def windowed(
    stream: DataFrame,
    time: str,
    keys: Sequence[str],
    measures: Sequence[Column],
    window: str = "1 day",
    lateness: str = "3 days",
) -> DataFrame:
    """Tumbling event-time aggregate that drops rows later than `lateness`; `LateRoute` brings them in.

    Grouping is by the window itself and not by its start, which would lose the watermark. The time is cast to an
    instant under the pinned session zone, as watermarks need one.
    """
    timed = stream.withColumn("_event_time", F.col(time).cast("timestamp")).withWatermark("_event_time", lateness)
    return timed.groupBy(F.window("_event_time", window).alias("_window"), *keys).agg(*measures)


def event_time_daily(
    stream: DataFrame, time: str, keys: Sequence[str], measures: Sequence[Column], lateness: str = "3 days"
) -> DataFrame:
    rows = windowed(stream, time, keys, measures, "1 day", lateness)
    return rows.select(
        F.col("_window.start").cast("date").alias("trip_date"), *[c for c in rows.columns if c != "_window"]
    )


def event_time_hourly(
    stream: DataFrame, time: str, keys: Sequence[str], measures: Sequence[Column], lateness: str = "3 days"
) -> DataFrame:
    rows = windowed(stream, time, keys, measures, "1 hour", lateness)
    return rows.select(
        F.col("_window.start").cast("date").alias("trip_date"),
        F.hour("_window.start").alias("pickup_hour"),
        *[c for c in rows.columns if c != "_window"],
    )


def start_event_time_mart(
    result: DataFrame,
    mart: MartTable,
    keys: Sequence[str],
    checkpoint: str,
    every: str | None = None,
    late: LateRoute | None = None,
) -> StreamingQuery:
    """Merge each micro-batch's changed groups into the mart (update mode). Replays merge the same rows again.

    Rows behind the watermark are dropped by the stream; with `late`, whose `on_load` must follow the ingest of the same
    files, the mart gets them too.
    """

    def merge(changed: DataFrame, batch: int) -> None:
        target = mart.on(changed.sparkSession)
        if target.exists():
            target.upsert(changed, keys, validate=False)
        else:
            target.replace(changed)
        if late:
            # At most the dates that the watermark holds open.
            days = changed.select(F.col(mart.partition_on).cast("date")).distinct().collect()
            late.after_merge(changed.sparkSession, [row[0] for row in days])

    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = result.writeStream.outputMode("update").foreachBatch(merge)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
