"""Straight-line runs: one incremental model, one warehouse build."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.config import ConfigError, IncrementalConfig, Project, schema_name, table_name
from lakemart.functions.audit import utc_now, with_audit
from lakemart.operators.backfill import find_gap, missing_intervals, within
from lakemart.operators.enrich import MART_ROLES, TripRules, enrich, measured
from lakemart.operators.incremental import from_date, window_start
from lakemart.operators.marts import daily, daily_from_rollup, hourly, hourly_from_rollup, rollup
from lakemart.operators.quality import enforce, freshness, run_tests
from lakemart.operators.scd import require_keys
from lakemart.operators.staging import stage
from lakemart.plans import trips as t
from lakemart.session import stable
from lakemart.sources.history import HistoryTable
from lakemart.sources.ingest import EVENT_DATE, IngestConfig, IngestRun, ingest_files, start_ingest
from lakemart.sources.published import PublishedMart
from lakemart.sources.tables import (
    PARTITION,
    MartTable,
    as_view,
    ensure_schema,
    ensure_table,
    overwrite_partitions,
    partition_values,
    source,
    write_table,
)
from lakemart.sources.test_state import StoredTests

DAILY_KEYS = {"trip_date", "pickup_borough"}
HOURLY_KEYS = DAILY_KEYS | {"pickup_hour"}

# The rows to build from, or a function that reads them from a date on (None: all).
Upstream = DataFrame | Callable[[dt.date | None], DataFrame]


@dataclass(frozen=True)
class ModelRun:
    """What a run did: `full` rebuild, or the date from which on rows were reprocessed."""

    model: str
    full: bool
    low: dt.date | None
    # The dates that were reprocessed, if not all from `low` on.
    intervals: tuple[tuple[dt.date, dt.date], ...] = ()


def run_incremental(
    mart: MartTable,
    upstream: Upstream,
    build: Callable[[DataFrame], DataFrame],
    config: IncrementalConfig,
    *,
    full_refresh: bool = False,
    watermark_column: str | None = None,
    late_arrival_days: int | None = None,
    strategy: str = "merge",
    unique_keys: bool = False,
    audit: bool = True,
    run_id: str | None = None,
    now: dt.datetime | None = None,
) -> ModelRun:
    """Rebuild the mart, or merge the rows from the high-water mark minus the lookback on.

    A missing or empty mart, or `full_refresh`, is a full run. The overrides hold for this run only: a wider
    `late_arrival_days` is a targeted backfill. `strategy="replace_window"` also removes groups of the window that
    the source no longer yields. `upstream` must have the watermark column; the filter on it is applied before
    `build`, as a literal, so it reaches the scan. An `upstream` function can prune its source further.
    `unique_keys` says that `build` groups by the keys, so that a merge need not check them.
    """
    if strategy not in ("merge", "replace_window"):
        raise ConfigError(f"unknown strategy '{strategy}'")
    if strategy == "merge" and not config.keys:
        raise ConfigError(f"no merge keys configured for '{config.model}'")
    watermark = config.resolve(watermark_column, late_arrival_days)
    low = None
    if mart.exists() and not full_refresh:
        low = window_start(mart.high_water_mark(watermark.column), watermark)
    upstream = upstream(low) if callable(upstream) else upstream
    rows = build(from_date(upstream, watermark.column, low))
    if audit:
        rows = with_audit(rows, config.model, run_id, now)
    if low is None:
        mart.replace(rows)
    elif strategy == "merge":
        mart.upsert(rows, config.keys, validate=not unique_keys)
    else:
        mart.replace_from(rows, watermark.column, low)
    return ModelRun(config.model, low is None, low)


def backfill(
    mart: MartTable,
    upstream: Upstream,
    build: Callable[[DataFrame], DataFrame],
    config: IncrementalConfig,
    *,
    late_arrival_days: int | None = None,
    expected: DataFrame | None = None,
    **options,
) -> ModelRun:
    """One run with a lookback wide enough for the dates that the mart lacks, or with the one given.

    The dates to look for come from `expected` (by default all of `upstream`); pass rows that `build` keeps, so
    that a date without any is not searched for again and again.
    """
    if late_arrival_days is None:
        column = config.resolve(options.get("watermark_column")).column
        if expected is None:
            expected = upstream(None) if callable(upstream) else upstream
        gap = find_gap(expected, mart.read(), column).first()
        late_arrival_days = max(gap["lookback_days"], config.late_arrival_days)
    return run_incremental(mart, upstream, build, config, late_arrival_days=late_arrival_days, **options)


def backfill_intervals(
    mart: MartTable,
    upstream: DataFrame | Callable[[Sequence[tuple[dt.date, dt.date]]], DataFrame],
    build: Callable[[DataFrame], DataFrame],
    config: IncrementalConfig,
    *,
    expected: DataFrame | None = None,
    watermark_column: str | None = None,
    unique_keys: bool = False,
    audit: bool = True,
    run_id: str | None = None,
    now: dt.datetime | None = None,
) -> ModelRun | None:
    """Merge the dates that the mart lacks, and no others. None if it lacks none.

    They become the fewest intervals, all built in one pass. An `upstream` function gets the intervals and can prune
    its source by them; `expected` holds the dates to look for, by default those of an `upstream` frame. `build` must
    make the rows of a date from that date's rows alone.
    """
    if not config.keys:
        raise ConfigError(f"no merge keys configured for '{config.model}'")
    column = config.resolve(watermark_column).column
    if expected is None and callable(upstream):
        raise ConfigError("an upstream function needs the expected dates")
    # At most a row for every other calendar day.
    found = missing_intervals(upstream if expected is None else expected, mart.read(), column).orderBy("low").collect()
    intervals = tuple((row["low"], row["high"]) for row in found)
    if not intervals:
        return None
    rows = upstream(intervals) if callable(upstream) else upstream
    rows = build(rows.where(within(column, intervals)))
    mart.upsert(with_audit(rows, config.model, run_id, now) if audit else rows, config.keys, validate=not unique_keys)
    return ModelRun(config.model, False, intervals[0][0], intervals)


@dataclass(frozen=True)
class Warehouse:
    """The trip warehouse of one environment. Layers map to schemas, e.g. `dev_marts`."""

    spark: SparkSession
    target: str = "dev"
    raw_schema: str = "raw"
    project: Project = field(default_factory=t.trip_project)
    rules: TripRules = TripRules()
    location: str | None = None
    # Raw trip tables that feed the marts. A further source is a deliberate choice.
    trip_sources: Sequence[str] = ("yellow_trips_raw",)

    def table(self, layer: str, name: str) -> str:
        return table_name(self.target, layer, name)

    def prepare(self) -> None:
        for layer in ("staging", "marts", "snapshots"):
            at = f"{self.location}/{schema_name(self.target, layer)}" if self.location else None
            ensure_schema(self.spark, self.target, layer, at)

    def raw(self, table: str, low: dt.date | None = None) -> DataFrame:
        """A raw table; with `low` only its dates from then on, when it is split by event date."""
        config = self.project.staging_for(table)
        rows = source(self.spark, self.raw_schema if config.source_name == "raw" else config.source_name, table)
        return from_date(rows, EVENT_DATE, low) if EVENT_DATE in rows.columns else rows

    def staged(self, table: str, low: dt.date | None = None) -> DataFrame:
        return stage(self.raw(table, low), self.project.staging_for(table))

    def staging_views(self) -> dict[str, DataFrame]:
        return {
            "stg_trips": as_view(self.staged("yellow_trips_raw"), "stg_trips"),
            "stg_zones": as_view(self.staged("taxi_zone_lookup"), "stg_zones"),
        }

    def daily_mart(self) -> MartTable:
        return PublishedMart(self.spark, self.table("marts", "fct_trips_daily"), partition_on="trip_date")

    def hourly_mart(self) -> MartTable:
        return PublishedMart(self.spark, self.table("marts", "fct_trips_hourly"), partition_on="trip_date")

    def zone_history(self) -> HistoryTable:
        return self.history("zones_snapshot")

    def history(self, name: str) -> HistoryTable:
        schema = schema_name(self.target, "snapshots")
        base = self.spark.catalog.getDatabase(schema).locationUri.rstrip("/")
        return HistoryTable(self.spark, f"{schema}.{name}", f"{base}/{name}_data")

    def load_dimension(self, name: str, incoming: DataFrame, now: dt.datetime | None = None) -> DataFrame:
        """Load the configured dimension `name` and return what is stored: the history of a type 2 dimension
        (`<name>_snapshot`), the latest rows of a type 1 dimension (`dim_<name>`)."""
        config = self.project.dimension_for(name)
        if config.scd_type == 2:
            history = self.history(f"{name}_snapshot")
            history.snapshot(incoming, config, now)
            return history.read()
        require_keys(incoming, config.business_key)
        table = MartTable(self.spark, self.table("marts", f"dim_{name}"))
        if table.exists():
            table.upsert(incoming, [config.business_key], null_safe=False, validate=False)
        else:
            table.replace(incoming)
        return table.read()

    def _trips_from(self, low: dt.date | None) -> DataFrame:
        # Pruned by the raw table's partition column, which the staged rows no longer have.
        return reduce(DataFrame.unionByName, [self.staged(name, low) for name in self.trip_sources])

    def _enriched(self, trips: DataFrame) -> DataFrame:
        return enrich(trips, self.staged("taxi_zone_lookup"), self.rules, MART_ROLES)

    def _build_daily(self, trips: DataFrame) -> DataFrame:
        return daily(self._enriched(trips), self.rules)

    def run_daily(self, **options) -> ModelRun:
        config = self.project.incremental_for("fct_trips_daily")
        options = {"unique_keys": self._groups_by(config, DAILY_KEYS), **options}
        return run_incremental(self.daily_mart(), self._trips_from, self._build_daily, config, **options)

    @staticmethod
    def _groups_by(config: IncrementalConfig, keys: set[str]) -> bool:
        """Whether the configured keys contain those that the mart groups by, which makes them unique."""
        return keys <= set(config.keys)

    def backfill_daily(self, **options) -> ModelRun:
        """Find the dates that the daily mart lacks and merge them alone; dates between them are not opened.

        With `late_arrival_days` everything from so many days before the newest date on is merged instead, and without
        missing dates the configured lookback is.
        """
        config, mart = self.project.incremental_for("fct_trips_daily"), self.daily_mart()
        if options.get("late_arrival_days") is not None or not mart.exists():
            return self.run_daily(**options)
        candidates = reduce(DataFrame.unionByName, [self._lacking(name, mart) for name in self.trip_sources])
        options = {"unique_keys": self._groups_by(config, DAILY_KEYS), **options}
        done = backfill_intervals(
            mart, self._trips_within, self._build_daily, config, expected=measured(candidates, self.rules), **options
        )
        return done or self.run_daily(**options)

    def _trips_within(self, intervals: Sequence[tuple[dt.date, dt.date]]) -> DataFrame:
        """Staged trips of all sources; of a raw table split by event date only the dates of the intervals."""

        def staged(table: str) -> DataFrame:
            raw = self.raw(table)
            raw = raw.where(within(EVENT_DATE, intervals)) if EVENT_DATE in raw.columns else raw
            return stage(raw, self.project.staging_for(table))

        return reduce(DataFrame.unionByName, [staged(name) for name in self.trip_sources])

    def _lacking(self, table: str, mart: MartTable) -> DataFrame:
        """Staged trips that may fill dates which the mart lacks."""
        raw = self.raw(table)
        if EVENT_DATE in raw.columns:
            # Dates come from the catalog; only those that the mart lacks are opened, to see if they have valid trips.
            known = partition_values(self.spark, f"{self.raw_schema}.{table}", EVENT_DATE)
            known = known.select(F.col(EVENT_DATE).cast("date")).dropna()
            lacking = known.join(mart.read().select(F.col("trip_date").alias(EVENT_DATE)), EVENT_DATE, "anti")
            raw = raw.where(F.col(EVENT_DATE).isin([row[0] for row in lacking.collect()]))
        return stage(raw, self.project.staging_for(table))

    def run_hourly(self, incremental: bool = False, **options) -> ModelRun:
        """A full rebuild by default; `incremental=True` merges the recent window instead."""
        config = self.project.incremental_for("fct_trips_hourly")
        unique = self._groups_by(config, HOURLY_KEYS)
        options = {"audit": False, "full_refresh": not incremental, "unique_keys": unique, **options}

        def build(trips: DataFrame) -> DataFrame:
            return hourly(self._enriched(trips))

        return run_incremental(self.hourly_mart(), self._trips_from, build, config, **options)

    def snapshot_zones(self, now: dt.datetime | None = None) -> int:
        config = self.project.dimension_for("taxi_zones")
        return self.zone_history().snapshot(self.staged("taxi_zone_lookup"), config, now)

    def build_dimension(self) -> DataFrame:
        columns = ["location_id", "zone_name", "borough", "service_zone", "effective_from", "last_changed_at"]
        rows = self.zone_history().current().select(*columns)
        return write_table(rows, self.table("marts", "dim_taxi_zones"))

    def freshness(self, now: dt.datetime | None = None) -> DataFrame:
        """Age of the newest raw trip. Of a table split by date only the newest date up to now is read."""
        now = now or utc_now()
        raw = self.raw("yellow_trips_raw")
        if EVENT_DATE in raw.columns:
            dates = partition_values(self.spark, f"{self.raw_schema}.yellow_trips_raw", EVENT_DATE)
            day = F.col(EVENT_DATE).cast("date")
            newest = dates.agg(F.max(F.when(day <= F.lit(now.date()), day)).alias("day")).first()["day"]
            raw = from_date(raw, EVENT_DATE, newest)
        return freshness(raw, t.TRIP_FRESHNESS, now)

    def rebuild_marts(self, now: dt.datetime | None = None) -> tuple[ModelRun, ModelRun]:
        """Full rebuild of both marts from one pass over the trips."""
        parts = stable(rollup(self._enriched(self._trips_from(None)), self.rules))
        models = ("fct_trips_daily", "fct_trips_hourly")
        self.daily_mart().replace(with_audit(daily_from_rollup(parts), models[0], now=now))
        self.hourly_mart().replace(hourly_from_rollup(parts))
        return ModelRun(models[0], True, None), ModelRun(models[1], True, None)

    def test(
        self, now: dt.datetime | None = None, low: dt.date | None = None, only_changed: bool = False
    ) -> DataFrame:
        """Run the declared tests of every table: one row per test. `low` limits the trips to dates from then on.

        With `only_changed`, of the daily mart the partitions are opened that changed since they were last tested so.
        """
        daily_mart, dim = self.daily_mart(), self.spark.table(self.table("marts", "dim_taxi_zones"))
        zones = self.staged("taxi_zone_lookup")
        parents = {"stg_zones": zones}
        suites = [
            (self.staged("yellow_trips_raw", low), t.STAGED_TRIP_TESTS),
            (zones, t.STAGED_ZONE_TESTS),
            (self.zone_history().read(), t.HISTORY_TESTS),
            (dim, t.DIMENSION_TESTS),
        ]
        results = [run_tests(rows, tests, now, parents) for rows, tests in suites]
        if only_changed:
            state = StoredTests(self.spark, self.table("marts", "test_state_daily"), t.DAILY_TESTS)
            results.append(state.run(daily_mart.stored(), PARTITION, daily_mart.stamps(), now))
        else:
            results.append(run_tests(daily_mart.read(), t.DAILY_TESTS, now))
        combined = results[0]
        for result in results[1:]:
            combined = combined.unionByName(result)
        return combined

    def build(
        self,
        ingest: IngestConfig | None = None,
        *,
        full_refresh: bool = False,
        hourly_incremental: bool = False,
        enforce_tests: bool = True,
        now: dt.datetime | None = None,
    ) -> dict[str, object]:
        """Ingest, then zones history and dimension, then marts, then tests. An error stops the steps after it.

        Freshness is reported before the models run and stops nothing. The hourly mart is rebuilt unless
        `hourly_incremental` is set. Of the staged trips, the dates that this run reprocessed are tested; `test()`
        covers all of them. Of the daily mart the partitions that changed are opened. The results are stored in the table `test_results` of the marts, one partition for each
        build, before a failure raises; `enforce_tests=False` only stores them.
        """
        now = now or utc_now()
        done: dict[str, object] = {}
        if ingest is not None:
            done["files"] = ingest_files(self.spark, ingest)
        self.prepare()
        done["freshness"] = self.freshness(now).first().asDict()
        self.staging_views()
        done["snapshot_run"] = self.snapshot_zones(now)
        self.build_dimension()
        if full_refresh or not self.daily_mart().exists():
            done["daily"], done["hourly"] = self.rebuild_marts(now)
        else:
            done["daily"] = self.run_daily(now=now)
            done["hourly"] = self.run_hourly(incremental=hourly_incremental)
        done["tests"] = self._stored_tests(self.test(now, done["daily"].low, only_changed=True), now)
        if enforce_tests:
            enforce(done["tests"])
        return done

    def _stored_tests(self, results: DataFrame, now: dt.datetime) -> DataFrame:
        """Run the tests once, store their results by build, and return the stored rows: one for each test."""
        name, build = self.table("marts", "test_results"), now.isoformat()
        rows = results.withColumn("_build", F.lit(build))
        ensure_table(self.spark, name, rows.schema, ["_build"])
        overwrite_partitions(rows, name, ["_build"])
        return self.spark.table(name).where(F.col("_build") == build).drop("_build")

    def follow(self, ingest: IngestConfig, every: str | None = "15 minutes", **options) -> IngestRun:
        """Poll the landing folder; each load of new files starts a build, and without new files nothing runs.

        Builds enforce their tests, and refresh the hourly mart incrementally unless `hourly_incremental=False`.
        """
        options = {"hourly_incremental": True, **options}

        def rebuild(spark: SparkSession, load: str) -> None:
            self.build(**options)

        return start_ingest(self.spark, ingest, every, rebuild)
