"""Idempotent file ingest: each landed file is loaded into the raw table once, identified by its path.

A Structured Streaming query over the folder listing finds new files. Which files are loaded is known to the table (see
`ledger`), so a new or lost checkpoint loads nothing twice. A batch writes its own partitions by overwriting; rows of a
load that was cut off are dropped before the next one starts.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakemart.config import ConfigError
from lakemart.session import scratch_path
from lakemart.sources.landed import SOURCE_FILE, read_landed
from lakemart.sources.ledger import LoadLedger
from lakemart.sources.tables import add_missing_columns, ensure_table, overwrite_partitions

LOAD = "_load"
EVENT_DATE = "_event_date"
LISTING = "path string, modificationTime timestamp, length bigint, content binary"

# Table property that a running compaction sets, see `compact`.
COMPACTION = "lakemart.compaction"

OnLoad = Callable[[SparkSession, str], None]


@dataclass(frozen=True)
class IngestConfig:
    """Where files land, what they should look like and where they go.

    With `event_time` the raw table is split by that column's date, so later windows read only their dates.
    """

    landing: str
    table: str
    schema: T.StructType
    checkpoint: str
    event_time: str | None = None
    pattern: str = "*.parquet"
    max_files_per_batch: int = 10_000
    # What becomes of a file once it is loaded: "off", "archive" (moved to `archive`) or "delete". Listing a folder
    # that keeps every file ever landed takes longer each time.
    clean_source: str = "off"
    archive: str | None = None
    # The stream remembers, on the driver, the files of so many days before the newest one. An older file that lands
    # late is found by comparing the folder with the ledger, which every start of the ingest does.
    remembered_days: int = 30

    def __post_init__(self) -> None:
        if self.clean_source not in ("off", "archive", "delete"):
            raise ConfigError("clean_source must be 'off', 'archive' or 'delete'")
        if (self.clean_source == "archive") != bool(self.archive):
            raise ConfigError("clean_source 'archive' needs an archive folder, and only that")
        if self.remembered_days < 1:
            raise ConfigError("remembered_days must be at least 1")

    @property
    def partition_columns(self) -> list[str]:
        return [EVENT_DATE, LOAD] if self.event_time else [LOAD]

    def table_schema(self) -> T.StructType:
        extra = [T.StructField(SOURCE_FILE, T.StringType())]
        if self.event_time:
            extra.append(T.StructField(EVENT_DATE, T.DateType()))
        return T.StructType([*self.schema.fields, *extra, T.StructField(LOAD, T.StringType())])


@dataclass
class IngestRun:
    """A started ingest. `loads` lists the batches written so far, `files` counts their files."""

    query: StreamingQuery | None = None
    loads: list[str] = field(default_factory=list)
    files: int = 0

    def wait(self) -> IngestRun:
        """Block until the query ends; a failed batch raises here, so nothing downstream runs on partial data."""
        self.query.awaitTermination()
        return self


def landed_files(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """A stream with one row per new file. Only the listing is read, never the content."""
    reader = (
        spark.readStream.schema(LISTING)
        .format("binaryFile")
        .option("pathGlobFilter", config.pattern)
        .option("maxFileAge", f"{config.remembered_days}d")
        .option("maxFilesPerTrigger", config.max_files_per_batch)
        .option("cleanSource", config.clean_source)
    )
    if config.archive:
        reader = reader.option("sourceArchiveDir", config.archive)
    return reader.load(config.landing).select("path")


def load_files(spark: SparkSession, config: IngestConfig, paths: list[str], load: str) -> None:
    """Write the rows of `paths` as partition(s) `load` of the raw table, adding columns it does not have yet."""
    rows = read_landed(spark, paths, config.schema)
    if config.event_time:
        rows = rows.withColumn(EVENT_DATE, F.to_date(config.event_time))
    rows = rows.withColumn(LOAD, F.lit(load))
    ensure_table(spark, config.table, config.table_schema(), config.partition_columns)
    add_missing_columns(spark, config.table, rows.schema)
    # Column names match in any letter case, as they do everywhere in Spark.
    known = {c.lower() for c in rows.columns}
    for name in spark.table(config.table).columns:
        if name.lower() not in known:
            rows = rows.withColumn(name, F.lit(None))
    overwrite_partitions(rows, config.table, config.partition_columns)


def recover_loads(spark: SparkSession, config: IngestConfig) -> int:
    """Drop the rows of loads that were cut off, and free their files. Returns how many such loads there were.

    An ingest does this when it starts, so one table has one ingest at a time.
    """
    ledger = LoadLedger(spark, config.table)
    loads = ledger.cut_off()
    for load in loads:
        _drop(spark, config, _partitions(spark, config.table).where(F.col(LOAD) == load))
        ledger.release(load)
    return len(loads)


def _load_new(spark: SparkSession, config: IngestConfig, paths: list[str], load: str, on_load: OnLoad | None) -> int:
    """Load those of `paths` that are not loaded yet, as `load`. Returns their number."""
    ledger = LoadLedger(spark, config.table)
    offered = spark.createDataFrame([(p,) for p in paths], "path string")
    new = sorted(row["path"] for row in ledger.unloaded(offered).collect())
    if not new:
        return 0
    ledger.claim(load, spark.createDataFrame([(p,) for p in new], "path string"))
    load_files(spark, config, new, load)
    if on_load:
        on_load(spark, load)
    ledger.finish(load)
    return len(new)


def _load_forgotten(spark: SparkSession, config: IngestConfig, on_load: OnLoad | None, run: IngestRun) -> None:
    """Load files that are older than the stream remembers and yet not in the ledger."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", config.pattern).load(config.landing)
    before = F.current_timestamp() - F.make_dt_interval(F.lit(config.remembered_days))
    old = listing.select("path", "modificationTime").where(F.col("modificationTime") < before)
    ledger, name, last = LoadLedger(spark, config.table), f"forgotten.{uuid.uuid4().hex}", ""
    while True:
        found = ledger.unloaded(old.where(F.col("path") > last)).orderBy("path").limit(config.max_files_per_batch).collect()
        if not found:
            return
        last, load = found[-1]["path"], f"{name}-{len(run.loads):010d}"
        files = _load_new(spark, config, [row["path"] for row in found], load, on_load)
        run.loads.append(load)
        run.files += files


def start_ingest(
    spark: SparkSession, config: IngestConfig, every: str | None = None, on_load: OnLoad | None = None
) -> IngestRun:
    """Start loading. With `every` ("15 minutes") the folder is polled, else the files present are loaded once.

    `on_load` runs after each load, e.g. to refresh marts or run tests. If it raises, the load counts as cut off: the
    next ingest of the table, with this checkpoint or another one, drops its rows and loads its files again.
    """
    run = IngestRun()
    started = threading.Event()

    def load_batch(files: DataFrame, batch: int) -> None:
        started.wait()
        # At most max_files_per_batch short strings, which the file source holds on the driver as well.
        # The listing of a batch can name a file twice where another name in it needs escaping.
        paths = sorted({row["path"] for row in files.collect()})
        if not paths:
            return
        load = f"{run.query.id}-{batch:010d}"
        # In the caller's session, so that it sees the new files at once.
        loaded = _load_new(spark, config, paths, load, on_load)
        if loaded:
            run.loads.append(load)
            run.files += loaded

    ensure_table(spark, config.table, config.table_schema(), config.partition_columns)
    LoadLedger(spark, config.table).ensure()
    recover_loads(spark, config)
    _load_forgotten(spark, config, on_load, run)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = landed_files(spark, config).writeStream.foreachBatch(load_batch)
    run.query = writer.option("checkpointLocation", config.checkpoint).trigger(**trigger).start()
    started.set()
    return run


def ingest_files(spark: SparkSession, config: IngestConfig, on_load: OnLoad | None = None) -> int:
    """Load every file that was not loaded before and return how many there were."""
    return start_ingest(spark, config, on_load=on_load).wait().files


def _partitions(spark: SparkSession, table: str) -> DataFrame:
    """Date (if the table is split by date) and load of each partition of a raw table, from the catalog."""
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    value = lambda column: F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1)
    return listed.select(value(EVENT_DATE).try_cast("date").alias(EVENT_DATE), value(LOAD).alias(LOAD))


def compact(spark: SparkSession, config: IngestConfig, before: dt.date) -> int:
    """Put the loads of each date before `before` into one partition. Returns the number of partitions replaced.

    The newest load of each ingest is left alone, as a replay may write it again. A crash loses nothing and doubles
    nothing for good: what is replaced is listed in the shared folder and named in a table property, and the next
    `compact` or `recover_compaction` undoes a write that did not finish, or finishes dropping what it replaced.
    Between the end of the write and the drop, readers see the rows twice, so run it between builds.
    """
    if not config.event_time:
        raise ConfigError("only a raw table that is split by event date can be compacted")
    recover_compaction(spark, config)
    known = _partitions(spark, config.table).where(F.col(EVENT_DATE) < F.lit(before))
    every = _partitions(spark, config.table).select(LOAD).distinct()
    ingest = F.regexp_extract(LOAD, "^(.*)-[0-9]+$", 1)
    newest = every.groupBy(ingest.alias("_ingest")).agg(F.max(LOAD).alias(LOAD)).where("_ingest <> ''")
    known = known.join(newest, LOAD, "left_anti")
    several = known.groupBy(EVENT_DATE).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    path, load = scratch_path(spark, "compaction"), f"compacted.{uuid.uuid4().hex}"
    known.join(several, EVENT_DATE, "left_semi").select(EVENT_DATE, LOAD).write.parquet(path)
    replaced = spark.read.schema(f"{EVENT_DATE} date, {LOAD} string").parquet(path)
    dates = [row[0] for row in replaced.select(EVENT_DATE).distinct().collect()]
    if not dates:
        return 0
    _note_compaction(spark, config, f"write|{load}|{path}")
    rows = spark.table(config.table).where(F.col(EVENT_DATE).isin(dates))
    rows = rows.join(F.broadcast(replaced), [EVENT_DATE, LOAD], "left_semi").withColumn(LOAD, F.lit(load))
    overwrite_partitions(rows, config.table, config.partition_columns)
    _note_compaction(spark, config, f"drop|{load}|{path}")
    return _drop_partitions(spark, config, replaced)


def recover_compaction(spark: SparkSession, config: IngestConfig) -> None:
    """Bring a compaction that was cut off to its end, or back to its beginning."""
    found = spark.sql(f"SHOW TBLPROPERTIES {config.table}").where(F.col("key") == COMPACTION).first()
    if found is None:
        return
    step, load, path = found["value"].split("|", 2)
    if step == "drop":
        _drop_partitions(spark, config, spark.read.schema(f"{EVENT_DATE} date, {LOAD} string").parquet(path))
    else:
        _drop_partitions(spark, config, _partitions(spark, config.table).where(F.col(LOAD) == load))


def _note_compaction(spark: SparkSession, config: IngestConfig, state: str) -> None:
    spark.sql(f"ALTER TABLE {config.table} SET TBLPROPERTIES ('{COMPACTION}' = '{state}')")


def _drop_partitions(spark: SparkSession, config: IngestConfig, parts: DataFrame) -> int:
    """Drop the listed partitions and end the compaction."""
    dropped = _drop(spark, config, parts)
    spark.sql(f"ALTER TABLE {config.table} UNSET TBLPROPERTIES IF EXISTS ('{COMPACTION}')")
    return dropped


def _drop(spark: SparkSession, config: IngestConfig, parts: DataFrame) -> int:
    """Drop partitions of the raw table, a hundred in a statement."""

    def spec(day: dt.date | None, load: str) -> str:
        if not config.event_time:
            return f"PARTITION ({LOAD} = '{load}')"
        date = f"DATE'{day}'" if day else "null"
        return f"PARTITION ({EVENT_DATE} = {date}, {LOAD} = '{load}')"

    specs = [spec(*row) for row in parts.select(EVENT_DATE, LOAD).collect()]
    for i in range(0, len(specs), 100):
        spark.sql(f"ALTER TABLE {config.table} DROP IF EXISTS {', '.join(specs[i : i + 100])}")
    return len(specs)
