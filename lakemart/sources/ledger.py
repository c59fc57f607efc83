"""Which landed files a raw table has loaded. The list belongs to the table, not to the query that fills it.

A load is entered in two steps: its files are claimed before the data is written, and marked as loaded after it. A load
that has claimed files and never marked them was cut off; its rows are dropped and its files are free again. Both marks
are one partition of a small Parquet table, so each appears at once or not at all.

Many small marks are packed from time to time into partitions by the hash of the path, of which a look-up opens only
those that its own paths hash to. The list is a set: a file that is listed twice, as by a pack that was cut off, is
loaded all the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.sources.landed import SOURCE_FILE
from lakemart.sources.tables import PER_PARTITION, overwrite_partitions

STATE, LOAD = "_state", "_load"
CLAIMED, LOADED, PACKED = "claimed", "loaded", "packed"
BUCKETS = 64
# Marks that pile up before they are packed.
PACK_AFTER = 100
# The load under which files are entered that a table had loaded before it had a ledger.
EARLIER = "earlier"


def file_identity(path: Column) -> Column:
    """A path in one spelling: `file:///a` and `file:/a` are one file."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _decoded(path: Column) -> Column:
    """A path out of the file metadata column, where it is URL-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


@dataclass(frozen=True)
class LoadLedger:
    """The files that `table` has loaded, in the table `<table>__files` beside it."""

    spark: SparkSession
    table: str

    @property
    def name(self) -> str:
        return f"{self.table}__files"

    def ensure(self) -> None:
        """Create the ledger. Files that the table holds already are entered as loaded, in the same statement."""
        if self.spark.catalog.tableExists(self.name):
            return
        known = self.spark.table(self.table).select(file_identity(_decoded(F.col(SOURCE_FILE))).alias("path")).distinct()
        rows = known.where("path IS NOT NULL").withColumns({STATE: F.lit(LOADED), LOAD: F.lit(EARLIER)})
        rows.write.option(PER_PARTITION, "dynamic").partitionBy(STATE, LOAD).saveAsTable(self.name)

    def _rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def _loads(self, state: str) -> list[str]:
        """Loads with a mark of this kind, from the catalog. Packing keeps their number small."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name} PARTITION ({STATE} = '{state}')")
        return sorted(row[0].split(f"{LOAD}=")[1] for row in listed.collect())

    def _write(self, rows: DataFrame, state: str, load: Column) -> None:
        overwrite_partitions(rows.select("path").withColumns({STATE: F.lit(state), LOAD: load}), self.name, [STATE, LOAD])

    def _drop(self, state: str, loads: list[str]) -> None:
        specs = [f"PARTITION ({STATE} = '{state}', {LOAD} = '{load}')" for load in loads]
        for i in range(0, len(specs), 100):
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {', '.join(specs[i : i + 100])}")

    @staticmethod
    def _bucket(path: Column) -> Column:
        return F.format_string("%03d", F.pmod(F.xxhash64(path), F.lit(BUCKETS)))

    def unloaded(self, files: DataFrame) -> DataFrame:
        """Those of `files` (path and what goes with it) that no finished load has. Paths come out as they went in."""
        files = files.withColumn("_identity", file_identity(F.col("path")))
        # At most BUCKETS short strings.
        buckets = [row[0] for row in files.select(self._bucket(F.col("_identity"))).distinct().collect()]
        marks = (F.col(STATE) == LOADED) | ((F.col(STATE) == PACKED) & F.col(LOAD).isin(buckets))
        loaded = self._rows().where(marks).select(F.col("path").alias("_identity"))
        return files.join(loaded, "_identity", "left_anti").drop("_identity")

    def claim(self, load: str, files: DataFrame) -> None:
        """First step: `files` (path) are about to be loaded."""
        self._drop(CLAIMED, [load])
        self._write(files.select(file_identity(F.col("path")).alias("path")), CLAIMED, F.lit(load))

    def finish(self, load: str) -> None:
        """Second step: the rows of the claimed files are in the table."""
        self._write(self._rows().where((F.col(STATE) == CLAIMED) & (F.col(LOAD) == load)), LOADED, F.lit(load))
        self._drop(CLAIMED, [load])
        if len(self._loads(LOADED)) >= PACK_AFTER:
            self.pack()

    def cut_off(self) -> list[str]:
        """Loads that were begun and not finished. What a finished one has left behind is cleared away."""
        finished = set(self._loads(LOADED))
        claimed = self._loads(CLAIMED)
        self._drop(CLAIMED, [load for load in claimed if load in finished])
        return [load for load in claimed if load not in finished]

    def release(self, load: str) -> None:
        """Give up the claim of a load whose rows are gone."""
        self._drop(CLAIMED, [load])

    def pack(self) -> None:
        """Move the marks of finished loads into partitions by path hash, then drop them."""
        loads = self._loads(LOADED)
        moved = self._rows().where((F.col(STATE) == PACKED) | (F.col(STATE) == LOADED) & F.col(LOAD).isin(loads))
        self._write(moved.select("path").distinct(), PACKED, self._bucket(F.col("path")))
        self._drop(LOADED, loads)
