"""Reading and writing catalog tables: views, full replacement, and merges into partitioned Parquet tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.config import ConfigError, schema_name
from lakemart.operators.incremental import from_date, high_water_mark, merge_upsert, replace_window
from lakemart.operators.joins import SideProfile, row_width
from lakemart.session import stable

PARTITION = "_part"
# Fixed value: the directory name of a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Table option: overwriting replaces only the partitions that are written.
PER_PARTITION = "partitionOverwriteMode"


def source(spark: SparkSession, schema: str, table: str) -> DataFrame:
    return spark.table(f"{schema}.{table}")


def ensure_schema(spark: SparkSession, target: str, layer: str | None = None, location: str | None = None) -> str:
    """Create the schema of a layer if needed and return its name."""
    name = schema_name(target, layer)
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")
    return name


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a lazy view: nothing is stored and each use sees the current data."""
    df.createOrReplaceTempView(name)
    return df


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Full replacement of a table that `df` does not read itself."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Create an empty Parquet table unless it exists. Partition columns must be in `schema`."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f" OPTIONS ({PER_PARTITION} 'dynamic') PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by}")


def add_missing_columns(spark: SparkSession, name: str, schema: T.StructType) -> list[str]:
    """Add the columns that the table lacks; rows written before read null. Returns the added names."""
    known = {c.lower() for c in spark.table(name).columns}
    new = [f for f in schema if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def partition_values(spark: SparkSession, name: str, column: str, within: dict[str, str] | None = None) -> DataFrame:
    """Distinct values of a partition column as text, from the catalog alone: no file is opened."""
    spec = ", ".join(f"{k} = '{v}'" for k, v in (within or {}).items())
    listed = spark.sql(f"SHOW PARTITIONS {name}" + (f" PARTITION ({spec})" if spec else ""))
    value = F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1)
    return listed.select(F.when(value != NULL_PARTITION, value).alias(column)).distinct()


def overwrite_partitions(df: DataFrame, name: str, balance_by: Sequence[str]) -> None:
    """Replace the partitions of `name` that occur in `df`; `df` may read the table.

    The rebalance step gathers each partition's rows into few files, and splits a partition that is too big for
    one task over several. The table itself must say that overwriting is per partition, so that no session
    setting can turn this into a loss of the other partitions.
    """
    spark = df.sparkSession
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Storage Properties'").first()
    if described is None or f"{PER_PARTITION}=dynamic" not in described["data_type"]:
        raise ConfigError(f"table '{name}' was not created with {PER_PARTITION}=dynamic")
    columns = spark.table(name).columns
    df.select(*columns).hint("rebalance", *balance_by).write.mode("overwrite").insertInto(name)


@dataclass(frozen=True)
class MartTable:
    """A merge target: a Parquet table split by a coarse unit of one date column, or by nothing.

    The partition column is physical only; `read` hides it. It is fixed when the table is created, so a new grain
    or key needs a full refresh. A merge rewrites only the partitions that the source touches, and swaps each of
    them in when the job commits. If the driver dies during a swap, that partition is missing: the newest one
    lowers the high-water mark, so the next run refills it; an older one is a gap, which a backfill refills.
    """

    spark: SparkSession
    name: str
    partition_on: str | None = None
    partition_unit: str = "month"

    def on(self, spark: SparkSession) -> MartTable:
        """The same table seen from another session, e.g. that of a micro-batch."""
        return replace(self, spark=spark)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def stored(self) -> DataFrame:
        """The table with its partition column, and without files that this session remembers from before."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def read(self) -> DataFrame:
        return self.stored().drop(PARTITION)

    def _parts(self) -> DataFrame:
        """The values of the partition column, as text."""
        return partition_values(self.spark, self.name, PARTITION)

    def _part(self, day: Column) -> Column:
        return F.trunc(day.cast("date"), self.partition_unit)

    def _with_part(self, df: DataFrame) -> DataFrame:
        part = self._part(F.col(self.partition_on)) if self.partition_on else F.lit(0)
        return df.withColumn(PARTITION, part)

    def replace(self, df: DataFrame) -> None:
        """Full rebuild. `df` must not read this table."""
        rows = self._with_part(df).hint("rebalance", PARTITION)
        writer = rows.write.mode("overwrite").option(PER_PARTITION, "dynamic")
        writer.partitionBy(PARTITION).saveAsTable(self.name)

    def high_water_mark(self, column: str) -> dt.date | None:
        """Newest date. When the table is split by that column, only its newest partition is read."""
        rows = self.stored()
        if column != self.partition_on:
            return high_water_mark(rows, column)
        part = F.col(PARTITION).cast("date")
        parts, newest = self._parts().select(part.alias(PARTITION)), None
        while True:
            # A partition may be left without rows by a crash between two swaps; then an older one has the mark.
            older = parts if newest is None else parts.where(F.col(PARTITION) < F.lit(newest))
            newest = older.agg(F.max(PARTITION).alias("part")).first()["part"]
            mark = None if newest is None else high_water_mark(rows.where(F.col(PARTITION) == F.lit(newest)), column)
            if newest is None or mark is not None:
                return mark

    def upsert(
        self, source: DataFrame, keys: Sequence[str], *, null_safe: bool = True, validate: bool = True
    ) -> None:
        """Merge `source` into the table by key. `validate` checks that its keys are unique."""
        if not keys:
            raise ConfigError(f"a merge into '{self.name}' needs at least one key column")
        if self.partition_on and self.partition_on not in keys:
            # A changed row could sit in a partition that the source does not touch.
            raise ConfigError(f"'{self.name}' is split by '{self.partition_on}', which must be one of {list(keys)}")
        source = stable(self._with_part(source))
        # One row per touched partition directory, which the catalog lists on the driver anyway.
        sizes = source.groupBy(PARTITION).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(row_width(source)).alias("bytes")
        )
        found = sizes.collect()
        if not found:
            return
        touched = [row[PARTITION] for row in found]
        size = SideProfile(sum(r["rows"] for r in found), sum(r["bytes"] for r in found), 0, tuple(keys))
        part = F.col(PARTITION)
        among = part.isin([p for p in touched if p is not None])
        target = self.stored().where(among | part.isNull() if None in touched else among)
        merged = merge_upsert(target, source, keys, null_safe=null_safe, validate=validate, profile=size)
        self._commit(merged)

    def replace_from(self, source: DataFrame, column: str, low: dt.date) -> None:
        """Replace everything from `low` on by `source`."""
        source = stable(self._with_part(source))
        target = self.stored()
        if column == self.partition_on:
            target = target.where(F.col(PARTITION) >= self._part(F.lit(low)))
        self._swap(target, stable(replace_window(target, source, column, low)))

    def replace_dates(self, source: DataFrame, column: str, dates: Sequence[dt.date]) -> None:
        """Replace the given dates by `source`, which holds rows of no other date. Groups it lacks disappear."""
        if not dates:
            return
        source = stable(self._with_part(source))
        target, day = self.stored(), F.col(column).cast("date")
        if column == self.partition_on:
            parts = [row[0] for row in self.spark.createDataFrame([(d,) for d in dates], "d date").select(self._part(F.col("d"))).distinct().collect()]
            target = target.where(F.col(PARTITION).isin(parts))
        kept = target.where(~day.isin(list(dates)) | day.isNull())
        self._swap(target, stable(kept.unionByName(source.select(*target.columns))))

    def _swap(self, target: DataFrame, merged: DataFrame) -> None:
        """Put `merged` in the place of `target`, some partitions of this table, and drop those it leaves empty."""
        emptied = target.select(PARTITION).distinct().join(merged.select(PARTITION).distinct(), PARTITION, "left_anti")
        self._commit(merged, [row[0] for row in emptied.collect()])

    def _commit(self, merged: DataFrame, emptied: Sequence[object] = ()) -> None:
        """Replace the partitions that occur in `merged`, and drop the `emptied` ones."""
        overwrite_partitions(merged, self.name, [PARTITION])
        for part in emptied:
            value = f"DATE'{part}'" if isinstance(part, dt.date) else part
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({PARTITION} = {value})")
