"""Marts whose merges and refreshes become visible at once, and stay readable whatever happens to a run.

The mart's name is a view. Its rows lie in a Parquet table split by partition and version; the view shows one version of
each partition. A run writes new versions beside the old ones and then replaces the view, which is one change in the
catalog: a reader sees the mart as it was before the run or after it, never in between. A run that dies before that
leaves versions that nobody sees; the next run removes them. Versions that the last `KEEP_RUNS` views do not show are
dropped after a run has been published, so a query that began before it can still read its files.

A full refresh writes a new table of rows, so its columns and types may differ from before. There is no log of
transactions: one writer at a time is assumed, as for any mart here.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.sources.tables import (
    NULL_PARTITION,
    PARTITION,
    PER_PARTITION,
    MartTable,
    ensure_table,
    overwrite_partitions,
)

VERSION = "_version"
KEEP_RUNS = 2


@dataclass(frozen=True)
class Shown:
    """What the view shows: the table of rows, the number of the run, and the version of each partition (as text)."""

    rows: str
    run: int
    versions: dict[str | None, int]


@dataclass(frozen=True)
class PublishedMart(MartTable):
    """A `MartTable` that is changed by publishing versions. A plain mart of the same name is taken over."""

    def _shown(self) -> Shown | None:
        """None for a mart that does not exist, or is a plain table still."""
        if not self.exists():
            return None
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        if "rows" not in found:
            return None
        # Numbers alone: a property whose text looks like a secret or an address is not shown.
        return Shown(self._rows_table(int(found["rows"])), int(found["run"]), self._manifest(int(found["run"])))

    def _rows_table(self, run: int) -> str:
        """The table of rows that the full rebuild of this run wrote."""
        return f"{self.name}__rows_{run}"

    @property
    def _manifests(self) -> str:
        return f"{self.name}__versions"

    def _manifest(self, run: int) -> dict[str | None, int]:
        """One row for each partition, which the catalog lists on the driver anyway."""
        self.spark.catalog.refreshTable(self._manifests)
        rows = self.spark.table(self._manifests).where(F.col("_run") == run).select("part", "version").collect()
        return {r["part"]: r["version"] for r in rows}

    def _literal(self, part: str) -> str:
        return f"DATE'{part}'" if self.partition_on else part

    def _condition(self, versions: dict[str | None, int]) -> str:
        """The partitions and versions shown, in terms that select directories."""
        by_version: dict[int, list[str | None]] = {}
        for part, version in versions.items():
            by_version.setdefault(version, []).append(part)
        terms = []
        for version, parts in sorted(by_version.items()):
            listed = ", ".join(sorted(self._literal(p) for p in parts if p is not None))
            either = ([f"{PARTITION} IN ({listed})"] if listed else []) + ([f"{PARTITION} IS NULL"] if None in parts else [])
            terms.append(f"({VERSION} = {version} AND ({' OR '.join(either)}))")
        return " OR ".join(terms) or "false"

    def stored(self) -> DataFrame:
        shown = self._shown()
        if shown is None:
            return super().stored()
        self.spark.catalog.refreshTable(shown.rows)
        return self.spark.table(shown.rows).where(self._condition(shown.versions)).drop(VERSION)

    def _parts(self) -> DataFrame:
        shown = self._shown()
        if shown is None:
            return super()._parts()
        return self.spark.createDataFrame([(p,) for p in shown.versions], f"{PARTITION} string")

    def stamps(self) -> dict[str | None, str]:
        """Each partition, as text, with a stamp that changes whenever its rows do."""
        shown = self._shown()
        return {p: f"{shown.rows}:{v}" for p, v in shown.versions.items()} if shown else {}

    def replace(self, df: DataFrame) -> None:
        """Full rebuild. Until it is published, readers see the old rows; `df` may read them too."""
        before = self._shown()
        run = before.run + 1 if before else 1
        rows = self._rows_table(run)
        self.spark.sql(f"DROP TABLE IF EXISTS {rows}")  # of a refresh that died
        versioned = self._with_part(df).withColumn(VERSION, F.lit(run)).hint("rebalance", PARTITION)
        versioned.write.option(PER_PARTITION, "dynamic").partitionBy(PARTITION, VERSION).saveAsTable(rows)
        self._publish(Shown(rows, run, {p: v for p, v in self._listed(rows) if v == run}), before)

    def _take_over(self) -> None:
        """Make the rows of a plain table of this name the first version. The table stays as `<name>__before`."""
        if self.exists() and self._shown() is None:
            self.replace(super().stored().drop(PARTITION))

    def upsert(
        self, source: DataFrame, keys: Sequence[str], *, null_safe: bool = True, validate: bool = True
    ) -> None:
        self._take_over()
        super().upsert(source, keys, null_safe=null_safe, validate=validate)

    def replace_from(self, source: DataFrame, column: str, low: dt.date) -> None:
        self._take_over()
        super().replace_from(source, column, low)

    def replace_dates(self, source: DataFrame, column: str, dates: Sequence[dt.date]) -> None:
        self._take_over()
        super().replace_dates(source, column, dates)

    def _commit(self, merged: DataFrame, emptied: Sequence[object] = ()) -> None:
        before = self._shown()
        run = before.run + 1
        self._drop(before.rows, [(p, v) for p, v in self._listed(before.rows) if v >= run])
        overwrite_partitions(merged.withColumn(VERSION, F.lit(run)), before.rows, [PARTITION])
        written = {p: v for p, v in self._listed(before.rows) if v == run}
        gone = {str(p) if p is not None else None for p in emptied}
        kept = {p: v for p, v in before.versions.items() if p not in gone}
        self._publish(Shown(before.rows, run, {**kept, **written}), before)

    def _listed(self, rows: str) -> list[tuple[str | None, int]]:
        """Partitions and versions on disk, from the catalog."""
        self.spark.catalog.refreshTable(rows)
        value = lambda name: F.regexp_extract("partition", f"(?:^|/){name}=([^/]*)", 1)
        found = self.spark.sql(f"SHOW PARTITIONS {rows}").select(value(PARTITION), value(VERSION)).collect()
        return [(None if p == NULL_PARTITION else p, int(v)) for p, v in found]

    def _drop(self, rows: str, versions: Sequence[tuple[str | None, int]]) -> None:
        specs = [
            f"PARTITION ({PARTITION} = {'null' if p is None else self._literal(p)}, {VERSION} = {v})" for p, v in versions
        ]
        for i in range(0, len(specs), 100):
            self.spark.sql(f"ALTER TABLE {rows} DROP IF EXISTS {', '.join(specs[i : i + 100])}")

    def _publish(self, shown: Shown, before: Shown | None) -> None:
        """Show `shown` instead of `before`, and then drop what neither shows."""
        spark = self.spark
        plain = before is None and self.exists()
        listed = [(p, v, shown.run) for p, v in shown.versions.items()]
        manifest = spark.createDataFrame(listed, "part string, version long, _run long")
        ensure_table(spark, self._manifests, manifest.schema, ["_run"])
        overwrite_partitions(manifest, self._manifests, ["_run"])
        if plain:
            spark.sql(f"ALTER TABLE {self.name} RENAME TO {self.name}__before")
        columns = ", ".join(f"`{c}`" for c in spark.table(shown.rows).columns if c not in (PARTITION, VERSION))
        rebuilt = shown.rows.rpartition("_")[2]
        spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('rows' = '{rebuilt}', 'run' = '{shown.run}') AS "
            f"SELECT {columns} FROM {shown.rows} WHERE {self._condition(shown.versions)}"
        )
        self._purge(shown, before)

    def _purge(self, shown: Shown, before: Shown | None) -> None:
        """Keep what the last `KEEP_RUNS` views showed: this one, and those whose manifests are kept."""
        kept = {(p, v) for run in range(shown.run - KEEP_RUNS + 1, shown.run + 1) for p, v in self._manifest(run).items()}
        self._drop(shown.rows, [(p, v) for p, v in self._listed(shown.rows) if (p, v) not in kept])
        old = [r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self._manifests}").collect()]
        for run in (int(r.split("=")[1]) for r in old):
            if run <= shown.run - KEEP_RUNS:
                self.spark.sql(f"ALTER TABLE {self._manifests} DROP IF EXISTS PARTITION (_run = {run})")
        if before and before.rows != shown.rows:
            # Tables of rows before the last one; the last one may still be read by queries that began earlier.
            schema, _, name = self.name.rpartition(".")
            within = f" IN {schema}" if schema else ""
            for row in self.spark.sql(f"SHOW TABLES{within} LIKE '{name}__rows_*'").collect():
                table = f"{schema}.{row['tableName']}" if schema else row["tableName"]
                if table not in (shown.rows, before.rows):
                    self.spark.sql(f"DROP TABLE IF EXISTS {table}")

