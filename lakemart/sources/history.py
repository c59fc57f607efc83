"""Stored type 2 history. Open and closed versions live apart, so a snapshot rewrites only the open ones.

Layout below `location`: `open/_run=<n>` holds the open versions after run n. What a run closes is a set of files of its own,
`slices/_set=<name>/_slice=<month>`, split by the month in which the versions ended, so a read of a span of time opens only
what ended after its beginning (`valid_between`). `MERGE_SETS` sets of one level are merged into one of the next, so the
number of sets grows with the logarithm of the runs. `manifest/_run=<n>` lists the sets of run n.

The catalog view reads the open versions and the sets of the newest run, so a run becomes visible when the view is
replaced, and a run that died before that is overwritten by the next one. The last `KEEP_RUNS` runs stay for rollback; files
that only older ones need are deleted after a run has been published. A run that changes nothing is not published.
Without its view a history that has files is never written to: `restore` brings the view back.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.config import ConfigError, DimensionConfig
from lakemart.functions.audit import instant, utc_now
from lakemart.operators.scd import advance, current, first_versions, require_keys
from lakemart.session import stable

RUN, SET, SLICE = "_run", "_set", "_slice"
KEEP_RUNS = 2
MERGE_SETS = 8
MANIFEST = "name string, level int"

# A set of closed versions, and how many times its versions were merged.
Sets = list[tuple[str, int]]


@dataclass(frozen=True)
class HistoryTable:
    spark: SparkSession
    name: str
    location: str

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def current(self) -> DataFrame:
        """One row per key as of the newest run. The closed versions are not opened."""
        return current(self._open_rows(self.run_number()))

    def run_number(self) -> int:
        """The newest visible run, 0 before the first."""
        if not self.exists():
            return 0
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").where("key = 'run'").first()
        return int(found["value"])

    def stored_runs(self) -> list[int]:
        """The runs that have open versions on disk: a handful, see `KEEP_RUNS`."""
        files, folder = self._folder("open")
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(n.removeprefix(f"{RUN}=")) for n in names if n.startswith(f"{RUN}="))

    def restore(self, run: int | None = None) -> int:
        """Publish a stored run again, by default the newest one, after its view was lost or to roll back."""
        run = run or max(self.stored_runs(), default=0)
        if run not in self.stored_runs():
            raise ConfigError(f"history '{self.name}' has no stored run {run}")
        self._publish(run)
        return run

    def _folder(self, part: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.location}/{part}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _open_rows(self, run: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.location}/open/{RUN}={run}")

    def snapshot(
        self,
        incoming: DataFrame,
        config: DimensionConfig,
        now: dt.datetime | None = None,
        hard_deletes: str = "keep",
    ) -> int:
        """Compare `incoming` with the open versions and publish the result. Returns the number of the newest run."""
        require_keys(incoming, config.business_key)
        now, last = now or utc_now(), self.run_number()
        if last == 0 and self.stored_runs():
            raise ConfigError(f"history '{self.name}' has files in {self.location} but no view; restore() it first")
        run = last + 1
        sets: Sets = []
        if last == 0:
            self._write(first_versions(incoming, now), "open", run)
        else:
            versions = stable(advance(self._open_rows(last), incoming, config, now, hard_deletes))
            changed = (F.col("valid_to") == instant(now)) | (F.col("updated_at") == instant(now))
            if versions.columns == self._open_rows(last).columns and versions.where(changed).isEmpty():
                return last
            self._write(versions.where(F.col("valid_to").isNull()), "open", run)
            closed = versions.where(F.col("valid_to").isNotNull())
            sets = self._sets(last) if self._exists(f"manifest/{RUN}={last}") else self._taken_over(last)
            if not closed.isEmpty():
                sets = self._merged([*sets, self._write_set(closed, run, 0)], run)
        self._write(self.spark.createDataFrame(sets, MANIFEST).coalesce(1), "manifest", run)
        self._publish(run)
        self._purge(run)
        return run

    def _exists(self, part: str) -> bool:
        files, folder = self._folder(part)
        return files.exists(folder)

    def _taken_over(self, run: int) -> Sets:
        """The closed versions of a history from before there were sets, one folder for each run, as a set."""
        if not self._exists("closed"):
            return []
        rows = self.spark.read.option("mergeSchema", True).parquet(f"{self.location}/closed").where(F.col(RUN) <= run)
        return [self._write_set(rows.drop(RUN), run, 0)]

    def _sets(self, run: int) -> Sets:
        """The sets of closed versions that run shows: some `MERGE_SETS` for each level."""
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.location}/manifest/{RUN}={run}").collect()
        return sorted((r["name"], r["level"]) for r in rows)

    def _closed_rows(self, sets: Sets) -> DataFrame:
        # Sets from before a column was added do not have it: their schemas are merged.
        rows = self.spark.read.option("mergeSchema", True).parquet(f"{self.location}/slices")
        return rows.where(F.col(SET).isin([name for name, _ in sets]))

    def _write_set(self, rows: DataFrame, run: int, level: int) -> tuple[str, int]:
        name = f"r{run}l{level}"
        sliced = rows.withColumn(SLICE, F.trunc(F.col("valid_to").cast("date"), "month")).hint("rebalance", SLICE)
        sliced.write.mode("overwrite").partitionBy(SLICE).parquet(f"{self.location}/slices/{SET}={name}")
        return name, level

    def _merged(self, sets: Sets, run: int) -> Sets:
        """Merge the sets of each level that has enough of them."""
        level = 0
        while len(alike := [s for s in sets if s[1] == level]) >= MERGE_SETS:
            rows = self._closed_rows(alike).drop(SET, SLICE)
            sets = [*[s for s in sets if s[1] != level], self._write_set(rows, run, level + 1)]
            level += 1
        return sets

    def valid_between(self, low: dt.datetime, high: dt.datetime) -> DataFrame:
        """The versions that hold at some time from `low` to `high`. Slices that ended before `low` are not opened."""
        run = self.run_number()
        began = F.col("valid_from") <= instant(high)
        rows, sets = self._open_rows(run).where(began), self._sets(run)
        if not sets:
            return rows
        closed = self._closed_rows(sets).where(F.col(SLICE) >= F.lit(low.date().replace(day=1)))
        closed = closed.where(began & (F.col("valid_to") > instant(low))).drop(SET, SLICE)
        return rows.unionByName(closed, allowMissingColumns=True)

    def _purge(self, run: int) -> None:
        """Delete open versions, manifests and sets that only runs before the last `KEEP_RUNS` need."""
        kept = range(run - KEEP_RUNS + 1, run + 1)
        known = [r for r in kept if self._exists(f"manifest/{RUN}={r}")]
        needed = {f"{SET}={name}" for r in known for name, _ in self._sets(r)}
        old = {f"{RUN}={r}" for r in self.stored_runs() if r not in kept}
        for part, gone in (("open", old), ("manifest", old)):
            files, folder = self._folder(part)
            for name in gone:
                files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(folder, name), True)
        files, folder = self._folder("slices")
        if files.exists(folder):
            for status in files.listStatus(folder):
                if status.getPath().getName() not in needed:
                    files.delete(status.getPath(), True)

    def _write(self, rows: DataFrame, part: str, run: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.location}/{part}/{RUN}={run}")

    def _publish(self, run: int) -> None:
        open_rows, sets = self._open_rows(run), self._sets(run)
        columns = ", ".join(f"`{c}`" for c in open_rows.columns)
        closed = ""
        if sets:
            known = {c.lower() for c in self._closed_rows(sets).columns}
            shown = ", ".join(
                f"`{f.name}`" if f.name.lower() in known else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
                for f in open_rows.schema
            )
            names = ", ".join(f"'{name}'" for name, _ in sets)
            closed = (
                f" UNION ALL SELECT {shown} FROM parquet.`{self.location}/slices` WITH (`mergeSchema` = 'true')"
                f" WHERE {SET} IN ({names})"
            )
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('run' = '{run}') AS "
            f"SELECT {columns} FROM parquet.`{self.location}/open/{RUN}={run}`{closed}"
        )
