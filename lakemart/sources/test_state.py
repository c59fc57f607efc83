"""Data tests that look only at the partitions that changed, and give the results of the whole table.

For each partition the state keeps how many rows fail each test of single rows, digests of the keys that must be unique
with their copies, the values that must occur in a parent, and the times that lie in the future. A run replaces what is kept of
partitions whose stamp has changed, say the version that a published mart shows, and adds up the state of all: an untouched
partition is not opened. A build that died before its tests leaves old stamps, so the next one catches up.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.config import ConfigError
from lakemart.functions.audit import instant, utc_now
from lakemart.operators.joins import without_matches
from lakemart.operators.quality import TableTests
from lakemart.sources.tables import ensure_table, overwrite_partitions

PART = "part"
# The text that stands for the null partition.
NO_PART = "__null__"
COLUMNS = {"kind": "string", "test": "string", "a": "bigint", "b": "bigint", "value": "string", "at": "timestamp_ntz", "n": "bigint"}


@dataclass(frozen=True)
class StoredTests:
    """The tests of one table, with their state in the table `name`."""

    spark: SparkSession
    name: str
    tests: TableTests

    def run(
        self,
        rows: DataFrame,
        part: str,
        stamps: Mapping[str | None, str],
        now: dt.datetime | None = None,
        parents: Mapping[str, DataFrame] | None = None,
    ) -> DataFrame:
        """One row per test: table, test, failures, as `run_tests` gives them for all `rows`.

        `stamps` has every partition of the table, that is every value of the column `part` as text, with a stamp that
        changes with its rows. Keys are compared by 128-bit hashes. Time must not go back between runs.
        """
        now = now or utc_now()
        suite = hashlib.sha256(repr(self.tests).encode()).hexdigest()[:16]
        wanted = {p if p is not None else NO_PART: f"{suite}|{stamp}" for p, stamp in stamps.items()}
        schema = T.StructType([*[T.StructField(c, T._parse_datatype_string(t)) for c, t in COLUMNS.items()], T.StructField(PART, T.StringType())])
        ensure_table(self.spark, self.name, schema, [PART])
        known = self._stamps()
        touched = sorted(p for p, stamp in wanted.items() if known.get(p) != stamp)
        if touched:
            named = [p for p in touched if p != NO_PART]
            changed = F.col(part).cast("string").isin(named) if rows.schema[part].dataType == T.StringType() else self._typed(rows, part, named)
            changed = changed | F.col(part).isNull() if NO_PART in touched else changed
            marks = self.spark.createDataFrame([(p, wanted[p]) for p in touched], f"{PART} string, value string")
            state = self._state(rows.where(changed).withColumn("_part_text", F.coalesce(F.col(part).cast("string"), F.lit(NO_PART))), now)
            overwrite_partitions(state.unionByName(_shaped(marks.withColumn("kind", F.lit("stamp")))), self.name, [PART])
        gone = sorted(set(known) - set(wanted))
        for i in range(0, len(gone), 100):
            specs = ", ".join(f"PARTITION ({PART} = '{p}')" for p in gone[i : i + 100])
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {specs}")
        return self._results(now, parents or {})

    @staticmethod
    def _typed(rows: DataFrame, part: str, named: list[str]) -> Column:
        """The partitions as literals of their own type, so that they select directories."""
        return F.col(part).isin([F.lit(p).cast(rows.schema[part].dataType) for p in named])

    def _table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def _stamps(self) -> dict[str, str]:
        """One row for each partition, as many as the catalog lists."""
        return {r[PART]: r["value"] for r in self._table().where("kind = 'stamp'").select(PART, "value").collect()}

    def _keys(self) -> dict[str, tuple[list[str], bool]]:
        """Columns of each uniqueness test, and whether null is a key."""
        one = {f"unique:{c}": ([c], False) for c in self.tests.unique}
        return one | {f"unique_combination:{','.join(c)}": (list(c), True) for c in self.tests.unique_combination}

    def _state(self, rows: DataFrame, now: dt.datetime) -> DataFrame:
        by, count = F.col("_part_text").alias(PART), F.count(F.lit(1)).alias("n")
        future = {f"no_future:{c}" for c in self.tests.no_future}
        conditions = {t: bad for t, bad in self.tests.row_conditions(now).items() if t not in future}
        parts = []
        if conditions:
            sums = [F.sum(F.when(bad, 1).otherwise(0)).cast("bigint").alias(f"_f{i}") for i, bad in enumerate(conditions.values())]
            one = rows.groupBy(by).agg(*sums)
            pairs = [F.struct(F.lit(t).alias("test"), F.col(f"_f{i}").alias("n")) for i, t in enumerate(conditions)]
            parts.append(one.select(PART, F.explode(F.array(*pairs)).alias("_p")).select(PART, "_p.*", F.lit("row").alias("kind")))
        for test, (columns, nulls) in self._keys().items():
            kept = rows if nulls else rows.where(F.col(columns[0]).isNotNull())
            # A null counts with its place, so it is not mistaken for a missing value of another column.
            values = [v for c in columns for v in (F.col(c), F.col(c).isNull())]
            digests = [F.xxhash64(F.lit(i), *values).alias(name) for i, name in enumerate("ab")]
            parts.append(kept.groupBy(by, *digests).agg(count).withColumns({"kind": F.lit("key"), "test": F.lit(test)}))
        for column, *_ in self.tests.relationships:
            values = rows.where(F.col(column).isNotNull()).groupBy(by, F.col(column).cast("string").alias("value")).agg(count)
            parts.append(values.withColumns({"kind": F.lit("value"), "test": F.lit(f"relationships:{column}")}))
        for column in self.tests.no_future:
            later = rows.where(F.col(column) > instant(now)).groupBy(by, F.col(column).cast("timestamp_ntz").alias("at")).agg(count)
            parts.append(later.withColumns({"kind": F.lit("future"), "test": F.lit(f"no_future:{column}")}))
        empty = _shaped(rows.sparkSession.createDataFrame([], f"{PART} string"))
        return reduce(DataFrame.unionByName, map(_shaped, parts), empty)

    def _results(self, now: dt.datetime, parents: Mapping[str, DataFrame]) -> DataFrame:
        state = self._table()
        names = list(self.tests.row_conditions(now)) + list(self._keys())
        names += [f"relationships:{c}" for c, *_ in self.tests.relationships]
        found = [state.where("kind = 'row'").select("test", "n")]
        copies = state.where("kind = 'key'").groupBy("test", "a", "b").agg(F.sum("n").alias("n"))
        found.append(copies.where("n > 1").select("test", F.lit(1).cast("bigint").alias("n")))
        found.append(state.where((F.col("kind") == "future") & (F.col("at") > instant(now))).select("test", "n"))
        for column, parent, parent_column in self.tests.relationships:
            if parent not in parents:
                raise ConfigError(f"tests of '{self.tests.table}' need the table '{parent}'")
            test = f"relationships:{column}"
            values = state.where((F.col("kind") == "value") & (F.col("test") == test)).groupBy("value").agg(F.sum("n").alias("n"))
            known = parents[parent].select(F.col(parent_column).cast("string").alias("value")).dropna().distinct()
            orphans = without_matches(values, known, ["value"], null_safe=False)
            found.append(orphans.select(F.lit(test).alias("test"), "n"))
        zero = self.spark.createDataFrame([(n, 0) for n in names], "test string, n bigint")
        every = reduce(DataFrame.unionByName, found, zero)
        totals = every.groupBy("test").agg(F.sum("n").cast("bigint").alias("failures"))
        return totals.select(F.lit(self.tests.table).alias("table"), "test", "failures")


def _shaped(df: DataFrame) -> DataFrame:
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in COLUMNS.items()], PART)
