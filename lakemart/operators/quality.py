"""Data tests. A test is a query for failing rows: no rows means it passes.

Tests on values return grouped values with counts rather than raw rows, so a value that fails a billion times is
one row, combined before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.config import ConfigError, FreshnessConfig
from lakemart.functions.audit import instant, utc_now
from lakemart.operators.joins import without_matches


class DataTestError(AssertionError):
    """At least one data test found failing rows."""


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where `column` is null."""
    return df.where(F.col(column).isNull())


def _value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_records"))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their counts. Nulls are ignored."""
    return _value_counts(not_missing(df, column), column).where("n_records > 1")


def not_missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their counts. Null passes."""
    return _value_counts(df.where(~F.col(column).isin(list(values))), column)


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once. Null is a key value like any other."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def no_future(df: DataFrame, column: str, now: dt.datetime | None = None) -> DataFrame:
    """Rows later than `now`."""
    return df.where(F.col(column) > instant(now or utc_now()))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with their counts. Null passes.

    The child is reduced to its distinct values first, so no hot value reaches the join.
    """
    values = _value_counts(not_missing(child, column), column)
    parents = not_missing(parent, parent_column).select(F.col(parent_column).alias("value")).distinct()
    return without_matches(values, parents, ["value"], null_safe=False)


def singular(failing_rows: DataFrame) -> DataFrame:
    """Any query for failing rows is a test; this only names the contract."""
    return failing_rows


def latest_rows(df: DataFrame, newest_by: str, tie_breakers: Sequence[str], n: int = 10) -> DataFrame:
    """The `n` newest rows. Tie breakers make the choice repeatable; each task keeps only `n` rows."""
    return df.orderBy(F.desc(newest_by), *[F.asc_nulls_first(c) for c in tie_breakers]).limit(n)


def freshness(
    df: DataFrame, config: FreshnessConfig, now: dt.datetime | None = None, ignore_future: bool = True
) -> DataFrame:
    """One row: newest load time, its age in hours and pass, warn or error; plus the rows dated in the future.

    A future-dated row would hide that a source is stale, so such rows are left out unless asked for.
    """
    at = instant(now or utc_now())
    loaded = F.col(config.loaded_at_field)
    if isinstance(df.schema[config.loaded_at_field].dataType, T.TimestampType):
        # An instant as its wall clock in UTC, whatever the zone of the session.
        loaded = F.timestamp_add("MICROSECOND", F.unix_micros(loaded), F.expr("TIMESTAMP_NTZ'1970-01-01'"))
    loaded = loaded.cast("timestamp_ntz")
    counted = F.when(loaded <= at, loaded) if ignore_future else loaded
    summary = df.agg(
        F.max(counted).alias("max_loaded_at"),
        F.coalesce(F.sum(F.when(loaded > at, 1).otherwise(0)), F.lit(0)).alias("future_rows"),
    )
    # Between two wall clocks, so that no zone and no change to summer time comes in.
    micros = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), at)
    age = micros / F.lit(3_600_000_000)
    status = (
        F.when(F.col("max_loaded_at").isNull() | (age > config.error_after_hours), "error")
        .when(age > config.warn_after_hours, "warn")
        .otherwise("pass")
    )
    return summary.select("max_loaded_at", "future_rows", age.alias("age_hours"), status.alias("status"))


@dataclass(frozen=True)
class TableTests:
    """The tests declared for one table."""

    table: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted_values: Mapping[str, Sequence] = field(default_factory=dict)
    unique_combination: Sequence[Sequence[str]] = ()
    no_future: Sequence[str] = ()
    # (column, parent table, parent column): each value must occur in the parent.
    relationships: Sequence[tuple[str, str, str]] = ()

    def row_conditions(self, now: dt.datetime) -> dict[str, Column]:
        """For each test that looks at single rows, the condition of a failing row."""
        return {
            **{f"not_null:{c}": F.col(c).isNull() for c in self.not_null},
            **{f"accepted_values:{c}": ~F.col(c).isin(list(v)) for c, v in self.accepted_values.items()},
            **{f"no_future:{c}": F.col(c) > instant(now) for c in self.no_future},
        }


def _counted(df: DataFrame, row_tests: Mapping[str, Column], name: str, keys: Sequence[str], nulls: bool) -> DataFrame:
    """Failures of a uniqueness test, and of the row tests counted along in the same pass over `df`."""
    per_row = [F.sum(F.when(bad, 1).otherwise(0)).alias(f"_t{i}") for i, bad in enumerate(row_tests.values())]
    groups = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("_n"), *per_row
    )
    repeated = F.col("_n") > 1
    if not nulls:
        repeated = repeated & F.col("_k0").isNotNull()
    totals = [F.sum(f"_t{i}") for i in range(len(row_tests))] + [F.sum(F.when(repeated, 1).otherwise(0))]
    return _as_rows(groups, [*row_tests, name], totals)


def _as_rows(df: DataFrame, names: Sequence[str], totals: Sequence[Column]) -> DataFrame:
    """One global aggregate, turned into one row per test."""
    one = df.agg(*[F.coalesce(t, F.lit(0)).cast("bigint").alias(f"_f{i}") for i, t in enumerate(totals)])
    pairs = [F.struct(F.lit(n).alias("test"), F.col(f"_f{i}").alias("failures")) for i, n in enumerate(names)]
    return one.select(F.explode(F.array(*pairs)).alias("_r")).select("_r.*")


def run_tests(
    df: DataFrame,
    tests: TableTests,
    now: dt.datetime | None = None,
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per test: table, test, failures. `parents` holds the tables that `relationships` name.

    All tests of single rows share one pass over the table, together with the first uniqueness test if there is
    one. Each further uniqueness test groups by other columns and needs its own pass, and so does each relationship.
    A table without tests gives no rows.
    """
    row_tests = tests.row_conditions(now or utc_now())
    grouped = [(f"unique:{c}", [c], False) for c in tests.unique]
    grouped += [(f"unique_combination:{','.join(c)}", list(c), True) for c in tests.unique_combination]
    if grouped:
        parts = [_counted(df, row_tests if i == 0 else {}, *test) for i, test in enumerate(grouped)]
    else:
        parts = []
        if row_tests:
            totals = [F.sum(F.when(bad, 1).otherwise(0)) for bad in row_tests.values()]
            parts.append(_as_rows(df, list(row_tests), totals))
    for column, parent, parent_column in tests.relationships:
        if parent not in (parents or {}):
            raise ConfigError(f"tests of '{tests.table}' need the table '{parent}'")
        orphans = relationships(df, column, parents[parent], parent_column)
        parts.append(_as_rows(orphans, [f"relationships:{column}"], [F.sum("n_records")]))
    if not parts:
        return df.sparkSession.createDataFrame([], "table string, test string, failures bigint")
    return reduce(DataFrame.unionByName, parts).select(F.lit(tests.table).alias("table"), "test", "failures")


def enforce(results: DataFrame) -> None:
    """Raise if any test failed. The driver receives one row per failing test, not the failing data."""
    failed = results.where("failures > 0").collect()
    if failed:
        raise DataTestError("; ".join(f"{r['table']} {r['test']}: {r['failures']}" for r in failed))
