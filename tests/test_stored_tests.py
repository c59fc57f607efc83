"""Stored test state against the full suite."""

import datetime as dt

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from lakemart.config import ConfigError
from lakemart.operators.quality import TableTests, run_tests
from lakemart.sources.test_state import StoredTests

KIND = "d date, k string, n long, at timestamp_ntz"
NOW = ts("2024-06-01 00:00")
TESTS = TableTests(
    "t", not_null=["k"], unique=["n"], accepted_values={"k": ["a", "b"]}, unique_combination=[["d", "k"], ["k", "n"]],
    no_future=["at"], relationships=[("n", "parent", "id")],
)


def D(day):
    return dt.date(2024, 1, day)


@pytest.fixture
def table(spark, schema):
    """Write the partitions given, and read the whole table."""

    def write(*data):
        df = spark.createDataFrame(list(data), KIND).withColumn("day", F.col("d"))
        df.repartition(1).write.mode("overwrite").partitionBy("day").saveAsTable(f"{schema}.t")
        return spark.table(f"{schema}.t")

    return write


FIRST = [
    (D(1), "a", 1, NOW), (D(1), "a", 1, ts("2024-07-01 00:00")), (D(2), None, 2, None), (D(2), "c", 3, NOW),
    (D(3), "b", None, NOW), (None, "a", 9, NOW), (None, "a", None, NOW), (D(4), "b", 70, NOW),
]


def stamps(data, **versions):
    parts = {str(r[0]) if r[0] else None for r in data}
    return {p: str(versions.get(f"d{p[-1]}" if p else "none", 0)) for p in parts}


def test_state_gives_what_the_full_suite_gives(spark, schema, table):
    state, parents = StoredTests(spark, f"{schema}.state", TESTS), {"parent": spark.createDataFrame([(1,), (2,), (3,)], "id int")}
    df = table(*FIRST)
    found = state.run(df, "day", stamps(FIRST), NOW, parents)
    assert rows(found) == rows(run_tests(df, TESTS, NOW, parents)) and len(rows(found, "test")) == 7
    # Copies across partitions, one partition gone, one changed, and an untouched one with an old failure.
    second = [*FIRST[:4], (D(3), "a", 1, ts("2024-09-01 00:00")), (D(3), "a", 2, NOW), FIRST[7], (D(5), "b", 3, NOW)]
    df = table(*second)
    found = state.run(df, "day", stamps(second, d3=1), NOW, parents)
    assert rows(found) == rows(run_tests(df, TESTS, NOW, parents))
    # Time goes on, and a parent comes: partitions that did not change give other results.
    later, parents = ts("2024-08-01 00:00"), {"parent": spark.createDataFrame([(1,), (3,), (70,)], "id int")}
    found = state.run(df, "day", stamps(second, d3=1), later, parents)
    assert rows(found) == rows(run_tests(df, TESTS, later, parents))
    assert rows(state.run(df.limit(0), "day", {}, later, parents), "failures") == [(0,)] * 7
    with pytest.raises(ConfigError):
        state.run(df, "day", {}, later)


def test_untouched_partitions_are_not_opened(spark, schema, table, monkeypatch):
    tests = TableTests("t", not_null=["k"], unique=["n"])
    state, df, opened = StoredTests(spark, f"{schema}.state", tests), table(*FIRST), []
    make = StoredTests._state
    monkeypatch.setattr(
        StoredTests, "_state",
        lambda self, found, now: opened.append({f.split("day=")[1].split("/")[0] for f in found.inputFiles()}) or make(self, found, now),
    )
    state.run(df, "day", stamps(FIRST), NOW)
    state.run(df, "day", stamps(FIRST), NOW)
    state.run(df, "day", stamps(FIRST, d2=5), NOW)
    state.run(df, "day", stamps(FIRST, d2=5, none=5), NOW)
    assert [len(o) for o in opened] == [5, 1, 1]
    assert opened[1] == {"2024-01-02"} and opened[2] == {"__HIVE_DEFAULT_PARTITION__"}
    # Other tests: everything is looked at again.
    other = StoredTests(spark, f"{schema}.state", TableTests("t", not_null=["k", "n"]))
    other.run(df, "day", stamps(FIRST), NOW)
    assert len(opened[3]) == 5
