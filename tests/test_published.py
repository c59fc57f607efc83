"""Published marts: whole versions for readers, whatever a run goes through."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakemart.sources import published
from lakemart.sources.published import VERSION, PublishedMart
from lakemart.sources.tables import PARTITION, MartTable

KIND = "d date, k string, n long"
KEYS = ["d", "k"]


def D(*parts):
    return dt.date(*parts)


def frame(spark, *data):
    return spark.createDataFrame(list(data), KIND)


FIRST = [(D(2024, 1, 5), "a", 1), (D(2024, 2, 5), "a", 2), (None, "x", 3)]


@pytest.fixture
def mart(spark, schema):
    made = PublishedMart(spark, f"{schema}.mart", partition_on="d")
    made.replace(frame(spark, *FIRST))
    return made


def seen(mart):
    return rows(mart.spark.table(mart.name))


def test_merges_and_refreshes(spark, mart):
    assert seen(mart) == rows(mart.read()) == rows(frame(spark, *FIRST))
    assert mart.high_water_mark("d") == D(2024, 2, 5)
    mart.upsert(frame(spark, (D(2024, 2, 5), "a", 20), (D(2024, 3, 1), "b", 4), (None, "x", 30)), KEYS)
    want = [(D(2024, 1, 5), "a", 1), (D(2024, 2, 5), "a", 20), (D(2024, 3, 1), "b", 4), (None, "x", 30)]
    assert seen(mart) == rows(frame(spark, *want)) == rows(mart.read())
    mart.replace_dates(frame(spark, (D(2024, 2, 6), "c", 5)), "d", [D(2024, 2, 5), D(2024, 2, 6), D(2024, 3, 1)])
    assert seen(mart) == rows(frame(spark, want[0], (D(2024, 2, 6), "c", 5), want[3]))
    mart.replace_from(frame(spark, (D(2024, 1, 9), "z", 7)), "d", D(2024, 1, 6))
    assert seen(mart) == rows(frame(spark, want[0], (D(2024, 1, 9), "z", 7), want[3]))
    mart.replace(mart.read().withColumn("n", F.col("n").cast("double")).withColumn("more", F.lit("m")))
    assert dict(spark.table(mart.name).dtypes) == {"d": "date", "k": "string", "n": "double", "more": "string"}
    assert mart.read().count() == 3
    mart.replace(mart.read().where("false"))
    assert seen(mart) == [] and mart.high_water_mark("d") is None
    mart.upsert(spark.createDataFrame([(D(2024, 5, 5), "n", 1.0, None)], "d date, k string, n double, more string"), KEYS)
    assert rows(mart.read(), "k") == [("n",)]


def test_unpartitioned(spark, schema):
    mart = PublishedMart(spark, f"{schema}.dim")
    mart.replace(frame(spark, *FIRST))
    mart.upsert(frame(spark, (D(2024, 9, 9), "a", 9)), ["k"])
    assert rows(mart.read()) == rows(frame(spark, (D(2024, 9, 9), "a", 9), FIRST[2]))


def test_a_reader_that_began_before_a_run_reads_its_own_version(spark, mart):
    before = spark.table(mart.name)
    mart.upsert(frame(spark, (D(2024, 1, 5), "a", 100), (D(2024, 2, 5), "b", 200)), KEYS)
    assert rows(before) == rows(frame(spark, *FIRST))
    before = spark.table(mart.name)
    mart.replace(frame(spark, (D(2030, 1, 1), "new", 1)))
    assert len(rows(before)) == 4 and rows(before, "n")[-1] != 1
    assert seen(mart) == [(D(2030, 1, 1), "new", 1)]


@pytest.mark.parametrize("step", ["_publish", "overwrite_partitions"])
@pytest.mark.parametrize("run", ["upsert", "replace_dates", "replace"])
def test_a_killed_run_leaves_the_mart_as_it_was(spark, mart, monkeypatch, step, run):
    def lost(*args):
        raise RuntimeError("driver lost")

    def again():
        change = frame(spark, (D(2024, 1, 5), "a", 50), (D(2024, 4, 4), "q", 6))
        if run == "upsert":
            mart.upsert(change, KEYS)
        elif run == "replace_dates":
            mart.replace_dates(change, "d", [D(2024, 1, 5), D(2024, 4, 4)])
        else:
            mart.replace(change)

    with monkeypatch.context() as patched:
        patched.setattr(PublishedMart if step == "_publish" else published, step, lost)
        with pytest.raises(RuntimeError):
            again()
    assert seen(mart) == rows(mart.read()) == rows(frame(spark, *FIRST))
    # What the dead run left behind is not shown by the next one, which touches other partitions.
    mart.upsert(frame(spark, (D(2024, 2, 5), "a", 21)), KEYS)
    assert seen(mart) == rows(frame(spark, FIRST[0], (D(2024, 2, 5), "a", 21), FIRST[2]))
    again()
    assert (D(2024, 1, 5), "a", 50) in seen(mart)


def test_old_versions_are_dropped(spark, mart):
    for i in range(6):
        mart.upsert(frame(spark, (D(2024, 1, 5), "a", i), (D(2024, 2, 5), "a", i)), KEYS)
    shown = mart._shown()
    listed = mart._listed(shown.rows)
    assert len([1 for p, _ in listed if p == "2024-01-01"]) == published.KEEP_RUNS
    assert len([1 for p, _ in listed if p is None]) == 1
    for _ in range(3):
        mart.replace(mart.read())
    tables = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {mart.name.split('.')[0]} LIKE 'mart__rows_*'").collect()]
    assert len(tables) == 2


def test_the_view_selects_directories(spark, mart):
    mart.upsert(frame(spark, (D(2024, 2, 5), "a", 21)), KEYS)
    files = spark.table(mart.name).inputFiles()
    assert len(files) == 3 and len([f for f in files if f"{VERSION}=2" in f]) == 1
    only = mart.stored().where(F.col(PARTITION) == F.lit(D(2024, 2, 1))).inputFiles()
    assert len(only) == 1


def test_a_plain_mart_is_taken_over(spark, schema):
    plain = MartTable(spark, f"{schema}.old", partition_on="d")
    plain.replace(frame(spark, *FIRST))
    mart = PublishedMart(spark, f"{schema}.old", partition_on="d")
    assert rows(mart.read()) == rows(frame(spark, *FIRST)) and mart.high_water_mark("d") == D(2024, 2, 5)
    mart.upsert(frame(spark, (D(2024, 2, 5), "a", 22)), KEYS)
    assert seen(mart) == rows(frame(spark, FIRST[0], (D(2024, 2, 5), "a", 22), FIRST[2]))
