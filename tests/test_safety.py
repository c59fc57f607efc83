"""Mistakes that must raise instead of losing or changing stored data, and states that must be survived."""

import datetime as dt

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.config import ConfigError, DimensionConfig, FreshnessConfig, IncrementalConfig, Project, StagingConfig
from lakemart.operators import joins, scd
from lakemart.operators.incremental import merge_upsert
from lakemart.operators.joins import DuplicateKeyError, lookup_join, spread_hot_keys
from lakemart.operators.quality import TableTests, freshness, run_tests
from lakemart.operators.reconcile import is_equal, same_content, two_way_diff
from lakemart.operators.scd import OverlapError, join_as_of, snapshot
from lakemart.plans.pipeline import run_incremental
from lakemart.sources.history import KEEP_RUNS, HistoryTable
from lakemart.sources.ingest import IngestConfig, compact, ingest_files, load_files, recover_compaction
from lakemart.sources.landed import read_landed, read_rescued_csv
from lakemart.sources.tables import PARTITION, MartTable, overwrite_partitions

DAY = dt.date(2024, 4, 1)


def mart_rows(spark, *found):
    return spark.createDataFrame([(dt.date.fromisoformat(d), b, n) for d, b, n in found], "d date, b string, n long")


def test_a_merge_without_keys_raises(spark, schema):
    target = mart_rows(spark, ("2024-04-01", "A", 1))
    with pytest.raises(ConfigError, match="key"):
        merge_upsert(target, target, [])
    mart = MartTable(spark, f"{schema}.m")
    mart.replace(target)
    with pytest.raises(ConfigError, match="key"):
        mart.upsert(target, [])
    with pytest.raises(ConfigError, match="no merge keys"):
        run_incremental(mart, target, lambda r: r, IncrementalConfig("m", "d"), audit=False)
    assert mart.read().count() == 1


def test_merge_keys_come_from_the_mapping(spark, schema):
    entry = {"watermark_column": "d", "late_arrival_days": 3}
    for keys in ({"unique_key": ["d", "b"]}, {"keys": ["d", "b"]}):
        project = Project.from_mapping({"incremental_configs": {"m": {**entry, **keys}}})
        assert list(project.incremental_for("m").keys) == ["d", "b"]
    assert Project.from_mapping({"incremental_configs": {"m": {**entry, "unique_key": "d"}}}).incremental["m"].keys == ("d",)
    mart = MartTable(spark, f"{schema}.m")
    days = [(f"2024-04-{i:02d}", "A", 1) for i in range(1, 31)]
    mart.replace(mart_rows(spark, *days))
    upstream = mart_rows(spark, *days, ("2024-05-01", "A", 2))
    run_incremental(mart, upstream, lambda r: r, project.incremental_for("m"), audit=False)
    assert mart.read().count() == 31


def test_a_build_that_repeats_a_key_raises(spark, schema):
    mart = MartTable(spark, f"{schema}.m", "d")
    config = IncrementalConfig("m", "d", 3, ["d", "b"])
    mart.replace(mart_rows(spark, ("2024-04-01", "A", 1)))
    with pytest.raises(DuplicateKeyError):
        run_incremental(mart, mart_rows(spark, ("2024-04-01", "A", 2)), lambda r: r.union(r), config, audit=False)
    assert rows(mart.read()) == [(DAY, "A", 1)]


def test_empty_sections_of_a_file_are_empty():
    config = Project.from_mapping({"staging_configs": {"t": {"source_name": "raw", "rename": None, "passthrough": ["a"]}}, "dimension_configs": None})
    assert config.staging_for("t") == StagingConfig("t", "raw", {}, ["a"], {}, ())


def test_the_mark_walks_back_over_empty_partitions(spark, schema):
    mart = MartTable(spark, f"{schema}.m", "d")
    mart.replace(mart_rows(spark, ("2024-03-05", "A", 1), ("2024-04-01", "A", 1), ("2024-05-01", "A", 1)))
    for part in ("2024-05-01", "2024-04-01"):
        spark.sql(f"ALTER TABLE {mart.name} DROP PARTITION ({PARTITION} = DATE'{part}')")
        spark.sql(f"ALTER TABLE {mart.name} ADD PARTITION ({PARTITION} = DATE'{part}')")
    assert mart.high_water_mark("d") == dt.date(2024, 3, 5)
    run = run_incremental(mart, mart_rows(spark, ("2024-03-05", "A", 2), ("2024-05-01", "A", 3)), lambda r: r, IncrementalConfig("m", "d", 3, ["d", "b"]), audit=False)
    assert not run.full and rows(mart.read()) == [(dt.date(2024, 3, 5), "A", 2), (dt.date(2024, 5, 1), "A", 3)]


ZONES = DimensionConfig("zones", 2, "k", ["a"])


def state(spark, *found, columns="k long, a string"):
    return spark.createDataFrame(list(found), columns)


def test_history_keeps_columns_and_runs(spark, schema, tmp_path):
    history = HistoryTable(spark, f"{schema}.h", str(tmp_path / "h"))
    assert history.snapshot(state(spark, (1, "x", 7), (2, "y", 8), columns="k long, a string, gone int"), ZONES, ts("2024-01-01")) == 1
    assert history.snapshot(state(spark, (1, "x"), (2, "z")), ZONES, ts("2024-01-02")) == 2
    found = rows(history.read(), "k", "a", "gone", "valid_to")
    assert found == [(1, "x", 7, None), (2, "y", 8, ts("2024-01-02")), (2, "z", None, None)]
    # Nothing changed: nothing is published.
    assert history.snapshot(state(spark, (1, "x"), (2, "z")), ZONES, ts("2024-01-03")) == 2
    wide = state(spark, (1, "x", 1.5), (2, "q", 2.5), columns="K long, A string, extra double")
    assert history.snapshot(wide.toDF("k", "a", "extra"), ZONES, ts("2024-01-04")) == 3
    assert rows(history.read(), "k", "a", "gone", "extra") == [
        (1, "x", 7, None), (2, "q", None, 2.5), (2, "y", 8, None), (2, "z", None, None),
    ]
    assert history.snapshot(state(spark, (1, "w", 0.0), columns="k long, a string, extra double"), ZONES, ts("2024-01-05")) == 4
    assert history.stored_runs() == [4 - KEEP_RUNS + 1 + i for i in range(KEEP_RUNS)]
    before = rows(history.read())
    spark.sql(f"DROP VIEW {history.name}")
    with pytest.raises(ConfigError, match="restore"):
        history.snapshot(state(spark, (1, "v")), ZONES, ts("2024-01-06"))
    assert history.restore() == 4 and rows(history.read()) == before


def test_pure_snapshot_keeps_columns(spark):
    first = snapshot(None, state(spark, (1, "x", 7), columns="k long, a string, gone int"), ZONES, ts("2024-01-01"))
    second = snapshot(first, state(spark, (1, "y", True), columns="k long, A string, more boolean").toDF("k", "a", "more"), ZONES, ts("2024-01-02"))
    assert rows(second, "k", "a", "gone", "more") == [(1, "x", 7, None), (1, "y", None, True)]


VERSIONS = "key int, valid_from timestamp_ntz, valid_to timestamp_ntz, a string"
FACTS = "key int, at timestamp_ntz"


@pytest.fixture(params=["broadcast", "in_order"])
def path(request, monkeypatch):
    if request.param == "in_order":
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    return request.param


@pytest.mark.parametrize(
    "versions",
    [
        [(1, ts("2024-01-01"), None, "x"), (1, ts("2024-01-02"), None, "y")],
        [(1, ts("2024-01-01"), ts("2024-01-03"), "x"), (1, ts("2024-01-02"), None, "y")],
        [(1, ts("2024-01-01"), ts("2024-01-01"), "x")],
    ],
)
def test_overlapping_versions_raise_on_every_path(spark, path, versions):
    facts = spark.createDataFrame([(1, ts("2024-01-02"))], FACTS)
    with pytest.raises(OverlapError):
        join_as_of(facts, spark.createDataFrame(versions, VERSIONS), "key", "key", "at", {"a": "a"})


def test_gaps_give_the_same_rows_on_every_path(spark, path):
    history = [(1, ts("2024-01-01"), ts("2024-01-02"), "x"), (1, ts("2024-01-03"), None, "y"), (None, ts("2024-01-01"), None, "n")]
    facts = spark.createDataFrame([(1, ts(f"2024-01-0{d}")) for d in range(1, 5)] + [(2, ts("2024-01-01")), (None, None)], FACTS)
    found = join_as_of(facts, spark.createDataFrame(history, VERSIONS), "key", "key", "at", {"a": "a"})
    assert [r[2] for r in rows(found)] == [None, "x", None, "y", "y", None]


def test_overlaps_are_found_across_ranges(spark):
    start = ts("2024-01-01")
    versions = [(1, start + dt.timedelta(hours=i), start + dt.timedelta(hours=i + 1), "x") for i in range(400)]
    scd.require_disjoint(spark.createDataFrame(versions, VERSIONS).repartition(7), "key")
    for i in (1, 57, 199, 398):
        bad = [*versions[:i], (1, versions[i][1], versions[i][2] + dt.timedelta(minutes=1), "x"), *versions[i + 1 :]]
        with pytest.raises(OverlapError):
            scd.require_disjoint(spark.createDataFrame(bad, VERSIONS).repartition(7), "key")


@pytest.mark.parametrize("literals", [1_000, 0])
def test_many_hot_keys_are_split_as_a_table(spark, monkeypatch, literals):
    monkeypatch.setattr(joins, "HOT_ROWS", 10)
    monkeypatch.setattr(joins, "LITERAL_KEYS", literals)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    facts = spark.range(300).select((F.col("id") % 4).alias("k")).repartition(6)
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "key long, v string")
    left, _ = spread_hot_keys(facts, dim, ["k"], ["key"])
    assert left.select("_salt").distinct().count() > 1
    joined = lookup_join(facts, dim, "k", "key", {"v": "v"})
    assert sorted((r["v"] or "", r["count"]) for r in joined.groupBy("v").count().collect()) == [("", 75), ("a", 75), ("b", 75), ("c", 75)]


def test_a_stream_is_spread_over_salts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    spark.range(20).select((F.col("id") % 3).alias("k")).write.parquet(str(tmp_path / "in"))
    dim = spark.createDataFrame([(0, "a"), (1, "b")], "key long, v string")
    stream = spark.readStream.schema("k long").parquet(str(tmp_path / "in"))
    left, right = spread_hot_keys(stream, dim, ["k"], ["key"])
    assert right.count() == 2 * joins.STREAM_SALTS and left.isStreaming
    joined = lookup_join(stream, dim, "k", "key", {"v": "v"})
    query = joined.writeStream.format("memory").queryName("spread").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r["v"] or "", r["count"]) for r in spark.table("spread").groupBy("v").count().collect()) == [("", 6), ("a", 7), ("b", 7)]


def test_lookup_columns_must_be_new(spark):
    facts = spark.createDataFrame([(1, "x")], "k int, V string")
    with pytest.raises(ConfigError, match="exist on the fact side"):
        lookup_join(facts, spark.createDataFrame([(1, "y")], "key int, v string"), "k", "key", {"v": "v"})


def test_types_are_made_alike_before_hashing(spark):
    a, b = spark.sql("SELECT 1 AS x, DATE'2024-01-01' AS d"), spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS d, 1L AS x")
    assert same_content(a, b).first()["equal"] and is_equal(a, b) and two_way_diff(a, b).count() == 0
    with pytest.raises(ConfigError, match="on the other"):
        same_content(a, spark.sql("SELECT 'one' AS x, DATE'2024-01-01' AS d"))


def test_a_value_that_would_change_raises(spark, tmp_path):
    declared = T.StructType([T.StructField("n", T.LongType())])
    for name, kind, value in (("whole", "double", 2.0), ("part", "double", 1.7), ("text", "string", "x")):
        spark.sql(f"SELECT CAST('{value}' AS {kind}) AS n").write.parquet(str(tmp_path / name))
    assert rows(read_landed(spark, [str(tmp_path / "whole")], declared), "n") == [(2,)]
    for name in ("part", "text"):
        with pytest.raises(Exception, match="cannot hold the stored value"):
            read_landed(spark, [str(tmp_path / name)], declared).select("n").collect()


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Name,key,more\nx,1,9\ny,b,9\n")
    declared = T.StructType([T.StructField("key", T.LongType()), T.StructField("name", T.StringType()), T.StructField("gone", T.StringType())])
    found = rows(read_rescued_csv(spark, str(tmp_path / "a.csv"), declared))
    assert found == [(None, "y", None, "y,b,9"), (1, "x", None, '{"more":"9"}')]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_age_does_not_depend_on_the_zone_of_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        now = ts("2024-03-11 12:00:00")
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 12, tzinfo=dt.timezone.utc), ts("2024-03-10 12:00:00"))], "i timestamp, n timestamp_ntz")
        for column in ("i", "n"):
            row = freshness(df, FreshnessConfig(column, 25, 49), now).first()
            assert (row["age_hours"], row["status"], row["max_loaded_at"]) == (24.0, "pass", ts("2024-03-10 12:00:00"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_tests_of_relationships_and_of_nothing(spark):
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k long")
    tests = TableTests("child", relationships=[("k", "parent", "id")])
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    assert rows(run_tests(child, tests, parents={"parent": parent})) == [("child", "relationships:k", 2)]
    with pytest.raises(ConfigError, match="parent"):
        run_tests(child, tests)
    assert run_tests(child, TableTests("child")).collect() == []


def landed(spark, tmp_path, schema, **options):
    declared = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampNTZType())])
    return IngestConfig(str(tmp_path / "in"), f"{schema}.raw", declared, str(tmp_path / "cp"), "at", **options)


def test_many_loads_compact_to_one_partition_a_date(spark, schema, tmp_path, monkeypatch):
    config = landed(spark, tmp_path, schema)
    for i in range(50):  # loads as the ingest writes them, each with the same three dates
        days = [(i * 10 + d, ts(f"2024-04-0{d + 1}")) for d in range(3)]
        path = str(tmp_path / f"load{i}")
        spark.createDataFrame(days, "id long, at timestamp_ntz").coalesce(1).write.parquet(path)
        load_files(spark, config, [path], f"q-{i:010d}")
    before = rows(spark.table(config.table), "id", "at")
    assert spark.sql(f"SHOW PARTITIONS {config.table}").count() == 150
    # A crash after the write: what was replaced is dropped by the next run.
    with monkeypatch.context() as crash:
        crash.setattr("lakemart.sources.ingest._drop_partitions", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact(spark, config, dt.date(2024, 4, 3))
    assert compact(spark, config, dt.date(2024, 4, 3)) == 0
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {config.table}").collect()]
    # The last date is too new, and the newest load stays apart.
    assert len(parts) == 50 + 2 * 2 and rows(spark.table(config.table), "id", "at") == before
    # A crash during the write: what it wrote is undone.
    real = overwrite_partitions
    with monkeypatch.context() as crash:
        crash.setattr("lakemart.sources.ingest.overwrite_partitions", lambda *a: real(*a) or 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact(spark, config, dt.date(2024, 5, 1))
    recover_compaction(spark, config)
    assert rows(spark.table(config.table), "id", "at") == before
    assert compact(spark, config, dt.date(2024, 5, 1)) > 0
    assert len(spark.sql(f"SHOW PARTITIONS {config.table}").collect()) == 6
    assert rows(spark.table(config.table), "id", "at") == before


def test_loaded_files_can_be_archived(spark, schema, tmp_path):
    with pytest.raises(ConfigError):
        landed(spark, tmp_path, schema, clean_source="archive")
    config = landed(spark, tmp_path, schema, clean_source="archive", archive=str(tmp_path / "done"))
    for i in range(3):
        frame = spark.createDataFrame([(i, ts("2024-04-01"))], "id long, at timestamp_ntz")
        frame.coalesce(1).write.mode("append").parquet(config.landing)
        ingest_files(spark, config)
    assert [r[0] for r in rows(spark.table(config.table), "id")] == [0, 1, 2]
