import datetime as dt
import re

import pytest
from helpers import rows, ts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.config import ConfigError, DimensionConfig
from lakemart.operators import enrich, joins, scd
from lakemart.operators.enrich import enrich_as_of
from lakemart.operators.joins import DuplicateKeyError
from lakemart.operators.scd import NullKeyError, current, join_as_of, scd1_upsert, snapshot
from lakemart.plans import trips as t
from lakemart.sources import history as history_module
from lakemart.sources.history import HistoryTable

CONFIG = DimensionConfig("dim", 2, "id", ["name"])
KIND = "id int, name string, note string"
T1, T2, T3 = ts("2024-01-01"), ts("2024-02-01"), ts("2024-03-01")
QUICK = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def state(spark, *data):
    return spark.createDataFrame([(i, n, "-") for i, n in data], KIND)


@pytest.fixture
def states(spark):
    return [
        state(spark, (1, "x"), (2, "y")),
        state(spark, (1, "x'"), (2, "y"), (3, "z")),
        state(spark, (1, None), (3, "z")),
    ]


VERSIONS = ["id", "name", "valid_from", "valid_to", "updated_at"]
AFTER_T2 = [
    (1, "x", T1, T2, T1),
    (1, "x'", T2, None, T2),
    (2, "y", T1, None, T1),
    (3, "z", T2, None, T2),
]
AFTER_T3 = [
    (1, "x", T1, T2, T1),
    (1, "x'", T2, T3, T2),
    (1, None, T3, None, T3),
    (2, "y", T1, None, T1),
    (3, "z", T2, None, T2),
]


def ordered(df):
    return sorted([tuple(r) for r in df.select(*VERSIONS).collect()], key=lambda r: (r[0], r[2]))


def test_versions_over_three_snapshots(states):
    first = snapshot(None, states[0], CONFIG, T1)
    assert ordered(first) == [(1, "x", T1, None, T1), (2, "y", T1, None, T1)]
    second = snapshot(first, states[1], CONFIG, T2)
    assert ordered(second) == AFTER_T2
    third = snapshot(second, states[2], CONFIG, T3)
    assert ordered(third) == AFTER_T3
    assert ordered(snapshot(third, states[2], CONFIG, ts("2024-04-01"))) == AFTER_T3
    now = current(third)
    assert now.columns == ["id", "name", "note", "effective_from", "last_changed_at"]
    assert rows(now, "id", "name", "effective_from") == [(1, None, T3), (2, "y", T1), (3, "z", T2)]


def test_hard_deletes_are_closed_on_request(states):
    first = snapshot(None, states[1], CONFIG, T1)
    closed = snapshot(first, states[0].where("id = 1"), CONFIG, T2, hard_deletes="close")
    assert ordered(closed)[-2:] == [(2, "y", T1, T2, T1), (3, "z", T1, T2, T1)]
    with pytest.raises(ConfigError):
        snapshot(first, states[0], CONFIG, T2, hard_deletes="drop")


def test_untracked_columns_do_not_make_versions(spark, states):
    first = snapshot(None, states[0], CONFIG, T1)
    noted = states[0].selectExpr("id", "name", "'new' AS note")
    assert rows(snapshot(first, noted, CONFIG, T2), "id", "note") == [(1, "-"), (2, "-")]


def test_bad_keys_and_times_raise(spark, states):
    with pytest.raises(DuplicateKeyError):
        snapshot(None, state(spark, (1, "a"), (1, "b")), CONFIG, T1)
    with pytest.raises(NullKeyError):
        snapshot(None, state(spark, (None, "a")), CONFIG, T1)
    first = snapshot(None, states[0], CONFIG, T2)
    with pytest.raises(Exception, match="not after the stored version"):
        snapshot(first, states[1], CONFIG, T1).collect()
    with pytest.raises(ConfigError, match="lacks"):
        snapshot(first, states[1].drop("name"), CONFIG, T3)


def test_stored_history_equals_the_operator(spark, schema, tmp_path, states):
    history = HistoryTable(spark, f"{schema}.dim_history", f"{tmp_path}/dim_history")
    for incoming, now in zip(states, (T1, T2, T3)):
        history.snapshot(incoming, CONFIG, now)
    assert ordered(history.read()) == AFTER_T3
    assert history.run_number() == 3
    assert rows(history.current()) == rows(current(history.read()))
    assert not any("closed" in f for f in history.current().inputFiles())


def test_a_run_that_died_before_publishing_leaves_no_trace(spark, schema, tmp_path, states, monkeypatch):
    history = HistoryTable(spark, f"{schema}.dim_history", f"{tmp_path}/dim_history")
    history.snapshot(states[0], CONFIG, T1)
    with monkeypatch.context() as patched:
        patched.setattr(HistoryTable, "_publish", lambda self, run: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            history.snapshot(states[2], CONFIG, ts("2024-01-15"))
    assert len(ordered(history.read())) == 2
    history.snapshot(states[1], CONFIG, T2)
    assert ordered(history.read()) == AFTER_T2


def test_many_snapshots_leave_few_files_and_every_version(spark, schema, tmp_path, monkeypatch):
    monkeypatch.setattr(history_module, "MERGE_SETS", 3)
    history = HistoryTable(spark, f"{schema}.many", f"{tmp_path}/many")
    expected, runs = [], 30
    for i in range(runs):
        now = T1 + dt.timedelta(days=9 * i)
        assert history.snapshot(state(spark, (1, f"v{i}"), (2, "same")), CONFIG, now) == i + 1
        expected.append((1, f"v{i}", now, now + dt.timedelta(days=9) if i < runs - 1 else None))
        if i == runs - 3:
            before = rows(history.read())
    assert rows(history.read().where("id = 1"), "id", "name", "valid_from", "valid_to") == sorted(expected, key=lambda r: r[1])
    assert len(history._sets(runs)) <= 2 * 4
    folders = [d for d in (tmp_path / "many" / "slices").iterdir() if d.is_dir()]
    assert len(folders) <= 2 * 4 + 4
    # Times in the last two months: slices of versions that ended before are not opened.
    low, high = T1 + dt.timedelta(days=9 * 25), T1 + dt.timedelta(days=9 * 27)
    found = history.valid_between(low, high)
    assert rows(found.where("id = 1"), "name") == [("v25",), ("v26",), ("v27",)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert any("_slice" in filters for filters in re.findall(r"PartitionFilters: \[([^]]*)\]", plan))
    assert len(before) == runs - 1
    history.restore(runs - 1)
    assert len(rows(history.read())) == runs and history.run_number() == runs - 1


def test_closed_versions_from_before_there_were_sets(spark, schema, tmp_path, states):
    history = HistoryTable(spark, f"{schema}.old", f"{tmp_path}/old")
    first = snapshot(None, states[0], CONFIG, T1)
    versions = snapshot(first, states[1], CONFIG, T2)
    for run, found in ((1, first), (2, versions)):
        found.where("valid_to IS NULL").write.parquet(f"{tmp_path}/old/open/_run={run}")
        found.where("valid_to IS NOT NULL").write.parquet(f"{tmp_path}/old/closed/_run={run}")
    columns = ", ".join(versions.columns)
    spark.sql(
        f"CREATE VIEW {history.name} TBLPROPERTIES ('run' = '2') AS SELECT {columns} FROM parquet.`{tmp_path}/old/open` "
        f"WHERE _run = 2 UNION ALL SELECT {columns} FROM parquet.`{tmp_path}/old/closed` WHERE _run <= 2"
    )
    assert history.snapshot(states[2], CONFIG, T3) == 3
    assert ordered(history.read()) == AFTER_T3
    assert rows(history.valid_between(T1, T1), "name", "id") == rows(history.read().where(F.col("valid_from") == T1), "name", "id")


values = st.dictionaries(st.integers(1, 4), st.sampled_from(["a", "b", None]), max_size=4)


@QUICK
@given(loads=st.lists(values, min_size=1, max_size=4))
def test_intervals_are_contiguous_with_one_open_row(spark, loads):
    history = None
    for i, load in enumerate(loads):
        history = snapshot(history, state(spark, *load.items()), CONFIG, T1 + dt.timedelta(days=i), validate=False)
    versions = {}
    for row in ordered(history):
        versions.setdefault(row[0], []).append(row)
    for found in versions.values():
        assert sum(r[3] is None for r in found) == 1
        assert all(a[3] == b[2] for a, b in zip(found, found[1:]))
        assert all(a[1] != b[1] for a, b in zip(found, found[1:]))


FACTS = "fact int, k long, at timestamp_ntz"


@pytest.fixture(params=["broadcast", "in_order", "in_order_few_versions", "in_order_with_hot_keys", "many_hot_keys"])
def as_of_path(request, monkeypatch):
    if request.param == "in_order":
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    if request.param.startswith("in_order_") or request.param == "many_hot_keys":
        monkeypatch.setattr(scd, "BROADCAST_VERSIONS", 1)
    if request.param in ("in_order_with_hot_keys", "many_hot_keys"):
        monkeypatch.setattr(joins, "HOT_ROWS", 1)
    if request.param == "many_hot_keys":
        monkeypatch.setattr(scd, "BROADCAST_BYTES", 200)
    return request.param


def test_as_of_edges(spark, states, as_of_path):
    history = snapshot(snapshot(None, states[0], CONFIG, T1), states[1], CONFIG, T2)
    times = [T1, T2 - dt.timedelta(microseconds=1), T2, T1 - dt.timedelta(seconds=1), ts("2024-09-09 10:00")]
    facts = spark.createDataFrame([*[(i, 1, at) for i, at in enumerate(times)], (9, 77, T2), (10, None, T2)], FACTS)
    found = join_as_of(facts, history, "k", "id", "at", {"name": "name_then"})
    assert found.columns == ["fact", "k", "at", "name_then"]
    got = {r.fact: r.name_then for r in found.collect()}
    assert got == {0: "x", 1: "x", 2: "x'", 3: None, 4: "x'", 9: None, 10: None}


def test_as_of_many_versions_a_day_and_gaps(spark, as_of_path):
    hours = [T1 + dt.timedelta(hours=h) for h in range(0, 72, 5)]
    data = [(1, f"v{i}", a, b) for i, (a, b) in enumerate(zip(hours, hours[1:]))]
    data[3] = (1, "v3", hours[3], hours[3] + dt.timedelta(hours=1))
    history = spark.createDataFrame(data, "id int, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    moments = [T1 + dt.timedelta(minutes=20 * i) for i in range(-5, 240)]
    facts = spark.createDataFrame([(i, 1, at) for i, at in enumerate(moments)], FACTS)
    got = {r.fact: r.n for r in join_as_of(facts, history, "k", "id", "at", {"name": "n"}).collect()}
    expected = {i: next((n for _, n, a, b in data if a <= at < b), None) for i, at in enumerate(moments)}
    assert got == expected


def test_as_of_with_versions_of_very_different_density(spark, as_of_path):
    """Key 1 changes within seconds, key 2 within minutes, key 3 every few weeks; days without versions lie between."""
    steps = {1: dt.timedelta(milliseconds=700), 2: dt.timedelta(minutes=7), 3: dt.timedelta(days=17)}
    data = []
    for key, step in steps.items():
        starts = [T1 + dt.timedelta(days=key) + step * i for i in range(40)]
        data += [(key, f"{key}-{i}", a, b) for i, (a, b) in enumerate(zip(starts, [*starts[1:], None]))]
    history = spark.createDataFrame(data, "id long, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    moments = [T1 + dt.timedelta(days=key) + step * i / 3 for key, step in steps.items() for i in range(-4, 130)]
    facts_data = [(i, 1 + i % 3, at) for i, at in enumerate(m for m in moments for _ in range(3))]
    facts = spark.createDataFrame(facts_data, FACTS)
    found = join_as_of(facts, history, "k", "id", "at", {"name": "n"})
    assert found.columns == ["fact", "k", "at", "n"]
    expected = {
        i: next((n for key, n, a, b in data if key == k and a <= at and (b is None or at < b)), None)
        for i, k, at in facts_data
    }
    assert {r.fact: r.n for r in found.collect()} == expected


def test_enrich_as_of_uses_the_zone_of_the_time(spark, trip, zones):
    first = snapshot(None, zones, t.ZONES, T1)
    history = snapshot(first, zones.replace("Queens", "Kings", "borough"), t.ZONES, ts("2024-04-10 08:10"))
    trips = trip({"dropoff_location_id": 3})
    assert rows(enrich_as_of(trips, history), "pickup_borough", "dropoff_borough") == [("Queens", "Kings")]


def test_as_of_keys_of_one_moment_and_null_keys(spark, as_of_path):
    """Ties between versions and facts, one time for all facts, and a third of the facts without a key."""
    data = [(k, f"{k}-{d}", T1 + dt.timedelta(days=d), T1 + dt.timedelta(days=d + 1)) for k in (1, 2) for d in range(70)]
    history = spark.createDataFrame(data, "id long, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    same = T1 + dt.timedelta(days=40)
    facts_data = [(i, (1, 2, None)[i % 3], same if i % 2 else T1 + dt.timedelta(days=i % 90)) for i in range(300)]
    facts_data += [(1000, 1, None), (1001, 3, same)]
    found = join_as_of(spark.createDataFrame(facts_data, FACTS), history, "k", "id", "at", {"name": "n"})
    names = {(k, a): n for k, n, a, _ in data}
    assert {r.fact: r.n for r in found.collect()} == {i: names.get((k, at)) for i, k, at in facts_data}


def test_as_of_reads_the_facts_once(spark, schema, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    spark.createDataFrame([(1, 1, T2)], FACTS).write.saveAsTable(f"{schema}.facts")
    spark.createDataFrame([(1, "x", T1, None)], "id int, name string, valid_from timestamp_ntz, valid_to timestamp_ntz").write.saveAsTable(f"{schema}.history")
    facts, history = spark.table(f"{schema}.facts"), spark.table(f"{schema}.history")
    for hot in (1_000_000, 0.1):
        monkeypatch.setattr(joins, "HOT_ROWS", hot)
        found = join_as_of(facts, history, "k", "id", "at", {"name": "n"})
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert len([line for line in plan.split("\n") if "FileScan" in line and "fact#" in line]) == 1
        assert rows(found, "n") == [("x",)]


def test_history_is_checked_once_for_both_roles(spark, trip, zones, monkeypatch):
    calls = []
    monkeypatch.setattr(enrich, "require_disjoint", lambda *args: calls.append(args))
    monkeypatch.setattr(scd, "require_disjoint", lambda *args: calls.append(args))
    enrich_as_of(trip({}), snapshot(None, zones, t.ZONES, T1)).count()
    assert len(calls) == 1


def test_as_of_is_an_equi_join(spark, states):
    history = snapshot(None, states[0], CONFIG, T1)
    facts = spark.createDataFrame([(1, 1, T2)], FACTS)
    plan = join_as_of(facts, history, "k", "id", "at", {"name": "n"})._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_type_1_overwrites_old_ids_too(spark):
    target = spark.createDataFrame([(1, "a"), (9, "z")], "vendor_id int, vendor_name string")
    incoming = spark.createDataFrame([(1, "A"), (10, "new")], "vendor_id int, vendor_name string")
    assert rows(scd1_upsert(target, incoming, "vendor_id")) == [(1, "A"), (10, "new"), (9, "z")]


def test_configuration_decides_how_a_dimension_is_loaded(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b")], "vendor_id int, vendor_name string")
    after = spark.createDataFrame([(1, "A")], "vendor_id int, vendor_name string")
    latest = scd.load_dimension(scd.load_dimension(None, before, t.VENDORS, T1), after, t.VENDORS, T2)
    assert rows(latest) == [(1, "A"), (2, "b")]
    config = DimensionConfig("vendors", 2, "vendor_id", ["vendor_name"])
    kept = scd.load_dimension(scd.load_dimension(None, before, config, T1), after, config, T2)
    assert rows(kept, "vendor_id", "vendor_name") == [(1, "A"), (1, "a"), (2, "b")]


def test_second_dimension_by_configuration_only(spark):
    kind = "driver_id int, status string, license_type string"
    before = spark.createDataFrame([(1, "active", "A"), (2, "active", "B")], kind)
    after = spark.createDataFrame([(1, "inactive", "A"), (2, "active", "B")], kind)
    history = snapshot(snapshot(None, before, t.DRIVER_STATUS, T1), after, t.DRIVER_STATUS, T2)
    assert rows(current(history), "driver_id", "status") == [(1, "inactive"), (2, "active")]
    assert history.count() == 3
