import os
import shutil
import time
from dataclasses import replace

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.config import ConfigError, FreshnessConfig
from lakemart.functions.audit import without_audit
from lakemart.operators import joins
from lakemart.operators.marts import DAILY_KEYS, daily, daily_measures
from lakemart.operators.quality import TableTests
from lakemart.sources import ingest, landed, ledger
from lakemart.sources.ingest import LOAD, IngestConfig, ingest_files, start_ingest
from lakemart.sources.landed import RESCUED, load_reference_csv, read_landed, read_rescued_csv
from lakemart.sources.ledger import LoadLedger
from lakemart.sources.tables import MartTable
from lakemart.streaming.live import (
    LateRoute,
    check_on_load,
    event_time_daily,
    in_order,
    refresh_on_load,
    sketch_on_load,
    start_event_time_mart,
    stored_hot_keys,
)

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampNTZType())])
KIND = "id long, at timestamp_ntz"


@pytest.fixture
def land(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def write(name, data, kind=KIND, age_days=0):
        out = tmp_path / f"out-{name}"
        spark.createDataFrame(data, kind).coalesce(1).write.parquet(str(out))
        part = next(out.glob("*.parquet"))
        target = landing / f"{name}.parquet"
        shutil.copy(part, target)
        if age_days:
            old = time.time() - age_days * 86_400
            os.utime(target, (old, old))
        return target

    write.landing = landing
    return write


@pytest.fixture
def config(schema, tmp_path, land):
    return IngestConfig(str(land.landing), f"{schema}.raw", SCHEMA, str(tmp_path / "checkpoint"), "at")


DAY = ts("2024-04-01 10:00")


def test_each_file_is_loaded_once(spark, land, config):
    first = land("a", [(1, DAY), (2, None)])
    assert ingest_files(spark, config) == 1
    assert ingest_files(spark, config) == 0
    assert spark.table(config.table).count() == 2
    land("b", [(3, DAY)])
    assert ingest_files(spark, config) == 1
    assert rows(spark.table(config.table), "id") == [(1,), (2,), (3,)]
    shutil.copy(first, land.landing / "renamed [1] {x}.parquet")
    assert ingest_files(spark, config) == 1
    assert rows(spark.table(config.table), "id") == [(1,), (1,), (2,), (2,), (3,)]
    assert spark.table(config.table).where("_source_file IS NULL").count() == 0


def test_old_files_are_not_skipped(spark, land, config):
    land("new", [(1, DAY)])
    land("old", [(2, DAY)], age_days=30)
    assert ingest_files(spark, config) == 2


def test_empty_folder_creates_an_empty_table(spark, config):
    assert ingest_files(spark, config) == 0
    table = spark.table(config.table)
    assert table.count() == 0 and dict(table.dtypes)["at"] == "timestamp_ntz"


def test_a_failed_batch_is_replayed_without_duplicates(spark, land, config):
    land("a", [(1, DAY)])

    def fail(session, load):
        raise RuntimeError("tests failed")

    with pytest.raises(Exception, match="tests failed"):
        ingest_files(spark, config, fail)
    assert spark.table(config.table).count() == 1
    seen = []
    assert ingest_files(spark, config, lambda session, load: seen.append(load)) == 1
    assert spark.table(config.table).count() == 1 and len(seen) == 1


def under(config, tmp_path, name):
    """The same ingest under another checkpoint."""
    return replace(config, checkpoint=str(tmp_path / name))


def test_a_new_checkpoint_loads_only_what_the_table_lacks(spark, land, config, tmp_path):
    land("a", [(1, DAY)])
    assert ingest_files(spark, config) == 1
    land("b", [(2, DAY)])
    assert ingest_files(spark, under(config, tmp_path, "other")) == 1
    assert ingest_files(spark, config) == 0
    assert rows(spark.table(config.table), "id") == [(1,), (2,)]
    assert spark.table(config.table).select(LOAD).distinct().count() == 2


def broken(at):
    def fail(self, *args):
        raise RuntimeError(f"driver lost at {at}")

    return fail


@pytest.mark.parametrize("checkpoint", ["checkpoint", "other"])
@pytest.mark.parametrize("step", ["claim", "load", "finish"])
@pytest.mark.parametrize("dated", [True, False])
def test_a_crash_between_load_and_ledger_neither_loses_nor_doubles(
    spark, land, config, tmp_path, monkeypatch, step, checkpoint, dated
):
    config = config if dated else replace(config, event_time=None)
    land("a", [(1, DAY), (2, None), (3, ts("2024-04-02 01:00"))])
    ingest_files(spark, config)
    land("b", [(4, DAY), (5, None)])
    with monkeypatch.context() as patched:
        if step == "load":
            patched.setattr(ingest, "load_files", broken(step))
        else:
            patched.setattr(LoadLedger, step, broken(step))
        with pytest.raises(Exception, match="driver lost"):
            ingest_files(spark, config)
    # A file that comes meanwhile, so the second attempt is not the same set of files.
    land("c", [(6, DAY)])
    assert ingest_files(spark, under(config, tmp_path, checkpoint)) == 2
    assert rows(spark.table(config.table), "id") == [(i,) for i in range(1, 7)]
    assert ingest_files(spark, under(config, tmp_path, "third")) == 0
    assert ingest_files(spark, config) == 0


def test_a_finished_load_with_a_leftover_claim_is_kept(spark, land, config, tmp_path, monkeypatch):
    land("a", [(1, DAY)])
    with monkeypatch.context() as patched:
        patched.setattr(LoadLedger, "_drop", lambda self, state, loads: None)
        ingest_files(spark, config)
    assert LoadLedger(spark, config.table)._loads("claimed")
    assert ingest_files(spark, under(config, tmp_path, "other")) == 0
    assert LoadLedger(spark, config.table)._loads("claimed") == []
    assert spark.table(config.table).count() == 1


def test_ledger_is_packed_by_path_hash(spark, land, config, monkeypatch, tmp_path):
    monkeypatch.setattr(ledger, "PACK_AFTER", 2)
    for i, name in enumerate("abcde"):
        land(name, [(i, DAY)])
        assert ingest_files(spark, config) == 1
    known = LoadLedger(spark, config.table)
    assert len(known._loads("loaded")) == 1 and len(known._loads("packed")) >= 2
    with monkeypatch.context() as patched:
        # A pack that is cut off before it drops the marks lists files twice, which changes nothing.
        patched.setattr(LoadLedger, "_drop", broken("pack"))
        with pytest.raises(RuntimeError):
            known.pack()
    assert ingest_files(spark, under(config, tmp_path, "other")) == 0
    one = known.unloaded(spark.createDataFrame([(str(land.landing / "zzz.parquet"),)], "path string"))
    assert one.count() == 1
    opened = [f for f in one.inputFiles() if "_state=packed" in f]
    assert len(opened) <= 1


def test_a_table_from_before_the_ledger_knows_its_files(spark, land, config, tmp_path):
    land("a b+c%20[1]", [(1, DAY)])
    ingest_files(spark, config)
    spark.sql(f"DROP TABLE {config.table}__files")
    land("new", [(2, DAY)])
    assert ingest_files(spark, under(config, tmp_path, "other")) == 1
    assert rows(spark.table(config.table), "id") == [(1,), (2,)]


def test_a_file_older_than_the_stream_remembers_is_loaded_by_the_next_start(spark, land, config):
    config = replace(config, remembered_days=2, max_files_per_batch=2)
    land("new", [(1, DAY)])
    assert ingest_files(spark, config) == 1
    for i in range(5):
        land(f"late{i}", [(10 + i, DAY)], age_days=40)
    assert ingest_files(spark, config) == 5
    assert ingest_files(spark, config) == 0
    assert spark.table(config.table).count() == 6
    with pytest.raises(ConfigError):
        replace(config, remembered_days=0)


def test_alternating_schemas_are_read_once_each(spark, land, monkeypatch):
    paths = [str(land(f"f{i}", [(i if i % 2 else float(i), DAY)], f"id {'int' if i % 2 else 'double'}, at timestamp_ntz")) for i in range(24)]
    groups = landed.schema_groups(spark, paths)
    assert sorted(len(files) for _, files in groups) == [12, 12]
    found = read_landed(spark, paths, SCHEMA)
    assert rows(found, "id") == sorted([(i,) for i in range(24)], key=str)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def test_structs_are_widened_field_by_field(spark, land):
    a = land("a", [(1, (1, "x"), [1])], "id long, s struct<n int, t string>, l array<int>")
    b = land("b", [(2, (2**40, True), [2**40])], "id long, s struct<N bigint, flag boolean>, l array<bigint>")
    declared = T.StructType([T.StructField("id", T.LongType())])
    found = read_landed(spark, [str(a), str(b)], declared)
    assert rows(found, "id", "s.n", "s.t", "s.flag", "l") == [(1, 1, "x", None, [1]), (2, 2**40, None, True, [2**40])]


def test_new_columns_without_a_common_type_are_refused(spark, land):
    paths = [str(land("a", [(1, "x")], "id long, v string")), str(land("b", [(2, 1)], "id long, v int"))]
    with pytest.raises(ConfigError, match="'v' comes as"):
        read_landed(spark, paths, T.StructType([T.StructField("id", T.LongType())]))


@pytest.mark.parametrize("value, kept", [(2**53, True), (2**53 + 1, False), (-(2**53) - 1, False), (2**63 - 1, False), (None, True)])
def test_a_bigint_is_read_as_double_only_if_no_digit_goes(spark, land, value, kept):
    path = str(land("a", [(value,)], "v long"))
    found = read_landed(spark, [path], T.StructType([T.StructField("v", T.DoubleType())]))
    if kept:
        assert rows(found, "v") == [(None if value is None else float(value),)]
    else:
        with pytest.raises(Exception, match="cannot hold the stored value"):
            found.collect()


def test_widened_and_new_columns(spark, land, config):
    land("a", [(1, DAY)], "id int, at timestamp_ntz")
    ingest_files(spark, config)
    land("b", [(2**40, DAY, "x")], "id long, at timestamp_ntz, extra string")
    ingest_files(spark, config)
    table = spark.table(config.table)
    assert rows(table, "id", "extra") == [(1, None), (2**40, "x")]
    assert dict(table.dtypes)["id"] == "bigint"
    land("c", [(3, DAY)])
    ingest_files(spark, config)
    assert rows(spark.table(config.table).where("id = 3"), "extra") == [(None,)]


def test_files_with_clashing_types_in_one_batch(spark, land, config):
    land("a", [(1, DAY)], "id int, at timestamp_ntz")
    land("b", [(2.0, DAY)], "id double, at timestamp_ntz")
    land("c", [("3", DAY)], "id string, at timestamp_ntz")
    land("d", [(4, DAY)], "ID long, AT timestamp_ntz")
    assert ingest_files(spark, config) == 4
    assert rows(spark.table(config.table), "id") == [(1,), (2,), (3,), (4,)]


def test_declared_double_reads_stored_bigint(spark, land):
    declared = T.StructType([T.StructField("id", T.DoubleType()), T.StructField("gone", T.StringType())])
    path = str(land("a", [(7, DAY)]))
    assert rows(read_landed(spark, [path], declared), "id", "gone", "at") == [(7.0, None, DAY)]


def test_raw_table_is_split_by_event_date(spark, land, config):
    land("a", [(1, DAY), (2, ts("2024-04-02 01:00"))])
    ingest_files(spark, config)
    one = spark.table(config.table).where("_event_date = DATE'2024-04-02'")
    assert len(one.inputFiles()) == 1 and rows(one, "id") == [(2,)]


def test_polling_picks_up_a_landed_file(spark, land, config):
    land("a", [(1, DAY)])
    run = start_ingest(spark, config, every="1 second")
    try:
        run.query.processAllAvailable()
        land("b", [(2, DAY)])
        run.query.processAllAvailable()
    finally:
        run.query.stop()
    assert run.files == 2 and spark.table(config.table).count() == 2


def test_csv_load_keeps_malformed_lines(spark, schema, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        "LocationID,Borough,Zone,service_zone\n1,EWR,Newark,EWR\n264,N/A,Unknown,N/A\n5,Queens,A,B,surplus\nbad,Q,Z,S\n"
    )
    from lakemart.plans.trips import ZONE_SCHEMA, stg_zones

    table = f"{schema}.zones"
    assert load_reference_csv(spark, str(path), table, ZONE_SCHEMA)
    assert not load_reference_csv(spark, str(path), table, ZONE_SCHEMA)
    loaded = spark.table(table)
    assert rows(loaded.where(f"{RESCUED} IS NULL"), "LocationID", "Borough") == [(1, "EWR"), (264, "N/A")]
    assert rows(loaded.where(f"{RESCUED} IS NOT NULL"), RESCUED) == [("5,Queens,A,B,surplus",), ("bad,Q,Z,S",)]
    assert RESCUED not in stg_zones(loaded).columns
    good = tmp_path / "good.csv"
    good.write_text("a,b\n1,x\n2,N/A\n")
    inferred = read_rescued_csv(spark, str(good))
    assert inferred.dtypes == [("a", "int"), ("b", "string"), (RESCUED, "string")]
    assert rows(inferred, "a", "b") == [(1, "x"), (2, "N/A")]


# --- marts that follow the ingest -------------------------------------------------------------------------------


def per_day(raw):
    return raw.groupBy(F.col("at").cast("date").alias("d")).agg(F.count("id").alias("n"))


def test_mart_follows_files_in_any_order(spark, land, config, schema):
    mart = MartTable(spark, f"{schema}.per_day", partition_on="d")
    hook = refresh_on_load(config, mart, per_day, ["d"], "per_day")
    for name, data in {
        "april": [(1, DAY), (2, DAY)],
        "march": [(3, ts("2024-03-05 01:00"))],
        "late": [(4, DAY), (5, None)],
    }.items():
        land(name, data)
        ingest_files(spark, config, hook)
    found = rows(without_audit(mart.read()))
    assert [(str(d), n) for d, n in found] == [("2024-03-05", 1), ("2024-04-01", 3)]
    land("undated", [(6, None)])
    ingest_files(spark, config, hook)
    assert rows(without_audit(mart.read())) == found


def test_tests_run_per_load_and_stop_the_mart(spark, land, config, schema):
    mart = MartTable(spark, f"{schema}.per_day", partition_on="d")
    reports = []
    check = check_on_load(
        config, TableTests("raw", not_null=["at"]), fresh=FreshnessConfig("at", 25, 49), report=reports.append
    )
    hook = in_order(check, refresh_on_load(config, mart, per_day, ["d"], "per_day"))
    land("good", [(1, DAY)])
    ingest_files(spark, config, hook)
    assert mart.read().count() == 1 and reports[0].first().status == "error"
    land("bad", [(2, None)])
    with pytest.raises(Exception, match="not_null:at: 1"):
        ingest_files(spark, config, hook)
    assert mart.read().count() == 1


def test_stream_joins_a_dimension_too_big_to_broadcast(spark, tmp_path, trip, zones, monkeypatch):
    from lakemart.operators import joins
    from lakemart.operators.enrich import enrich

    trips = trip({}, {"pickup_location_id": 999})
    trips.write.parquet(f"{tmp_path}/trips")
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    stream = enrich(spark.readStream.schema(trips.schema).parquet(f"{tmp_path}/trips"), zones)
    seen = []
    writer = stream.writeStream.foreachBatch(lambda batch, _: seen.extend(rows(batch, "pickup_borough")))
    writer.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert seen == [(None,), ("Queens",)]


def test_event_time_mart_drops_only_rows_beyond_the_lateness(spark, tmp_path, schema, trip):
    landing, name = f"{tmp_path}/trips", f"{schema}.daily"
    mart = MartTable(spark, name, partition_on="trip_date")
    batches = ["2024-04-10 08:00", "2024-04-20 08:00", "2024-04-18 08:00", "2024-02-18 08:00", "2024-04-21 09:00"]
    kept = trip(*[{"pickup_at": ts(b), "dropoff_at": ts(b)} for b in batches[:3] + batches[4:]])
    for start in batches:
        rows_ = trip({"pickup_at": ts(start), "dropoff_at": ts(start)})
        enriched = rows_.selectExpr("*", "'Q' AS pickup_borough", "20.0D AS trip_duration_minutes", "1.0D AS tip_pct")
        enriched.coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(enriched.schema).parquet(landing)
        result = event_time_daily(stream, "pickup_at", ["pickup_borough"], daily_measures())
        start_event_time_mart(result, mart, DAILY_KEYS, f"{tmp_path}/checkpoint").awaitTermination()
    whole = kept.selectExpr("*", "'Q' AS pickup_borough", "20.0D AS trip_duration_minutes", "1.0D AS tip_pct")
    assert rows(mart.read()) == rows(daily(whole).select(*mart.read().columns))


def test_a_row_two_months_late_reaches_the_event_time_mart(spark, land, config, schema, tmp_path):
    mart, measures = MartTable(spark, f"{schema}.per_day", partition_on="trip_date"), [F.count(F.lit(1)).alias("n")]
    build = lambda raw: raw.groupBy(F.to_date("at").alias("trip_date")).agg(*measures)
    route = LateRoute(config, mart, build, f"{schema}.late")

    def step(name, *times):
        land(name, [(i, t) for i, t in enumerate(times)])
        ingest_files(spark, config, route.on_load)
        stream = spark.readStream.schema(SCHEMA).parquet(config.landing)
        result = event_time_daily(stream, "at", [], measures)
        start_event_time_mart(result, mart, ["trip_date"], str(tmp_path / "stream"), late=route).awaitTermination()
        return {str(d): n for d, n in rows(mart.read())}

    june = ts("2024-06-10 10:00")
    assert step("a", june, ts("2024-06-09 10:00")) == {"2024-06-10": 1, "2024-06-09": 1}
    late = step("b", ts("2024-04-10 10:00"), ts("2024-06-09 11:00"), None)
    assert late == {"2024-04-10": 1, "2024-06-09": 2, "2024-06-10": 1}
    assert rows(spark.table(f"{schema}.late"), "at") == [(ts("2024-04-10 10:00"),)]
    # More rows of the same late date, and rows that are on time.
    assert step("c", ts("2024-04-10 12:00"), june, ts("2024-06-12 10:00")) == {
        "2024-04-10": 2, "2024-06-09": 2, "2024-06-10": 2, "2024-06-12": 1,
    }
    assert spark.table(f"{schema}.late").count() == 2


def test_a_merge_of_a_date_with_late_rows_recomputes_it(spark, land, config, schema):
    mart = MartTable(spark, f"{schema}.per_day", partition_on="trip_date")
    build = lambda raw: raw.groupBy(F.to_date("at").alias("trip_date")).agg(F.count(F.lit(1)).alias("n"))
    route = LateRoute(config, mart, build, f"{schema}.late")
    land("a", [(1, ts("2024-06-10 10:00")), (2, ts("2024-04-10 10:00")), (3, ts("2024-04-10 11:00"))])
    ingest_files(spark, config, route.on_load)
    # What a stream that runs behind would merge: a state without the late rows.
    day = spark.createDataFrame([(ts("2024-04-10 00:00").date(), 0)], "trip_date date, n long")
    mart.upsert(day, ["trip_date"])
    route.after_merge(spark, [ts("2024-04-10 00:00").date(), ts("2024-06-10 00:00").date()])
    assert rows(mart.read().where("trip_date = DATE'2024-04-10'"), "n") == [(2,)]


def test_sketches_of_loads_are_kept_and_merged(spark, land, config, schema, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 3)
    hook = sketch_on_load(config, {"id": F.col("id")}, f"{schema}.sketches")
    land("a", [(7, DAY)] * 4 + [(1, DAY)])
    ingest_files(spark, config, hook)
    assert stored_hot_keys(spark, f"{schema}.sketches") == {"id": []}
    land("b", [(7, DAY)] * 4 + [(2, DAY)])
    ingest_files(spark, config, hook)
    ((key, salts),) = stored_hot_keys(spark, f"{schema}.sketches")["id"]
    assert salts == 4 and key == spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint"))).first()[0]
