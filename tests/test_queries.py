"""Every registered query against its SQL counterpart, on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from lakemart.operators import joins, scd
from lakemart.plans import showcase, showcase_sql

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = showcase.QUERIES, showcase_sql.ORACLE


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches(spark, duck, name):
    result = QUERIES[name](spark, SF)
    assert differences(result, duck, ORACLE[name]) == []
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in ("Cartesian", "NestedLoop", "EvalPython", "InPandas") if bad in plan]


# One query per operator that treats a big side or a hot key in its own way.
BIG_SIDES = [
    "trips_enriched", "daily_mart_null_borough", "trips_enriched_as_of", "merge_null_key", "merge_plain_equality",
    "incremental_equals_full", "scd2_as_of", "scd1_upsert", "dq_relationships", "stream_event_time",
]


@pytest.mark.parametrize("name", BIG_SIDES)
def test_query_matches_when_no_side_can_be_broadcast(spark, duck, name, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_ROWS", 20)
    monkeypatch.setattr(scd, "BROADCAST_VERSIONS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert differences(QUERIES[name](spark, SF), duck, ORACLE[name]) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
