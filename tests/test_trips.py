"""Trips that queries derive from orders and lines: their joins, and how often they are done."""

import pytest
from helpers import rows, ts

from lakemart.plans import showcase

RUNS = [
    "incremental_equals_full", "late_arrival_in_window", "old_arrival_ignored", "stored_replace_window", "backfill_widened",
    "backfill_intervals", "published_mart", "full_refresh", "dq_incremental",
]


@pytest.fixture
def tables(spark, tmp_path):
    """Orders, lines, customers and suppliers with keys that repeat, are null or are missing on one side."""

    def write(name, schema, *data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    day, later = ts("1997-03-01 00:00:00"), ts("1997-03-05 00:00:00")
    write("customer", "c_custkey long, c_nationkey int", (1, 0), (1, 1), (2, 1), (None, 1))
    write("supplier", "s_suppkey long, s_nationkey int", (7, 0), (7, 1), (8, 1), (None, 0))
    write(
        "orders", "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
        (10, 1, day, "1-URGENT"), (10, 2, day, "2-HIGH"), (11, 2, day, None), (12, 9, day, "1-URGENT"), (None, 1, day, "1-URGENT"), (13, None, day, "5-LOW"),
    )
    line = (2, 4.0, 10.0, 0.5, 0.0, "O", later)
    write(
        "lineitem",
        "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_linestatus string, l_shipdate timestamp_ntz",
        *[(order, supplier, *line) for order, supplier in [(10, 7), (10, 7), (11, 8), (11, None), (None, 7), (12, 7), (13, 8), (14, 7)]],
    )
    write("nation", "n_nationkey int, n_name string, n_regionkey int", (0, "NATION_0", 0), (1, "NATION_1", 0))
    write("region", "r_regionkey int, r_name string", (0, "ASIA"))
    return str(tmp_path)


def test_raw_trips_join_every_pair_once(spark, tables):
    found = rows(showcase.raw_trips(spark, tables), "PULocationID", "DOLocationID", "payment_type")
    # Order 10 exists twice, with customer 1 (two rows) and 2; each of its two lines meets both rows of supplier 7.
    ten = [(p, d, pay) for p, pay in ((0, 1), (1, 1), (1, 2)) for d in (0, 1) for _ in range(2)]
    assert found == sorted([*ten, (1, 1, None)], key=lambda r: [(v is not None, str(v)) for v in r])


def test_lines_are_shuffled_for_their_order_once(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = showcase.raw_trips(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("l_orderkey") < plan.index("l_suppkey") and plan.index("Join") == plan.index("Join Inner, (l_orderkey")


@pytest.mark.parametrize("name", RUNS)
def test_runs_read_stored_trips(spark, tables, name, monkeypatch):
    """A query of several runs does the joins behind the trips once: what its runs read holds none."""

    class Stop(Exception):
        pass

    def run(mart, upstream, build, config, **options):
        plan = upstream._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "stg_trips" in plan
        raise Stop

    monkeypatch.setattr(showcase, "run_incremental", run)
    with pytest.raises(Stop):
        showcase.QUERIES[name](spark, tables) if name in showcase.QUERIES else getattr(showcase, name)(spark, tables)
