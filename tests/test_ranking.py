"""Ranks against sorting in Python."""

import random

import pytest
from helpers import rows

from lakemart.config import ConfigError
from lakemart.operators import joins
from lakemart.operators.ranking import ranked

KIND = "id long, a int, b string"


def by_hand(data, key):
    keys = sorted(key(r) for r in data)
    distinct = sorted(set(keys))
    return sorted((r[0], keys.index(key(r)) + 1, distinct.index(key(r)) + 1) for r in data)


def low(v):
    return (v is None, v if v is not None else 0)


@pytest.mark.parametrize("shuffled", [False, True])
def test_ranks_with_ties_and_nulls(spark, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(joins, "HOT_ROWS", 20)
    random_ = random.Random(1)
    # A third of all rows tie.
    data = [(i, random_.choice([5, 5, None, *range(8)]), random_.choice(["x", "y", None])) for i in range(400)]
    df = spark.createDataFrame(data, KIND).repartition(7)
    found = ranked(df, [("a", False)])
    assert found.columns == ["id", "a", "b", "rank", "dense_rank"]
    assert sorted(map(tuple, found.select("id", "rank", "dense_rank").collect())) == by_hand(data, lambda r: low(r[1]))
    found = ranked(df, [("a", True), ("b", False)], "r", "d").select("id", "r", "d")
    key = lambda r: (r[1] is None, -(r[1] or 0), r[2] is None, r[2] or "")
    assert sorted(map(tuple, found.collect())) == by_hand(data, key)


def test_no_window_over_all_rows(spark, monkeypatch):
    df = spark.range(100).selectExpr("id", "id % 7 AS a")
    plan = ranked(df, [("a", True)])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan.replace("WindowExec", "")


def test_empty_and_wrong(spark):
    empty = spark.createDataFrame([], KIND)
    assert rows(ranked(empty, [("a", False)])) == []
    with pytest.raises(ConfigError):
        ranked(empty, [])
    with pytest.raises(ConfigError):
        ranked(empty, [("a", False)], rank="ID")
