import datetime as dt
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakemart.config import ConfigError
from lakemart.operators import reconcile
from lakemart.operators.reconcile import is_equal, leaf_digests, same_content, tree_diff, two_way_diff

BIG = 2**53


def column(spark, kind, *values):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


@pytest.mark.parametrize(
    "a, b, equal",
    [
        (("bigint", BIG + 1), ("double", float(BIG)), False),
        (("bigint", BIG), ("double", float(BIG)), True),
        (("bigint", 2**63 - 1), ("double", float(2**63)), False),
        (("bigint", -(2**63)), ("double", -float(2**63)), True),
        (("bigint", 0), ("double", -0.0), True),
        (("int", 3), ("double", 3.5), False),
        (("float", 0.5), ("double", 0.5), True),
        (("decimal(38,0)", Decimal(10) ** 25), ("bigint", 5), False),
        (("decimal(38,0)", Decimal(7)), ("bigint", 7), True),
        (("decimal(38,0)", Decimal(BIG + 1)), ("double", float(BIG)), False),
        (("decimal(10,2)", Decimal("0.10")), ("double", 0.1), True),
        (("decimal(10,2)", Decimal("1.50")), ("decimal(12,4)", Decimal("1.5")), True),
        (("decimal(10,2)", None), ("double", None), True),
        (("bigint", None), ("double", float("nan")), False),
    ],
)
def test_numbers_of_different_types_are_compared_exactly(spark, a, b, equal):
    left, right = column(spark, *a), column(spark, *b)
    assert is_equal(left, right) is equal
    assert same_content(left, right).first()["equal"] is equal


def test_decimals_that_no_type_holds_are_refused(spark):
    with pytest.raises(ConfigError, match="decimal"):
        two_way_diff(column(spark, "decimal(38,30)", Decimal(1)), column(spark, "bigint", 1))


DAY = dt.date(2024, 1, 1)


@pytest.fixture
def stored(spark, schema):
    """Two copies of a table split by day; `change` edits the second one."""

    def build(change=lambda df: df):
        df = spark.range(600).select(
            "id", (F.col("id") * 2).alias("v"),
            F.when(F.col("id") % 7 < 6, F.date_add(F.lit(DAY), (F.col("id") % 7).cast("int"))).alias("day"),
        )
        for name, rows_ in (("a", df), ("b", change(df))):
            rows_.repartition(1).write.partitionBy("day").saveAsTable(f"{schema}.{name}")
        return spark.table(f"{schema}.a"), spark.table(f"{schema}.b")

    return build


def edited(df):
    return df.where("id <> 8").withColumn("v", F.when(F.col("id").isin(1, 6), -1).otherwise(F.col("v")))


@pytest.mark.parametrize("keys", [["id"], []])
def test_tree_finds_what_a_full_difference_finds(spark, stored, keys):
    a, b = stored(edited)
    want = rows(two_way_diff(a, b))
    assert rows(tree_diff(a, b, "day", keys)) == want and len(want) == 5
    assert rows(tree_diff(a, b, "day", keys, buckets=1)) == want


def days(df):
    return {f.split("day=")[1].split("/")[0] for f in df.inputFiles() if "day=" in f}


def test_equal_partitions_are_not_read_a_second_time(spark, stored):
    a, b = stored(edited)
    assert len(days(a)) == 7
    assert days(tree_diff(a, b, "day", ["id"])) == {"2024-01-02", "__HIVE_DEFAULT_PARTITION__"}
    equal = tree_diff(a, a, "day", ["id"])
    assert equal.count() == 0 and days(equal) == set()


def test_stored_leaves_spare_the_first_scan(spark, stored, schema):
    a, b = stored(edited)
    trees = {}
    for name, df in (("a", a), ("b", b)):
        leaf_digests(df, "day", ["id"]).write.saveAsTable(f"{schema}.{name}_tree")
        trees[name] = spark.table(f"{schema}.{name}_tree")
    found = tree_diff(a, b, "day", ["id"], original_leaves=trees["a"], generated_leaves=trees["b"])
    assert rows(found) == rows(two_way_diff(a, b))


def test_more_unequal_partitions_than_literals(spark, stored, monkeypatch):
    monkeypatch.setattr(reconcile, "LITERAL_KEYS", 1)
    a, b = stored(edited)
    assert rows(tree_diff(a, b, "day", ["id"])) == rows(two_way_diff(a, b))


def test_whole_partitions_on_one_side(spark, stored):
    a, b = stored(lambda df: df.where("day > DATE'2024-01-02' OR day IS NULL"))
    assert rows(tree_diff(a, b, "day", ["id"])) == rows(two_way_diff(a, b))
    empty = a.where("id < 0")
    assert tree_diff(empty, empty, "day").count() == 0
    assert tree_diff(empty, a, "day").count() == 600


def test_repeated_rows_count_in_the_tree(spark, stored):
    a, b = stored(lambda df: df.unionByName(df.where("id = 3")))
    assert rows(tree_diff(a, b, "day"), "id", "original_copies", "generated_copies") == [(3, 1, 2)]
