"""Global rank and dense rank without sorting all rows in one task.

Rows with equal values share a rank, so ranks are worked out for the distinct values: these are counted with partial
aggregates, which makes one row of any number of ties, dealt by ranges, and numbered inside each range; what lies before
a range comes from one row for each range. A row then looks its value up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.config import ConfigError
from lakemart.operators.joins import profile_side, spread_join
from lakemart.session import stable


def value_ranks(values: DataFrame, columns: Sequence[str], order: Sequence[Column], copies: str) -> DataFrame:
    """`values` (distinct, with their number of `copies`) with `rank` and `dense_rank` in `order`."""
    ranges = stable(values.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = ranges.groupBy("_part").agg(F.sum(copies).alias("_rows"), F.count(F.lit(1)).alias("_values"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    earlier = sizes.select(
        "_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("_rows", "_values")]
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    smaller = F.coalesce(F.sum(copies).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = ranges.withColumns({"_smaller": smaller, "_number": F.row_number().over(inside)})
    joined = numbered.join(F.broadcast(earlier), "_part")
    return joined.select(
        *columns,
        (F.col("_smaller") + F.col("_rows_before") + 1).cast("bigint").alias("rank"),
        (F.col("_number") + F.col("_values_before")).cast("bigint").alias("dense_rank"),
    )


def ranked(df: DataFrame, by: Sequence[tuple[str, bool]], rank: str = "rank", dense_rank: str = "dense_rank") -> DataFrame:
    """`df` with two columns more: the rank and the dense rank of each row by columns, each (name, descending).

    Ties share a rank; nulls come last in either direction and tie with each other.
    """
    clash = [c for c in (rank, dense_rank) if c.lower() in {name.lower() for name in df.columns}]
    if clash or not by:
        raise ConfigError(f"ranking columns {clash} exist already" if clash else "a ranking needs at least one column")
    names = [f"_by{i}" for i in range(len(by))]
    order = [F.col(n).desc_nulls_last() if down else F.col(n).asc_nulls_last() for n, (_, down) in zip(names, by)]
    values = df.select(*[F.col(c).alias(n) for n, (c, _) in zip(names, by)]).groupBy(*names).agg(F.count(F.lit(1)).alias("_copies"))
    found = stable(value_ranks(values, names, order, "_copies"))
    found = found.withColumnsRenamed({"rank": "_rank", "dense_rank": "_dense_rank"})
    keys = [c for c, _ in by]
    if profile_side(found, names).broadcastable:
        same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(keys, names)]
        joined = df.join(F.broadcast(found), same, "left").drop(*names)
    else:
        joined = spread_join(df, found, keys, names, "left", null_safe=True)
    return joined.withColumnsRenamed({"_rank": rank, "_dense_rank": dense_rank})
