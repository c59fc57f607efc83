"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.session import scratch_path

# What separates words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, unless PYTHONPATH or an installation does so already."""
    package = Path(__file__).resolve().parent.parent
    root, context = package.parent, spark.sparkContext
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if context.applicationId in _shipped or str(root) in paths or root.name == "site-packages":
        return
    folder = tempfile.mkdtemp(prefix="lakemart-package-")  # read by the driver alone, which serves it to executors
    context.addPyFile(shutil.make_archive(f"{folder}/lakemart_package", "zip", root, package.name))
    _shipped.add(context.applicationId)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: computed once, and not lost with an executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Column names like `names` that clash with none of `taken`, in any letter case."""
    known, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in known:
            name = f"_{name}"
        known.add(name.lower())
        out.append(name)
    return out


def bind(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, however often `body` uses it."""
    return F.transform(F.array(value), body)[0]


def ranked(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows from 0 in a global order, without gathering them in one task.

    Rows are range-partitioned and stored; a window then runs inside each range, and the offset of a range comes
    from one row for each range.
    """
    part, offset, rows = fresh(df.columns, "part", "offset", "rows")
    ranges = stored(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy(part).agg(F.count(F.lit(1)).alias(rows))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(part, F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(offset))
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    return ranges.join(sizes, part).withColumn(name, inside + F.col(offset)).drop(part, offset)
