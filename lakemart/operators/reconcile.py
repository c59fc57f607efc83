"""Are two tables equal? Counts, content hash and a two-way difference, none of which moves raw copies around."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.config import ConfigError
from lakemart.operators.joins import LITERAL_KEYS, profile_side
from lakemart.session import stable

# Leaves of a partition in a hash tree.
TREE_BUCKETS = 64


def _named_alike(original: DataFrame, generated: DataFrame) -> list[str]:
    columns = sorted(original.columns)
    if columns != sorted(generated.columns):
        raise ConfigError(f"columns differ: {sorted(set(original.columns) ^ set(generated.columns))}")
    return columns


def _exact_decimal(a: T.DataType, b: T.DataType) -> T.DecimalType | None:
    """The decimal type that holds every value of two decimal or whole-number types, if there is one."""
    scale = max(getattr(t, "scale", 0) for t in (a, b))
    whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else 19 for t in (a, b))
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def _number_text(value: Column, kind: T.DataType) -> Column:
    """A number as text that is equal for equal numbers of any type: whole ones digit by digit, others as doubles."""
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint").cast("string")
    double = value.cast("double")
    whole = (value == F.floor(value)) & (double >= -float(1 << 63)) & (double < float(1 << 63))
    return F.when(whole, value.try_cast("bigint").cast("string")).otherwise(value.cast("double").cast("string"))


def _common_types(original: DataFrame, generated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the same columns, in one order and of one type each, so that equal values have equal hashes.

    Whole numbers meet as bigint; decimals as a decimal that holds both, or not at all. Whole numbers or decimals meet
    floating-point numbers as text: exactly where the value is whole, else as doubles. Dates and timestamps meet as
    timestamps; types that have no common form are an error.
    """
    columns = _named_alike(original, generated)
    sides: dict[str, tuple[Column, Column]] = {}
    for c in columns:
        a, b = original.schema[c].dataType, generated.schema[c].dataType
        kind: str | None = None
        both = (a, b)
        if a == b:
            sides[c] = (F.col(c), F.col(c))
            continue
        if all(isinstance(t, T.IntegralType) for t in both):
            kind = "bigint"
        elif all(isinstance(t, T.DecimalType | T.IntegralType) for t in both):
            exact = _exact_decimal(a, b)
            kind = exact.simpleString() if exact else None
        elif all(isinstance(t, T.FloatType | T.DoubleType) for t in both):
            kind = "double"
        elif all(isinstance(t, T.NumericType) for t in both):
            sides[c] = (_number_text(F.col(c), a).alias(c), _number_text(F.col(c), b).alias(c))
            continue
        elif all(isinstance(t, T.DateType | T.TimestampNTZType) for t in both):
            kind = "timestamp_ntz"
        elif all(isinstance(t, T.DateType | T.TimestampType | T.TimestampNTZType) for t in both):
            kind = "timestamp"
        elif any(isinstance(t, T.NullType) for t in both):
            kind = next(t for t in both if not isinstance(t, T.NullType)).simpleString()
        if kind is None:
            raise ConfigError(f"column '{c}' is {a.simpleString()} on one side and {b.simpleString()} on the other")
        sides[c] = (F.col(c).cast(kind).alias(c), F.col(c).cast(kind).alias(c))
    return original.select(*[s[0] for s in sides.values()]), generated.select(*[s[1] for s in sides.values()])


def row_counts(original: DataFrame, generated: DataFrame) -> DataFrame:
    """One row with both counts."""
    sides = original.select(F.lit(1).alias("o"), F.lit(0).alias("g")).unionAll(
        generated.select(F.lit(0).alias("o"), F.lit(1).alias("g"))
    )
    return sides.agg(
        F.coalesce(F.sum("o"), F.lit(0)).alias("original_count"),
        F.coalesce(F.sum("g"), F.lit(0)).alias("generated_count"),
    )


def two_way_diff(original: DataFrame, generated: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, once each, with the copies on both sides.

    Columns are matched by name. Copies are counted before the shuffle, so a row repeated many times stays cheap,
    and a difference in the number of copies is reported too.
    """
    original, generated = _common_types(original, generated)
    columns = original.columns
    sides = original.select(*columns, F.lit(1).alias("_o"), F.lit(0).alias("_g")).unionAll(
        generated.select(*columns, F.lit(0).alias("_o"), F.lit(1).alias("_g"))
    )
    counted = sides.groupBy(*columns).agg(
        F.sum("_o").alias("original_copies"), F.sum("_g").alias("generated_copies")
    )
    return counted.where(F.col("original_copies") != F.col("generated_copies"))


def content_hash(df: DataFrame) -> DataFrame:
    """One row: row count and an order-independent hash. Row order and column order do not matter.

    A null is hashed with its position, so values that swap places with nulls change the result.
    """
    columns = sorted(df.columns)
    parts = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    row_hash = F.xxhash64(*parts).cast("decimal(20,0)")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(row_hash), F.lit(0)).cast("string").alias("content_hash"),
    )


def same_content(original: DataFrame, generated: DataFrame) -> DataFrame:
    """One row: both counts and whether the content hashes agree."""
    original, generated = _common_types(original, generated)
    sides = content_hash(original).withColumn("side", F.lit("o")).unionByName(
        content_hash(generated).withColumn("side", F.lit("g"))
    )
    return sides.agg(
        F.max(F.when(F.col("side") == "o", F.col("row_count"))).alias("original_count"),
        F.max(F.when(F.col("side") == "g", F.col("row_count"))).alias("generated_count"),
        (F.min("content_hash") == F.max("content_hash")).alias("equal"),
    )


def _row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two independent hashes of a row; a null is hashed with its position."""
    parts = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(F.lit(salt), *parts).cast("decimal(20,0)") for salt in (0, 1)]


def leaf_digests(df: DataFrame, by: str, keys: Sequence[str] = (), buckets: int = TREE_BUCKETS) -> DataFrame:
    """The leaves of a table's hash tree: rows and hash sums for each value of `by` and bucket of `keys`.

    One scan, and one row for each leaf and task in the shuffle. Stored beside a table, its leaves spare the next
    comparison this scan; those of a partition stay right until it is written again.
    """
    columns = sorted(df.columns)
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in (keys or columns)]), F.lit(buckets)).cast("int")
    first, second = _row_hashes(columns)
    sums = [F.sum(h).cast("string").alias(name) for h, name in ((first, "hash1"), (second, "hash2"))]
    return df.groupBy(F.col(by).alias("part"), bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("row_count"), *sums)


def unequal_leaves(original: DataFrame, generated: DataFrame) -> DataFrame:
    """Leaves (part, bucket) whose rows differ between two trees of the same columns, keys and buckets."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("part"), F.col("bucket"), F.struct("row_count", "hash1", "hash2").alias(name))

    a, b = side(original, "o"), side(generated, "g").withColumnsRenamed({"part": "part2", "bucket": "bucket2"})
    same = F.col("part").eqNullSafe(F.col("part2")) & (F.col("bucket") == F.col("bucket2"))
    both = a.join(b, same, "full").where(~F.col("o").eqNullSafe(F.col("g")))
    missing = F.col("o").isNull()
    part = F.when(missing, F.col("part2")).otherwise(F.col("part"))
    return both.select(part.alias("part"), F.coalesce("bucket", "bucket2").alias("bucket"))


def tree_diff(
    original: DataFrame,
    generated: DataFrame,
    by: str,
    keys: Sequence[str] = (),
    *,
    buckets: int = TREE_BUCKETS,
    original_leaves: DataFrame | None = None,
    generated_leaves: DataFrame | None = None,
) -> DataFrame:
    """The rows of `two_way_diff`, by a hash tree over the values of `by`, best a partition column, and key buckets.

    Leaves are compared first; only rows of unequal leaves are read again and compared. Where they lie in up to
    LITERAL_KEYS values of `by`, these are literals, so a table split by it opens no other partition. With stored
    leaves of both sides, equal partitions are not read at all. Rows that differ fall into the same leaf on both
    sides if they have the same `by` and `keys`; without keys the whole row counts, which finds the same rows.
    """
    original, generated = _common_types(original, generated)
    leaves = [
        original_leaves if original_leaves is not None else leaf_digests(original, by, keys, buckets),
        generated_leaves if generated_leaves is not None else leaf_digests(generated, by, keys, buckets),
    ]
    unequal = stable(unequal_leaves(*leaves))
    parts = [row[0] for row in unequal.select("part").distinct().limit(LITERAL_KEYS + 1).collect()]
    size = profile_side(unequal, ["part", "bucket"])
    columns = original.columns
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in (keys or columns)]), F.lit(buckets)).cast("int")
    listed = F.broadcast(unequal) if size.broadcastable else unequal
    listed = listed.withColumnsRenamed({"part": "_leaf_part", "bucket": "_leaf_bucket"})

    def suspects(df: DataFrame) -> DataFrame:
        if not parts:
            return df.where(F.lit(False))
        if len(parts) <= LITERAL_KEYS:
            among = F.col(by).isin([p for p in parts if p is not None])
            df = df.where(among | F.col(by).isNull() if None in parts else among)
        return df.join(listed, F.col(by).eqNullSafe(F.col("_leaf_part")) & (bucket == F.col("_leaf_bucket")), "left_semi")

    return two_way_diff(suspects(original), suspects(generated))


def is_equal(original: DataFrame, generated: DataFrame) -> bool:
    return two_way_diff(original, generated).limit(1).count() == 0
