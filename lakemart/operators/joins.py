"""Joins to lookup sides that stay even when one key holds a large share of the rows.

A lookup side is broadcast only after its row count and bytes have been measured against a fixed bound. A larger
side is joined by shuffle, with the heaviest keys of the fact side spread over several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.config import ConfigError
from lakemart.session import stable

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

# A key with at least twice HOT_ROWS rows is spread, so that about HOT_ROWS of them go to one task. Up to
# LITERAL_KEYS hot keys are written into the plan; a longer list is joined as a table.
HOT_ROWS = 1_000_000
LITERAL_KEYS = 1_000
# Rows of a stream cannot be counted ahead: without a sketch of the keys, each is spread over so many salts.
STREAM_SALTS = 8
# Keys that a sketch keeps count of. A key is missed or overcounted by at most some 4 / SKETCH_ITEMS of all rows.
SKETCH_ITEMS = 50_000

# Hashes of hot keys, and the salts of each.
HotKeys = Sequence[tuple[int, int]]


class DuplicateKeyError(ValueError):
    """A side that must have one row per key has several."""


@dataclass(frozen=True)
class SideProfile:
    """Measured size of a join side."""

    rows: int
    bytes: int
    max_copies: int
    keys: tuple[str, ...]

    @property
    def broadcastable(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.bytes <= BROADCAST_BYTES

    def require_unique(self, what: str) -> SideProfile:
        if self.max_copies > 1:
            raise DuplicateKeyError(f"{what} has {self.max_copies} rows for one value of {list(self.keys)}")
        return self


def row_width(df: DataFrame) -> Column:
    """Approximate bytes of a row: the text form of each value plus a fixed part per column."""
    widths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns]
    return sum(widths, F.lit(0))


def profile_side(df: DataFrame, keys: Sequence[str]) -> SideProfile:
    """Rows, approximate bytes and most rows per key of `df`, in one job.

    Rows with a null key count towards the size but not towards the copies, as they match nothing.
    """
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(row_width(df)).alias("_b"))
    row = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("_b"), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.when(complete, F.col("_n"))), F.lit(0)).alias("copies"),
    ).first()
    return SideProfile(int(row["rows"]), int(row["bytes"]), int(row["copies"]), tuple(keys))


def require_unique(df: DataFrame, keys: Sequence[str], what: str, *, null_safe: bool = True) -> None:
    """Raise if a key occurs twice. With `null_safe` null equals null, as in a null-safe merge."""
    rows = df if null_safe else df.dropna(subset=list(keys))
    doubled = rows.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if doubled:
        raise DuplicateKeyError(f"{what} has {doubled[0]['count']} rows for one value of {list(keys)}")


def same_type(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> tuple[Column, Column]:
    """The two key columns with one type, so that their hashes agree as well as their values."""
    a, b = left.schema[left_key].dataType, right.schema[right_key].dataType
    lhs, rhs = F.col(left_key), F.col(right_key)
    if a == b:
        return lhs, rhs
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return lhs.cast("bigint"), rhs.cast("bigint")
    if all(isinstance(t, (T.IntegralType, T.FloatType, T.DoubleType)) for t in (a, b)):
        return lhs.cast("double"), rhs.cast("double")
    raise ConfigError(f"key types differ: {left_key} is {a.simpleString()}, {right_key} is {b.simpleString()}")


def hot_keys(df: DataFrame, key_hash: Column) -> DataFrame:
    """Hashes of the keys with at least twice HOT_ROWS rows: `_h`, `_salts` (a power of four).

    Counts are combined before the shuffle. There is at most one such key for each 2 * HOT_ROWS rows.
    """
    counts = df.select(key_hash.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    salts = F.pow(F.lit(4), F.greatest(F.lit(1), F.ceil(F.log(4.0, F.col("_n") / float(HOT_ROWS)))))
    return counts.where(F.col("_n") >= 2 * HOT_ROWS).select("_h", salts.cast("int").alias("_salts"))


def key_sketches(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Frequent-items sketches of several keys, in one pass over `df`: name, sketch; one row for each of `keys`.

    A sketch has a fixed size. It can be stored, and sketches of parts of a table merge into that of the whole.
    """
    columns = {f"_s{i}": F.xxhash64(key) for i, key in enumerate(keys.values())}
    made = df.select(*[h.alias(c) for c, h in columns.items()]).agg(
        *[F.call_function("approx_top_k_accumulate", F.col(c), F.lit(SKETCH_ITEMS)).alias(c) for c in columns]
    )
    pairs = [F.struct(F.lit(name).alias("name"), F.col(c).alias("sketch")) for name, c in zip(keys, columns)]
    return made.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch for each name out of several."""
    combined = F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(SKETCH_ITEMS))
    return sketches.groupBy("name").agg(combined.alias("sketch"))


def hot_in(sketches: DataFrame) -> dict[str, HotKeys]:
    """The hot keys of each name, with salts by their weight; at most `LITERAL_KEYS`, the heaviest."""
    found = F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(LITERAL_KEYS))
    rows = sketches.select("name", found.alias("top")).collect()

    def salts(n: int) -> int:
        return 4 ** max(1, math.ceil(math.log(n / HOT_ROWS, 4) - 1e-9))

    return {r["name"]: [(t["item"], salts(t["count"])) for t in r["top"] or () if t["count"] >= 2 * HOT_ROWS] for r in rows}


def spread_hot_keys(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    hot: HotKeys | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Add `_jk0.. , _salt` to the left and `_rk0.. , _rsalt` to the right side.

    Joining on keys and salt gives the same pairs as joining on the keys alone: a hot left row gets one salt and
    the right rows of a hot key exist once per salt. The salt is the number of the input partition, which is the
    same when a lost task runs again and also splits groups of identical rows.

    The hot keys are counted, or taken from `hot` if they are known from a sketch. A stream with neither spreads all.
    """
    pairs = [same_type(left, right, a, b) for a, b in zip(left_keys, right_keys)]
    left = left.withColumns({f"_jk{i}": a for i, (a, _) in enumerate(pairs)})
    right = right.withColumns({f"_rk{i}": b for i, (_, b) in enumerate(pairs)})
    left_hash = F.xxhash64(*[F.col(f"_jk{i}") for i in range(len(pairs))])
    right_hash = F.xxhash64(*[F.col(f"_rk{i}") for i in range(len(pairs))])

    def salted(salts: Column) -> Column:
        return F.when(salts > 1, F.pmod(F.spark_partition_id(), salts)).otherwise(F.lit(0))

    def copied(salts: Column) -> Column:
        return F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)) - 1)

    if left.isStreaming and hot is None:
        # Spark's estimate of the right side does not see its copies, and would broadcast all of them to each task.
        copies = right.withColumn("_rsalt", F.explode(copied(F.lit(STREAM_SALTS)))).hint("merge")
        return left.withColumn("_salt", salted(F.lit(STREAM_SALTS))), copies
    if hot is None:
        hot_table = stable(hot_keys(left, left_hash))
        # One row more than is allowed tells a long list from a short one.
        listed = [(row["_h"], row["_salts"]) for row in hot_table.limit(LITERAL_KEYS + 1).collect()]
    else:
        listed = list(hot)
    if not listed:
        return left.withColumn("_salt", F.lit(0)), right.withColumn("_rsalt", F.lit(0))
    if hot is not None or len(listed) <= LITERAL_KEYS:
        tiers: dict[int, list[int]] = {}
        for key, n in listed:
            tiers.setdefault(n, []).append(key)

        def salts(key_hash: Column) -> Column:
            found = F.lit(1)
            for n, hashes in tiers.items():
                found = F.when(key_hash.isin(hashes), F.lit(n)).otherwise(found)
            return found

        return left.withColumn("_salt", salted(salts(left_hash))), right.withColumn(
            "_rsalt", F.explode(copied(salts(right_hash)))
        )
    size = profile_side(hot_table, ["_h"])
    table = F.broadcast(hot_table) if size.broadcastable else hot_table
    a = left.withColumn("_lh", left_hash).join(table, F.col("_lh") == F.col("_h"), "left")
    b = right.withColumn("_lh", right_hash).join(table, F.col("_lh") == F.col("_h"), "left")
    a = a.withColumn("_salt", salted(F.coalesce("_salts", F.lit(1))))
    b = b.withColumn("_rsalt", F.explode(copied(F.col("_salts"))))
    return a.drop("_lh", "_h", "_salts"), b.drop("_lh", "_h", "_salts")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    how: str,
    *,
    null_safe: bool = False,
    residual: Column | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Shuffled `left` or `left_anti` join with hot left keys spread; drops the helper columns and right keys."""
    a, b = spread_hot_keys(left, right, left_keys, right_keys, hot)
    b = b.drop(*right_keys)
    condition = F.col("_salt") == F.col("_rsalt")
    for i in range(len(left_keys)):
        lhs, rhs = F.col(f"_jk{i}"), F.col(f"_rk{i}")
        condition = condition & (lhs.eqNullSafe(rhs) if null_safe else lhs == rhs)
    if residual is not None:
        condition = condition & residual
    helpers = [f"{p}{i}" for p in ("_jk", "_rk") for i in range(len(left_keys))]
    return a.join(b, condition, how).drop("_salt", "_rsalt", *helpers)


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    columns: Mapping[str, str],
    profile: SideProfile | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Left join that adds `columns` (dimension name -> output name); unmatched facts get nulls.

    The dimension must have one row per key, else facts would multiply; that is checked. Pass `profile` to join
    the same dimension in several roles without measuring it again, and `hot` keys known from a sketch.
    """
    taken = {c.lower() for c in facts.columns}
    clash = [out for out in columns.values() if out.lower() in taken]
    if clash:
        raise ConfigError(f"lookup columns {clash} exist on the fact side")
    profile = (profile or profile_side(dim, [dim_key])).require_unique("lookup side")
    right = dim.select(F.col(dim_key).alias("_lookup"), *[F.col(c).alias(out) for c, out in columns.items()])
    if profile.broadcastable:
        lhs, rhs = same_type(facts, right, fact_key, "_lookup")
        return facts.join(F.broadcast(right), lhs == rhs, "left").drop("_lookup")
    return spread_join(facts, right, [fact_key], ["_lookup"], "left", hot=hot)


def hot_lookup_keys(facts: DataFrame, dim: DataFrame, fact_keys: Sequence[str], dim_key: str) -> dict[str, HotKeys]:
    """The hot keys of every role in which `facts` looks up `dim`, from one pass over `facts`."""
    typed = {key: same_type(facts, dim.select(F.col(dim_key).alias("_lookup")), key, "_lookup")[0] for key in fact_keys}
    return hot_in(key_sketches(facts, typed))


def without_matches(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: bool = True,
    profile: SideProfile | None = None,
) -> DataFrame:
    """Target rows whose key is not in `source`. A small source is broadcast, so the target is not shuffled.

    `profile` is the measured size of `source`, if it is known.
    """
    if not keys:
        # Without a condition every target row would match.
        raise ConfigError("a merge needs at least one key column")
    names = [f"_src{i}" for i in range(len(keys))]
    wanted = source.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    if not (profile or profile_side(wanted, names)).broadcastable:
        return spread_join(target, wanted, keys, names, "left_anti", null_safe=null_safe)
    condition = F.lit(True)
    for key, name in zip(keys, names):
        lhs, rhs = same_type(target, wanted, key, name)
        condition = condition & (lhs.eqNullSafe(rhs) if null_safe else lhs == rhs)
    return target.join(F.broadcast(wanted), condition, "left_anti")
