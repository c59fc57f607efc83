"""Slowly changing dimensions: overwrite (type 1), versioned history (type 2), current and point-in-time views.

History columns: the business key, the attributes, `valid_from`, `valid_to` (null = current), `updated_at`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.config import ConfigError, DimensionConfig
from lakemart.functions.audit import instant
from lakemart.operators.incremental import merge_upsert
from lakemart.operators.joins import (
    BROADCAST_BYTES,
    DuplicateKeyError,
    SideProfile,
    hot_keys,
    profile_side,
    same_type,
)
from lakemart.session import stable

VALIDITY = ["valid_from", "valid_to", "updated_at"]
# Versions of a key that one fact may be compared with in a broadcast history.
BROADCAST_VERSIONS = 64
# Versions of a key that one task may order.
SORTED_VERSIONS = 100_000
# The time of a hot key is cut into the square of so many slices.
SLICES = 32


class OverlapError(ValueError):
    """Two versions of one key hold at the same time."""


class NullKeyError(ValueError):
    """An incoming dimension row has no business key."""


def require_keys(incoming: DataFrame, key: str) -> None:
    """One job: the business key must be set and unique."""
    per_key = incoming.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("copies"))
    bad = per_key.where("copies > 1 OR key IS NULL").limit(1).collect()
    if bad and bad[0]["key"] is None:
        raise NullKeyError(f"incoming dimension has a null '{key}'")
    if bad:
        raise DuplicateKeyError(f"incoming dimension has {bad[0]['copies']} rows for one '{key}'")


def require_disjoint(history: DataFrame, key: str, profile: SideProfile | None = None) -> None:
    """Raise if two versions of a key overlap, one is empty or backward, or a key has two open versions.

    A version is compared with the next one of its key. Keys are ordered in ranges of (key, valid_from), which also
    cut the versions of a hot key; the last row of a range is compared with the first of the next one. Where `profile`
    shows that no key has many versions, one window by key does. Rows with a null key match no fact and are left out.
    """
    order = ["_key", "_from"]
    rows = history.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to")
    )
    if profile is not None and profile.max_copies <= SORTED_VERSIONS:
        following = F.lead("_from").over(Window.partitionBy("_key").orderBy("_from"))
        _require_no_overlap(rows.withColumn("_next", following))
        return
    ranges = stable(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part", "_key").orderBy("_from")
    pairs = ranges.select("_key", "_from", "_to", F.lead("_from").over(inside).alias("_next"))
    ends = ranges.groupBy("_part").agg(
        F.max(F.struct("_key", "_from", "_to")).alias("_last"), F.min(F.struct("_key", "_from")).alias("_first")
    )
    # One row for each range.
    following = ends.withColumn("_after", F.lead("_first").over(Window.orderBy("_part")))
    across = following.where(F.col("_after._key") == F.col("_last._key")).select(
        "_last._key", "_last._from", "_last._to", F.col("_after._from").alias("_next")
    )
    _require_no_overlap(pairs.unionByName(across))


def _require_no_overlap(pairs: DataFrame) -> None:
    overlap = F.col("_next").isNotNull() & (F.col("_to").isNull() | (F.col("_to") > F.col("_next")))
    # A second version that starts at the same moment overlaps unless the first is empty, which is wrong as well.
    backward = F.col("_from").isNull() | (F.col("_to") <= F.col("_from"))
    bad = pairs.where(overlap | backward).limit(1).collect()
    if bad:
        row = bad[0]
        raise OverlapError(f"versions of key {row['_key']!r} overlap: {row['_from']} to {row['_to']}, next {row['_next']}")


def first_versions(incoming: DataFrame, now: dt.datetime) -> DataFrame:
    """The first load: every row is current since `now`."""
    return incoming.withColumns(
        {
            "valid_from": instant(now),
            "valid_to": F.lit(None).cast("timestamp_ntz"),
            "updated_at": instant(now),
        }
    )


def history_columns(history: DataFrame, incoming: DataFrame) -> list[str]:
    """The attributes of the history, and then the new ones of `incoming`; names match in any letter case."""
    attributes = [c for c in history.columns if c not in VALIDITY]
    known = {c.lower() for c in attributes}
    return [*attributes, *[c for c in incoming.columns if c.lower() not in known]]


def with_columns_of(df: DataFrame, attributes: list[str], other: DataFrame) -> DataFrame:
    """`df` with the attributes it lacks, as nulls of the type that they have in `other`, and with their spelling."""
    own = {c.lower(): c for c in df.columns}
    kinds = {f.name.lower(): f.dataType for f in other.schema}
    picked = [
        F.col(f"`{own[c.lower()]}`").alias(c) if c.lower() in own else F.lit(None).cast(kinds[c.lower()]).alias(c)
        for c in attributes
    ]
    return df.select(*picked, *[c for c in VALIDITY if c in df.columns])


def advance(
    current_rows: DataFrame,
    incoming: DataFrame,
    config: DimensionConfig,
    now: dt.datetime,
    hard_deletes: str = "keep",
) -> DataFrame:
    """The open versions after comparing them with `incoming`, plus the versions that this closes.

    Both sides have one row per key, so the full join moves each row once and has no hot key. Each joined pair
    yields the kept row, the inserted row, or the closed and the inserted row.
    """
    if hard_deletes not in ("keep", "close"):
        raise ConfigError("hard_deletes must be 'keep' or 'close'")
    key = config.business_key
    missing = [c for c in config.tracked_columns if c not in incoming.columns]
    if missing or key not in incoming.columns:
        raise ConfigError(f"dimension '{config.name}': incoming data lacks {missing or [key]}")
    at, open_end = instant(now), F.lit(None).cast("timestamp_ntz")
    attributes = history_columns(current_rows, incoming)
    current_rows = with_columns_of(current_rows, attributes, incoming)
    incoming = with_columns_of(incoming, attributes, current_rows)

    old = current_rows.select(F.col(key).alias("_ok"), F.struct(*attributes, *VALIDITY).alias("_old"))
    new = incoming.select(F.col(key).alias("_nk"), F.struct(*attributes).alias("_new"))
    lhs, rhs = same_type(old, new, "_ok", "_nk")
    pairs = old.join(new, lhs == rhs, "full")

    def kept() -> Column:
        return F.struct(*[F.col(f"_old.{c}").alias(c) for c in [*attributes, *VALIDITY]])

    def closed() -> Column:
        return F.struct(
            *[F.col(f"_old.{c}").alias(c) for c in attributes],
            F.col("_old.valid_from").alias("valid_from"),
            at.alias("valid_to"),
            F.col("_old.updated_at").alias("updated_at"),
        )

    def inserted() -> Column:
        return F.struct(
            *[F.col(f"_new.{c}").alias(c) for c in attributes],
            at.alias("valid_from"),
            open_end.alias("valid_to"),
            at.alias("updated_at"),
        )

    # Null-safe: a value that becomes null, or stops being null, is a change.
    unchanged = F.lit(True)
    for c in config.tracked_columns:
        unchanged = unchanged & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    gone = F.array(closed()) if hard_deletes == "close" else F.array(kept())
    versions = (
        F.when(F.col("_old").isNull(), F.array(inserted()))
        .when(F.col("_new").isNull(), gone)
        .when(unchanged, F.array(kept()))
        .when(
            F.col("_old.valid_from") >= at,
            F.raise_error(F.lit(f"dimension '{config.name}': snapshot time is not after the stored version")),
        )
        .otherwise(F.array(closed(), inserted()))
    )
    return pairs.select(F.explode(versions).alias("_v")).select("_v.*")


def snapshot(
    history: DataFrame | None,
    incoming: DataFrame,
    config: DimensionConfig,
    now: dt.datetime,
    hard_deletes: str = "keep",
    validate: bool = True,
) -> DataFrame:
    """The whole history after a snapshot at `now`. Closed versions pass through untouched.

    A row whose tracked columns changed is closed and inserted anew, a new key is inserted, and a key that is
    missing from `incoming` stays current unless `hard_deletes="close"`. Columns are only ever added: one that
    `incoming` lacks stays in the history and is null in new versions, and a new one is null in old versions.
    """
    if validate:
        require_keys(incoming, config.business_key)
    if history is None:
        return first_versions(incoming, now)
    attributes = history_columns(history, incoming)
    closed = history.where(F.col("valid_to").isNotNull())
    still_closed = with_columns_of(closed, attributes, incoming).select(*attributes, *VALIDITY)
    open_rows = history.where(F.col("valid_to").isNull())
    return still_closed.unionByName(advance(open_rows, incoming, config, now, hard_deletes))


def load_dimension(
    stored: DataFrame | None, incoming: DataFrame, config: DimensionConfig, now: dt.datetime
) -> DataFrame:
    """The stored dimension after loading `incoming`, by the type that its configuration records."""
    if config.scd_type == 2:
        return snapshot(stored, incoming, config, now)
    require_keys(incoming, config.business_key)
    return incoming if stored is None else scd1_upsert(stored, incoming, config.business_key, validate=False)


def current(history: DataFrame) -> DataFrame:
    """One row per key as of now: the open versions, with the validity start and last change renamed."""
    attributes = [c for c in history.columns if c not in VALIDITY]
    return history.where(F.col("valid_to").isNull()).select(
        *attributes,
        F.col("valid_from").alias("effective_from"),
        F.col("updated_at").alias("last_changed_at"),
    )


def join_as_of(
    facts: DataFrame,
    history: DataFrame,
    fact_key: str,
    history_key: str,
    at: str,
    columns: Mapping[str, str],
    profile: SideProfile | None = None,
    validate: bool = True,
) -> DataFrame:
    """Left join that adds the attributes valid at time `at`: `valid_from <= at < valid_to`.

    Versions of one key must not overlap, as `snapshot` guarantees; that is checked (`validate`), since an overlap
    has no one answer. A small history with few versions per key is broadcast. Otherwise facts and versions are put in
    one order of key and time and each fact takes the last version before it, so the cost does not depend on how many
    versions a key has.
    """
    profile = profile or profile_side(history, [history_key])
    if validate:
        require_disjoint(history, history_key, profile)
    versions = history.select(
        F.col(history_key).alias("_hk"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        *[F.col(c).alias(out) for c, out in columns.items()],
    )
    if profile.broadcastable and profile.max_copies <= BROADCAST_VERSIONS:
        valid = (F.col("_from") <= F.col(at)) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
        lhs, rhs = same_type(facts, versions, fact_key, "_hk")
        joined = facts.join(F.broadcast(versions), (lhs == rhs) & valid, "left")
        return joined.drop("_hk", "_from", "_to")
    return _merged_in_order(facts, versions, fact_key, at, list(columns.values()))


CARRIED, STARTS, ASKS = -1, 0, 1


def _merged_in_order(facts: DataFrame, versions: DataFrame, fact_key: str, at: str, columns: list[str]) -> DataFrame:
    """Facts and versions in one order by key and time: a version starts before the facts of its moment.

    One shuffle, by key. The time of a hot key, be it hot in facts or in versions, is cut into slices of about equal
    numbers of rows, which go to different tasks; the version that still holds at the start of a slice is added to it.
    Facts without a key match nothing and are spread over tasks.
    """
    key, other = same_type(facts, versions, fact_key, "_hk")
    moment = versions.schema["_from"].dataType
    payload = ["_from", "_to", *columns]
    v_type = versions.select(F.struct(*payload).alias("v")).schema["v"].dataType
    f_type = facts.select(F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("f")).schema["f"].dataType
    asking = facts.select(
        key.alias("_k"), F.col(at).cast(moment).alias("_t"), F.lit(ASKS).alias("_kind"),
        F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_fact"), F.lit(None).cast(v_type).alias("_version"),
    )
    starting = versions.where(F.col("_hk").isNotNull()).select(
        other.alias("_k"), F.col("_from").alias("_t"), F.lit(STARTS).alias("_kind"), F.lit(None).cast(f_type).alias("_fact"),
        F.struct(*payload).alias("_version"),
    )
    cuts = _time_cuts(asking.select("_k", "_t").unionByName(starting.select("_k", "_t")))
    no_key = F.when(F.col("_k").isNull(), F.spark_partition_id()).otherwise(F.lit(0))
    if cuts is None:
        rows = asking.unionByName(starting).withColumn("_slice", no_key)
    else:
        started = _sliced(starting, cuts)
        rows = _sliced(asking.unionByName(starting), cuts).withColumn("_slice", F.coalesce("_slice", no_key))
        rows = rows.unionByName(_carried(started))
    order = Window.partitionBy("_k", "_slice").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_version", F.last("_version", ignorenulls=True).over(order)).where(F.col("_kind") == ASKS)
    version = F.col("_version")
    holds = (version["_from"] <= F.col("_t")) & (version["_to"].isNull() | (F.col("_t") < version["_to"]))
    return found.select("_fact.*", *[F.when(holds, version[c]).alias(c) for c in columns])


def _time_cuts(events: DataFrame) -> DataFrame | None:
    """Times that cut the events (_k, _t) of each hot key into slices: `_ck`, `_cuts` (lists of SLICES or fewer times).

    None without hot keys. One pass counts the keys; only the rows of hot ones are looked at again. The table is small:
    there is a hot key for each 2 * HOT_ROWS events at most, and with very many of them each gets fewer slices.
    """
    hot = stable(hot_keys(events.where("_k IS NOT NULL"), F.xxhash64("_k")))
    n = hot.count()
    if not n:
        return None
    step = max(1, min(SLICES, int((BROADCAST_BYTES / (16 * n)) ** 0.5)))
    shares = [i / step**2 for i in range(1, step**2)] or [0.5]
    among = events.join(F.broadcast(hot.select("_h")), F.xxhash64("_k") == F.col("_h"), "left_semi")
    cuts = among.groupBy(F.col("_k").alias("_ck")).agg(F.percentile_approx("_t", shares, 10_000).alias("_all"))
    starts = F.sequence(F.lit(1), F.size("_all"), F.lit(step))
    return stable(cuts.select("_ck", F.transform(starts, lambda i: F.slice("_all", i, step)).alias("_cuts")))


def _sliced(events: DataFrame, cuts: DataFrame) -> DataFrame:
    """`_slice` of each event of a hot key: how many cuts are at or before its time. Null for other keys."""
    joined = events.join(F.broadcast(cuts), F.col("_k") == F.col("_ck"), "left")
    time = F.col("_t")
    passed = F.size(F.filter("_cuts", lambda group: group[0] <= time))
    group = F.get(F.col("_cuts"), F.greatest(passed - 1, F.lit(0)))
    within = F.size(F.filter(group, lambda cut: cut <= time))
    width = F.size(F.get(F.col("_cuts"), F.lit(0)))
    place = F.when(time.isNull(), F.lit(0)).otherwise(F.greatest(passed - 1, F.lit(0)) * width + within)
    last = F.size(F.flatten("_cuts"))
    return joined.withColumns({"_slice": F.when(F.col("_ck").isNotNull(), place), "_last": last}).drop("_ck", "_cuts")


def _carried(starting: DataFrame) -> DataFrame:
    """For each slice of a hot key the version that began in an earlier one, as a row before all others of the slice."""
    ends = starting.where("_slice IS NOT NULL").groupBy("_k", "_slice", "_last").agg(
        F.max_by("_version", "_t").alias("_version")
    )
    # One row for each slice of a key.
    following = F.coalesce(F.lead("_slice").over(Window.partitionBy("_k").orderBy("_slice")), F.col("_last"))
    ends = ends.withColumn("_following", following).where(F.col("_following") > F.col("_slice"))
    slices = F.explode(F.sequence(F.col("_slice") + 1, F.col("_following")))
    kinds = {f.name: f.dataType for f in starting.schema}
    none = {c: F.lit(None).cast(kinds[c]) for c in ("_t", "_fact")}
    rows = ends.withColumns({"_slice": slices, **none, "_kind": F.lit(CARRIED)})
    return rows.select(*starting.columns)


def scd1_upsert(target: DataFrame, incoming: DataFrame, key: str, validate: bool = True) -> DataFrame:
    """Keyed overwrite without history. No watermark is applied, so changes to old keys are never missed."""
    return merge_upsert(target, incoming, [key], null_safe=False, validate=validate)
