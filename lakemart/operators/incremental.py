"""High-water marks and keyed merges, as pure DataFrame operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.config import ConfigError, Watermark
from lakemart.operators.joins import SideProfile, require_unique, without_matches

DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def high_water_mark(target: DataFrame, column: str) -> dt.date | None:
    """Newest date in `column`, or None for an empty target: one scalar on the driver.

    It is collected on purpose. As a literal it is pushed into the file scan of the next query; as a scalar
    subquery it would not be.
    """
    kind = target.schema[column].dataType
    if not isinstance(kind, DATE_TYPES):
        raise ConfigError(f"watermark column '{column}' must be a date or timestamp, not {kind.simpleString()}")
    return target.agg(F.max(F.col(column).cast("date")).alias("mark")).first()["mark"]


def window_start(mark: dt.date | None, watermark: Watermark) -> dt.date | None:
    return None if mark is None else mark - dt.timedelta(days=watermark.days)


def from_date(df: DataFrame, column: str, low: dt.date | None) -> DataFrame:
    """Rows with `column >= low`; all rows when there is no lower bound."""
    return df if low is None else df.where(F.col(column) >= F.lit(low))


def watermark_filter(df: DataFrame, target: DataFrame | None, watermark: Watermark) -> DataFrame:
    """Rows at or after the target's newest date minus the lookback. No target, or an empty one, keeps all."""
    mark = None if target is None else high_water_mark(target, watermark.column)
    return from_date(df, watermark.column, window_start(mark, watermark))


def _aligned(target: DataFrame, source: DataFrame) -> DataFrame:
    extra = sorted(set(source.columns) ^ set(target.columns))
    if extra:
        raise ConfigError(f"source and target columns differ: {extra}")
    return source.select(*target.columns)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: bool = True,
    validate: bool = True,
    profile: SideProfile | None = None,
) -> DataFrame:
    """The target after an upsert: rows with a key in `source` are replaced, new keys added, others kept.

    `source` is used twice; pass one that is cheap to read, see `lakemart.session.stable`. Skip `validate` when
    its keys are unique by construction, e.g. the group-by keys of an aggregate.
    """
    source = _aligned(target, source)
    if validate:
        require_unique(source, keys, "merge source", null_safe=null_safe)
    return without_matches(target, source, keys, null_safe=null_safe, profile=profile).unionByName(source)


def replace_window(target: DataFrame, source: DataFrame, column: str, low: dt.date) -> DataFrame:
    """The target with everything from `low` on replaced by `source`, so renamed groups leave nothing behind."""
    source = _aligned(target, source)
    kept = target.where((F.col(column) < F.lit(low)) | F.col(column).isNull())
    return kept.unionByName(source)
