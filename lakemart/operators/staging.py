"""Config-driven staging of raw tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.config import ConfigError, StagingConfig


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def stage(raw: DataFrame, config: StagingConfig) -> DataFrame:
    """Filter the raw rows, then select renamed, passed-through and derived columns, in that order.

    Filters and derived columns are SQL over the raw names. The result is lazy: filters on plain columns reach
    the file scan and columns that are not listed are never read.
    """
    rows = reduce(lambda df, condition: df.where(F.expr(condition)), config.filters, raw)
    return rows.select(
        *[F.col(quoted(old)).alias(new) for old, new in config.rename.items()],
        *[F.col(quoted(name)) for name in config.passthrough],
        *[F.expr(sql).alias(name) for name, sql in config.derived_columns.items()],
    )


def union_sources(sources: dict[str, DataFrame], label: str = "source") -> DataFrame:
    """Stack staged sources of the same grain by column name; columns a source lacks are null."""
    if not sources:
        raise ConfigError("union_sources needs at least one source")
    tagged = [df.withColumn(label, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
