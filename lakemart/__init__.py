"""Incremental warehouse tables on Spark: staging, enrichment, marts, merges, history, quality, ingest."""

from lakemart.config import (
    ConfigError,
    DimensionConfig,
    FreshnessConfig,
    IncrementalConfig,
    Project,
    StagingConfig,
    Watermark,
    schema_name,
    table_name,
)

__all__ = [
    "ConfigError",
    "DimensionConfig",
    "FreshnessConfig",
    "IncrementalConfig",
    "Project",
    "StagingConfig",
    "Watermark",
    "schema_name",
    "table_name",
]
