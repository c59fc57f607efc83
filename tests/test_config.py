import pytest

from lakemart.config import (
    ConfigError,
    DimensionConfig,
    FreshnessConfig,
    IncrementalConfig,
    Project,
    StagingConfig,
    schema_name,
    table_name,
)


def test_schema_routing():
    assert schema_name("dev") == "dev"
    assert schema_name("dev", " marts ") == "dev_marts"
    assert table_name("prod", "staging", "stg_trips") == "prod_staging.stg_trips"


def test_staging_mistakes_are_reported():
    with pytest.raises(ConfigError, match="source_name"):
        StagingConfig("t", None, passthrough=["a"])
    with pytest.raises(ConfigError, match="selects nothing"):
        StagingConfig("t", "raw", filters=["a > 1"])
    with pytest.raises(ConfigError, match="more than once"):
        StagingConfig("t", "raw", rename={"a": "x"}, derived_columns={"X": "1"})
    with pytest.raises(ConfigError, match="no staging config for 'unknown'"):
        Project().staging_for("unknown")


def test_overrides_beat_configuration_and_zero_counts():
    config = IncrementalConfig("m", "trip_date", 3, ["trip_date", "borough"])
    assert config.resolve().days == 3
    assert config.resolve(late_arrival_days=0).days == 0
    assert config.resolve(late_arrival_days=45).days == 45
    assert IncrementalConfig("m", "d").resolve().days == 0


def test_incremental_mistakes_are_reported():
    with pytest.raises(ConfigError, match="watermark_column"):
        IncrementalConfig("m", None)
    with pytest.raises(ConfigError, match="0 or more"):
        IncrementalConfig("m", "d", -1)
    with pytest.raises(ConfigError, match="one of the keys"):
        IncrementalConfig("m", "loaded_at", 3, ["trip_date"])


def test_dimension_and_freshness_mistakes_are_reported():
    with pytest.raises(ConfigError, match="tracked_columns"):
        DimensionConfig("d", 2, "id")
    with pytest.raises(ConfigError, match="scd_type"):
        DimensionConfig("d", 3, "id")
    with pytest.raises(ConfigError, match="business key"):
        DimensionConfig("d", 2, "id", ["id"])
    with pytest.raises(ConfigError, match="must not exceed"):
        FreshnessConfig("ts", 50, 49)


def test_project_from_plain_mapping():
    project = Project.from_mapping(
        {
            "staging_configs": {"zones": {"source_name": "raw", "rename": {"LocationID": "location_id"}}},
            "incremental_configs": {"fct": {"watermark_column": "trip_date", "late_arrival_days": 3}},
            "dimension_configs": {
                "zones": {"scd_type": 2, "business_key": "location_id", "tracked_columns": ["name"], "reason": "r"}
            },
        },
        keys={"fct": ["trip_date", "borough"]},
    )
    assert project.staging_for("zones").output_columns == ["location_id"]
    assert list(project.incremental_for("fct").keys) == ["trip_date", "borough"]
    assert project.dimension_for("zones").scd_type == 2
    with pytest.raises(ConfigError, match="source_name"):
        Project.from_mapping({"staging_configs": {"zones": {"passthrough": ["a"]}}})
