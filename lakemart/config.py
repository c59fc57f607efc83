"""Declarative configuration. Every mistake is reported when the object is built, before any Spark job."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field


class ConfigError(ValueError):
    """A table, model or dimension is configured in a way that cannot run."""


@dataclass(frozen=True)
class StagingConfig:
    """How one raw table becomes a clean one: the columns to keep, the ones to compute, the rows to keep."""

    table: str
    source_name: str | None
    rename: Mapping[str, str] = field(default_factory=dict)
    passthrough: Sequence[str] = ()
    derived_columns: Mapping[str, str] = field(default_factory=dict)
    filters: Sequence[str] = ()

    def __post_init__(self) -> None:
        for section, empty in (("rename", {}), ("passthrough", ()), ("derived_columns", {}), ("filters", ())):
            if getattr(self, section) is None:  # a section left empty in a YAML file
                object.__setattr__(self, section, empty)
        if not self.source_name:
            raise ConfigError(f"staging config for '{self.table}' needs a source_name")
        if not self.output_columns:
            raise ConfigError(
                f"staging config for '{self.table}' selects nothing: "
                "give at least one of rename, passthrough, derived_columns"
            )
        doubled = sorted(c for c, n in Counter(c.lower() for c in self.output_columns).items() if n > 1)
        if doubled:
            raise ConfigError(f"staging config for '{self.table}' yields {doubled} more than once")

    @property
    def output_columns(self) -> list[str]:
        return [*self.rename.values(), *self.passthrough, *self.derived_columns]


@dataclass(frozen=True)
class Watermark:
    """A resolved high-water-mark rule: reprocess `days` days before the newest value of `column`."""

    column: str
    days: int

    def __post_init__(self) -> None:
        if self.days < 0:
            raise ConfigError(f"late_arrival_days must be 0 or more, got {self.days}")


@dataclass(frozen=True)
class IncrementalConfig:
    """Merge grain and watermark of one incremental model."""

    model: str
    watermark_column: str | None
    late_arrival_days: int = 0
    keys: Sequence[str] = ()

    def __post_init__(self) -> None:
        keys = () if self.keys is None else (self.keys,) if isinstance(self.keys, str) else tuple(self.keys)
        object.__setattr__(self, "keys", keys)
        self.resolve()

    def resolve(self, watermark_column: str | None = None, late_arrival_days: int | None = None) -> Watermark:
        """Apply call-site overrides. An explicit 0 counts as an override."""
        column = watermark_column or self.watermark_column
        days = self.late_arrival_days if late_arrival_days is None else late_arrival_days
        if not column:
            raise ConfigError(f"no watermark_column configured for '{self.model}'")
        if self.keys and column not in self.keys:
            # A window that cuts through a group would replace a whole aggregate by a part of it.
            raise ConfigError(f"'{self.model}': watermark column '{column}' must be one of the keys {list(self.keys)}")
        return Watermark(column, days)


@dataclass(frozen=True)
class DimensionConfig:
    """The recorded choice for one dimension. It drives which operator loads it, not only the documentation."""

    name: str
    scd_type: int
    business_key: str
    tracked_columns: Sequence[str] = ()
    reason: str = ""

    def __post_init__(self) -> None:
        if self.scd_type not in (1, 2):
            raise ConfigError(f"dimension '{self.name}': scd_type must be 1 or 2, got {self.scd_type}")
        if self.scd_type == 2 and not self.tracked_columns:
            raise ConfigError(f"dimension '{self.name}': scd_type 2 needs tracked_columns")
        if self.business_key in self.tracked_columns:
            raise ConfigError(f"dimension '{self.name}': the business key cannot be a tracked column")


@dataclass(frozen=True)
class FreshnessConfig:
    """Age limits, in hours, of the newest value of `loaded_at_field`."""

    loaded_at_field: str
    warn_after_hours: float
    error_after_hours: float

    def __post_init__(self) -> None:
        if self.warn_after_hours > self.error_after_hours:
            raise ConfigError("warn_after_hours must not exceed error_after_hours")


@dataclass(frozen=True)
class Project:
    """All configuration of one warehouse, keyed by table, model and dimension name."""

    staging: Mapping[str, StagingConfig] = field(default_factory=dict)
    incremental: Mapping[str, IncrementalConfig] = field(default_factory=dict)
    dimensions: Mapping[str, DimensionConfig] = field(default_factory=dict)

    @classmethod
    def from_mapping(cls, conf: Mapping, keys: Mapping[str, Sequence[str]] | None = None) -> Project:
        """Build from plain nested mappings, e.g. a parsed YAML or JSON file.

        Sections: `staging_configs`, `incremental_configs`, `dimension_configs`. The merge keys of a model are the
        `keys` or the `unique_key` of its incremental entry, one name or a list; `keys` gives those of models whose
        entry has neither. A model without keys can be rebuilt, but not merged.
        """
        keys = keys or {}

        def incremental(model: str, entry: Mapping | None) -> IncrementalConfig:
            found = {"watermark_column": None, "keys": keys.get(model, ()), **(entry or {})}
            unique = found.pop("unique_key", None)
            return IncrementalConfig(model=model, **{**found, **({"keys": unique} if unique else {})})

        return cls(
            staging={
                t: StagingConfig(table=t, **{"source_name": None, **(c or {})})
                for t, c in (conf.get("staging_configs") or {}).items()
            },
            incremental={
                m: incremental(m, c) for m, c in (conf.get("incremental_configs") or {}).items()
            },
            dimensions={
                d: DimensionConfig(name=d, **c) for d, c in (conf.get("dimension_configs") or {}).items()
            },
        )

    def staging_for(self, table: str) -> StagingConfig:
        return self._entry(self.staging, table, "staging config")

    def incremental_for(self, model: str) -> IncrementalConfig:
        return self._entry(self.incremental, model, "incremental config")

    def dimension_for(self, name: str) -> DimensionConfig:
        return self._entry(self.dimensions, name, "dimension config")

    @staticmethod
    def _entry(section: Mapping, name: str, what: str):
        if name not in section:
            raise ConfigError(f"no {what} for '{name}'; configured: {sorted(section)}")
        return section[name]


def schema_name(target: str, layer: str | None = None) -> str:
    """Schema of a layer in an environment: `dev` for no layer, else `dev_marts`."""
    return target if layer is None else f"{target}_{layer.strip()}"


def table_name(target: str, layer: str | None, name: str) -> str:
    return f"{schema_name(target, layer)}.{name}"
