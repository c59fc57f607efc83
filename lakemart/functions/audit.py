"""Audit columns: when a row was written, by which run, into which model."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT_COLUMNS = ("_loaded_at", "_run_id", "_model_name")


def utc_now() -> dt.datetime:
    """One instant per run, taken on the driver so that retried tasks agree on it."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def instant(value: dt.datetime) -> Column:
    """A zone-less timestamp literal that does not pass through the time zone of the Python process."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def with_audit(
    df: DataFrame, model: str, run_id: str | None = None, now: dt.datetime | None = None
) -> DataFrame:
    """Add the three audit columns. Call it after aggregating, so they are not part of any shuffle."""
    return df.withColumns(
        {
            "_loaded_at": instant(now or utc_now()),
            "_run_id": F.lit(run_id or str(uuid.uuid4())),
            "_model_name": F.lit(model),
        }
    )


def without_audit(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT_COLUMNS)
