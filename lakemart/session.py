"""Session defaults and the shared folder that survives losing executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from lakemart.config import ConfigError

SESSION_DEFAULTS = {
    # Pinned, so zone-less timestamps and instants compare the same on every machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # REBALANCE before partitioned writes: split a big date, fold small ones.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name: str = "lakemart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, named by `spark.checkpoint.dir`.

    Without the setting a temporary folder is used in local mode only; on a cluster that is an error, since a
    folder of one machine is lost with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ConfigError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    root = context.getCheckpointDir()
    if not root:
        root = tempfile.mkdtemp(prefix="lakemart-")
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/lakemart/{label}-{uuid.uuid4().hex}"


def stable(df: DataFrame) -> DataFrame:
    """Compute `df` once, into the shared folder. Later reads neither recompute it nor depend on executors."""
    root, context = shared_dir(df.sparkSession), df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return df.checkpoint(eager=True)
