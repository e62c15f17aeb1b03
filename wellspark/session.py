"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "wellspark", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the operators are written for.

    The master and the partition count are left to the cluster unless given.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def keep(df: DataFrame) -> DataFrame:
    """Checkpoint a small frame that several plans start from, in the folder the cluster names."""
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the directory the cluster names for checkpoints.

    Executors and driver must both see it, so there is no machine-local fallback.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    return f"{root.rstrip('/')}/wellspark-{uuid.uuid4().hex}"
