"""Session defaults and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "zonewise", master: str | None = None, **confs: str) -> SparkSession:
    """A session with the settings the library expects; `confs` override them.

    Shuffle partitions are left to AQE on a cluster: it starts from a high count and merges small
    partitions, so the same code runs on megabytes and on terabytes.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{key.replace("__", "."): value for key, value in confs.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local-mode session (tests) may go without the setting: it then gets a fresh temporary folder,
    which is remembered in the session.
    """
    configured = spark.conf.get(SHARED_DIR_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"set {SHARED_DIR_CONF} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="zonewise-")
    spark.conf.set(SHARED_DIR_CONF, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df, label: str = "checkpoint"):
    """Cut lineage by writing `df` to the shared folder and reading it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
