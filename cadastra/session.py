"""Session settings the package is designed around.

Nothing in the package needs its own session: any SparkSession works. This builder only
collects the settings that matter at scale, for the bench, the tests and scripts.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # FIPS codes are strings with leading zeros: directory values must not become integers.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Only the partitions present in an overwrite are replaced.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Call sites of every column expression are only for error texts and slow plan building down.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def build_session(master: str | None = None, app: str = "cadastra", **extra: str) -> SparkSession:
    """Return a session with the package settings; `extra` uses `__` for dots in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Return a new folder for tables written between steps.

    The cluster names the parent in spark.checkpoint.dir. Only where that is unset and all tasks run on this machine
    (tests) a temporary folder is made and set; on a cluster each executor would write to a disk of its own there.
    """
    parent = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not parent:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cadastra-"))
        parent = spark.sparkContext.getCheckpointDir()
    return f"{parent.rstrip('/')}/{uuid.uuid4().hex}"
