"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # Timestamps without an offset are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    # Run-time plans: partition sizes, broadcast of sides measured to be small, splitting of hot join keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session that someone else built."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "sluicework", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; on a cluster, leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def working_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir``, or a new local one where that is unset.

    The fallback is for single-machine runs; a cluster names a folder that every executor can reach.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="sluicework-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder
