"""A session with the settings that the queries expect."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.ui.enabled": "false",
}


def session(master: str | None = None, partitions: int | None = None, memory: str | None = None, name: str = "scholarlake") -> SparkSession:
    """The session; ``master``, ``partitions`` and ``memory`` only for local work."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS)
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", partitions)
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.  Where that
    is unset, a temporary folder serves a session on one machine, as in tests; on a
    cluster that is an error, for executors would each write to a disk of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = spark.conf.get("scholarlake.folder", None)
        if folder is None:
            folder = "file://" + tempfile.mkdtemp(prefix="scholarlake-")
            spark.conf.set("scholarlake.folder", folder)
    return folder.rstrip("/")
