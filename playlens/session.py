"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

#: Settings that change results or plans.  UTC keeps dates stable, dynamic overwrite lets
#: the partition writers replace only the dates they touch, AQE splits skewed joins.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a task that writes up to so many partitions keeps their files open in place of sorting its rows,
    # which are wide and would be spilled
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the job settings to a session that already exists."""
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "playlens", cores: str = "8", **extra: str) -> SparkSession:
    """A small local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**JOB_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``.  A local folder is used only where
    that setting is absent and the master is local, as in tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return tempfile.mkdtemp(prefix="playlens-checkpoint-")
