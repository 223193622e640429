"""Session settings shared by jobs, tests and the benchmark.

On a cluster the session normally exists already (spark-submit); ``get_session``
then only applies the runtime SQL settings below, which are all safe to set on a
live session. Shuffle sizing is left to adaptive execution: the initial
partition count is high enough for large inputs and AQE coalesces small
partitions after each shuffle, so the same code serves sf0.01 and 100 TB.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join side is broadcast only when its estimated (planner) or measured
    # (AQE, after its shuffle stage ran) size is under this bound; beyond it the
    # join stays a shuffled sort-merge join with skew splitting.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # Python call-site capture for error messages costs extra JVM round trips
    # on every column function while a plan is built; off for jobs.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "tidewater",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session (or build one) with the job's SQL settings.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster leave
    them unset and let spark-submit and AQE decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        # Local runs only: no web UI server, driver memory is the executor memory.
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "8g"))
    settings = dict(SQL_SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # A session that already existed keeps its core settings; runtime SQL
    # settings still apply.
    for key, value in settings.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Stream checkpoints and lineage-cutting tables live under it, so they survive
    the loss of any executor. Nothing here falls back to a machine-local folder:
    if the cluster does not name one, that is an error. Tests set their own.
    """
    directory = spark.sparkContext.getCheckpointDir()
    if directory:
        return directory
    directory = spark.conf.get("spark.checkpoint.dir", None)
    if not directory:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    spark.sparkContext.setCheckpointDir(directory)
    return spark.sparkContext.getCheckpointDir() or directory
