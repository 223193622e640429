"""Intermediate tables in the shared folder, to cut lineage between rounds.

The folder is the session's ``spark.checkpoint.dir``. A local session (one
machine, as in tests) that names none gets one of its own; on a cluster that is an
error, as each executor would write to its own disk. Tables are ordinary Parquet,
so a lost executor costs nothing but its running tasks. They last until the
application ends, as results that are not computed yet read them, then the file
system removes them.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session's own one where unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tidewater-llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


class Scratch:
    """Tables of one operator call. ``drop`` removes those no longer read; the rest
    goes when the application ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/tidewater-llm/{name}-{uuid.uuid4().hex}"
        self.n = 0
        system, target = self._at(self.root)
        system.mkdirs(target)
        system.deleteOnExit(target)

    def _at(self, path: str) -> tuple:
        """The file system of a path and the path in it, by Spark's Hadoop settings."""
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target  # noqa: SLF001

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as a table and return a frame that reads it back."""
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path  # noqa: SLF001
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete tables written here that nothing reads any more."""
        for table in tables:
            path = getattr(table, "_scratch_path", None)
            if path and path.startswith(self.root):
                system, target = self._at(path)
                system.delete(target, True)
