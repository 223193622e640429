"""Cut a plan in two by a table in the shared folder.

A frame that several later steps read, each of them read by several more, would be
planned and run once for every path. Written once, it is read as often as needed,
and a lost executor costs no more than its running tasks. The folder is the
session's ``spark.checkpoint.dir``. A local session (one machine, as in tests) that
names none gets one of its own; on a cluster that is an error, as each executor
would write to its own disk. Tables last until the application ends, as results
that are not computed yet read them; then the file system removes them.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tidewater-cut-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a table of its own, as a frame that reads it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tidewater-cut/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    df.write.parquet(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)  # noqa: SLF001
    return spark.read.schema(df.schema).parquet(path)
