"""Sinks: Parquet reports, the keyed stores, and the Kafka publisher (K-1 ... K-5).

Two store layouts, both without a table format:

* the *upsert store* keeps every load under ``<path>/batch=<load>`` and resolves
  keys on read (latest per key). A load that runs again under the same id adds
  its rows once more and never removes others; reading folds the duplicates.
  ``compact`` folds the loads into a new store.
* the *forecast store* merges at write: rows of the touched (run, bucket)
  partitions are merged by row key, cell by cell, with the incoming ones and only
  these partitions are replaced. Reading is a plain scan.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidewater.operators.dedup import latest_by_key

BATCH_COL = "batch"
BUCKET_COL = "bucket"

#: Buckets of a forecast run, by hash of the port: a reload of one port rewrites
#: one of them.
FORECAST_BUCKETS = 16


def write_report(df: DataFrame, base: str, name: str, mode: str = "overwrite") -> str:
    """K-1: write a report as Parquet; failures raise (no silent warning)."""
    path = f"{base.rstrip('/')}/{name}"
    df.write.mode(mode).parquet(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the path's own Hadoop file system (local, HDFS, object store alike)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    return bool(target.getFileSystem(conf).exists(target))


def read_store(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """K-3: a store of a known schema; one that was never written is empty. A
    store that exists but cannot be read is an error, not an empty table."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_forecast_store(
    forecast: DataFrame, path: str, run_col: str = "ref_time", key: str = "id", port_col: str = "port_id",
    buckets: int = FORECAST_BUCKETS,
) -> str:
    """K-2: merge rows into the forecast store by row key, cell by cell.

    The store is partitioned by run and by a hash bucket of the port. Stored rows
    of the touched partitions stay; a row whose key comes in keeps the cells that
    the incoming one lacks (a null, or a column that the load does not have), and
    the incoming cells win. Dynamic partition overwrite replaces the touched
    partitions alone: other runs, and other ports of the same run, stay. Rows
    without a run or a key are merged like any other: null is a run, and a key, of
    its own. The store's columns are the union of all loads'. A key that comes in
    twice is kept once (the greater row). The newest-run filter (``latest_run``) is
    a partition filter on this layout, evaluated from partition values."""
    spark = forecast.sparkSession
    fresh = latest_by_key(forecast, [key]).withColumn(BUCKET_COL, bucket_of(port_col, buckets))
    known = store_schema(spark, path)
    merged = _union_schema(known, fresh.schema, [run_col, BUCKET_COL])
    stored = read_store(spark, path, merged)
    place = [run_col, BUCKET_COL]
    touched = fresh.select(*[F.col(c).alias(f"__{c}") for c in place]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in place]
    there = stored.join(touched, same, "left_semi")
    # One row a key: the incoming cell, else the stored one. Both sides pre-aggregate.
    names = [f.name for f in merged if f.name not in (*place, key)]
    sides = [
        side.select(key, *place, *[(F.col(c) if c in side.columns else F.lit(None)).cast(merged[c].dataType).alias(c) for c in names], F.lit(rank).alias("__rank"))
        for rank, side in enumerate((there, fresh))
    ]
    cell = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__rank"))).alias(c)
    rows = sides[0].unionByName(sides[1]).groupBy(key, *place).agg(*[cell(c) for c in names])
    _write_schema(spark, path, merged)
    (
        rows.select(*[f.name for f in merged])
        .repartition(*place)  # one file a touched partition
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*place)
        .parquet(path)
    )
    return path


#: Where a store keeps its schema; readers of the data skip it.
SCHEMA_DIR = "_schema"


def store_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema that the store at ``path`` was last written with (one small file);
    of a store without one, that of its files; None where there is no store."""
    at = f"{path.rstrip('/')}/{SCHEMA_DIR}"
    if path_exists(spark, at):
        return StructType.fromJson(json.loads(spark.read.text(at, wholetext=True).first()[0]))
    return spark.read.option("mergeSchema", "true").parquet(path).schema if path_exists(spark, path) else None


def _write_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Written before the data: it may name columns that no file has, which read as null."""
    if store_schema(spark, path) != schema or not path_exists(spark, f"{path.rstrip('/')}/{SCHEMA_DIR}"):
        text = spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
        text.write.mode("overwrite").text(f"{path.rstrip('/')}/{SCHEMA_DIR}")


def _union_schema(known: StructType | None, new: StructType, last: Sequence[str]) -> StructType:
    """Columns of both, the known type first, the ``last`` ones (partitions) last. A
    column that two loads have with different types is an error."""
    fields = {f.name: f.dataType for f in known or ()}
    for f in new:
        if fields.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} is {fields[f.name].simpleString()} in the store and {f.dataType.simpleString()} in the load")
    order = [c for c in fields if c not in last] + list(last)
    return StructType([StructField(c, fields[c]) for c in order])


def write_upsert_batch(
    df: DataFrame, path: str, batch_id: int | str, partition_by: Sequence[str] | None = None
) -> str:
    """K-2 write side: add one load (optionally partitioned inside, e.g. by event
    date, so later reads can prune). Rows of an earlier load under the same id
    stay; ``read_upserted`` resolves keys, so a repeated load changes nothing."""
    out = f"{path.rstrip('/')}/{BATCH_COL}={batch_id}"
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(out)
    return out


def read_upserted(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str | Column] = (),
    schema: StructType | str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """K-2 read side: newest version per key across all loads. ``order_by``
    decides which write is newest; the load id breaks remaining ties.

    ``columns`` narrows the result to those columns (plus the keys) *before*
    the per-key shuffle: the survivor struct, and so the shuffle, carries only
    what the caller reads. Order columns given by name are kept for ordering.

    K-3: a target that has never been written is an empty table of ``schema``
    (when given) rather than an error, so the first upsert needs no setup."""
    if schema is not None and not path_exists(spark, path):
        empty = spark.createDataFrame([], schema)
        return empty.select(*keys, *columns) if columns else empty
    df = spark.read.parquet(path)
    if columns:
        ordering = [o for o in order_by if isinstance(o, str) and o not in keys and o not in columns]
        df = df.select(*keys, *columns, *ordering, BATCH_COL)
    out = latest_by_key(df, keys, [*order_by, F.col(BATCH_COL)]).drop(BATCH_COL)
    return out.select(*keys, *columns) if columns else out


def compact(
    spark: SparkSession, path: str, target: str, keys: Sequence[str], order_by: Sequence[str | Column] = ()
) -> str:
    """Fold all loads of ``path`` into the one load of a new store at ``target``."""
    if path_exists(spark, target):
        raise ValueError(f"{target} exists; compact into a new path")
    return write_upsert_batch(read_upserted(spark, path, keys, order_by), target, 0)


def write_kafka_stream(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """K-5: publish rows as JSON messages. Needs the Kafka connector on the
    classpath (not bundled here); the call fails at start if it is missing."""
    return (
        df.select(F.to_json(F.struct(*df.columns)).alias("value"))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
