"""Structured Streaming jobs for the AIS feed (S-12, T-4 ... T-8, K-2).

Source: Kafka in production (``read_kafka``; needs the Kafka connector on the
classpath, not bundled here), a directory of JSON-lines files in tests
(``read_files``). Both yield a ``value`` text column, so the same decode /
route / key functions run on either.

``ingest_ais`` writes each micro-batch through ``foreachBatch``:
  * records are classified once (the batch is persisted for the two writes and
    recomputed from its fixed source offsets if an executor is lost);
  * good messages are keyed (MessageID + hash of canonical JSON), de-duplicated
    within the batch and against the stored keys, and written to the store;
  * rejects go to ``<rejects>/load=<load>`` with their reason; the stream keeps
    running (``fail_on_invalid=True`` stops it instead).

The store is partitioned by event date, by a hash bucket of the key, and by
load, the persistent id of the streaming query with the batch number. A batch
that is replayed after a failure replaces its own load's partitions with the same
rows. Another query, or the same one under a new checkpoint, has another id and
replaces nothing. The key lookup reads only the (date, bucket) partitions that
the batch touches, and a batch writes one file to each of them; ``compact_days``
folds the loads of closed days.

Progress lives in the checkpoint under ``spark.checkpoint.dir`` (shared
storage), so a restarted query resumes from the last committed batch.
"""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from tidewater.session import checkpoint_root
from tidewater.sinks import BUCKET_COL, bucket_of, path_exists, read_store
from tidewater.streaming.ais import JSON_COL, OK, classify, count_time, decode_ais, dedupe_messages, type_counts

FILE_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampType()),
        StructField("value", StringType()),
    ]
)


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_offsets: int | None = None,
    starting_offsets: str = "earliest",
) -> DataFrame:
    """S-12: the topic as a stream of ``value`` text plus Kafka coordinates.
    ``max_offsets`` is an optional rate limit per trigger (T-7)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    raw = reader.load()
    return raw.select(
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset",
        F.col("timestamp").alias("ts"),
    )


def read_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed messages as JSON-lines files (``event_id``, ``ts``, ``value``)."""
    reader = spark.readStream.schema(FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{checkpoint_root(spark).rstrip('/')}/streams/{name}"


KEY_COL = "message_key"
DATE_COL = "event_date"
LOAD_COL = "load"

#: Buckets of a day (and of the undated messages), by hash of the message key.
MESSAGE_BUCKETS = 8


def _stored_keys(spark: SparkSession, store_path: str, messages: DataFrame, load: str) -> DataFrame:
    """Keys already in the store from *other* loads, in the partitions this batch
    touches. A message always has the same event date and bucket, so a redelivered
    one is found there. The semi-joins on the batch's dates and buckets let dynamic
    partition pruning read only those directories; messages without a parseable
    time live under the null date, where the buckets alone select. Excluding this
    batch's own load keeps a replayed batch identical to its first attempt."""
    stored = read_store(spark, store_path, _stored_schema(messages))
    others = stored.filter(F.col(LOAD_COL) != load)
    touched = messages.select(DATE_COL, BUCKET_COL).distinct()
    dated = others.join(touched.filter(F.col(DATE_COL).isNotNull()), [DATE_COL, BUCKET_COL], "left_semi")
    buckets = touched.filter(F.col(DATE_COL).isNull()).select(BUCKET_COL)
    undated = others.filter(F.col(DATE_COL).isNull()).join(buckets, BUCKET_COL, "left_semi")
    return dated.select(KEY_COL).unionByName(undated.select(KEY_COL))


def _stored_schema(messages: DataFrame) -> StructType:
    return StructType([*messages.schema.fields, StructField(LOAD_COL, StringType())])


def keyed_messages(good: DataFrame, buckets: int = MESSAGE_BUCKETS) -> DataFrame:
    """Good messages of a batch, once each, with their store partition."""
    return (
        dedupe_messages(good)
        .withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
        .withColumn(DATE_COL, F.to_date("event_time"))
        .withColumn(BUCKET_COL, bucket_of(KEY_COL, buckets))
    )


def fresh_messages(messages: DataFrame, store_path: str, load: str) -> DataFrame:
    """Those ``messages`` that no other load has stored."""
    return messages.join(_stored_keys(messages.sparkSession, store_path, messages, load), KEY_COL, "left_anti")


def write_ais_batch(
    batch: DataFrame,
    batch_id: int,
    store_path: str,
    rejects_path: str | None,
    fail_on_invalid: bool = False,
    run_id: str = "static",
    buckets: int = MESSAGE_BUCKETS,
) -> None:
    """One micro-batch of the ingest (also usable on a static frame).

    Each message key is stored once: the batch is de-duplicated in itself and
    against keys stored by other loads, so ``read_messages`` needs no per-key
    shuffle. Rejects are kept with their reason. A load is named by ``run_id``
    and ``batch_id``; only a load of the same name is ever replaced."""
    load = f"{run_id}-{batch_id}"
    tagged = classify(batch).persist()
    try:
        if fail_on_invalid:
            shown = [c for c in ("topic", "partition", "offset", "event_id") if c in tagged.columns]
            bad = tagged.filter(F.col("reason") == "bad_structure").select(*shown).limit(1).collect()
            if bad:
                where = ", ".join(f"{c}={bad[0][c]}" for c in shown) or "an unnamed record"
                raise ValueError(f"Message or MetaData is not a JSON object in batch {batch_id} ({where})")
        good = tagged.filter(F.col("reason") == OK).drop("reason")
        fresh = fresh_messages(keyed_messages(good, buckets), store_path, load).withColumn(LOAD_COL, F.lit(load))
        (
            fresh.repartition(DATE_COL, BUCKET_COL)  # one file a touched partition
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DATE_COL, BUCKET_COL, LOAD_COL)
            .parquet(store_path)
        )
        if rejects_path:
            rejects = tagged.filter(F.col("reason") != OK).drop(JSON_COL)
            rejects.write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/{LOAD_COL}={load}")
    finally:
        tagged.unpersist()


def read_messages(spark: SparkSession, store_path: str) -> DataFrame:
    """The message store, one row per message key (no shuffle on read)."""
    return spark.read.parquet(store_path).drop(BUCKET_COL, LOAD_COL)


def compact_days(spark: SparkSession, store_path: str, target: str, before: datetime.date) -> str:
    """Copy the days before ``before`` to a new store with one load a partition."""
    if path_exists(spark, target):
        raise ValueError(f"{target} exists; compact into a new path")
    closed = spark.read.parquet(store_path).filter(F.col(DATE_COL) < F.lit(before))
    folded = closed.withColumn(LOAD_COL, F.lit("compacted"))
    folded.repartition(DATE_COL, BUCKET_COL).write.partitionBy(DATE_COL, BUCKET_COL, LOAD_COL).parquet(target)
    return target


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The persistent id that Spark keeps in a query's checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def ingest_ais(
    stream: DataFrame,
    store_path: str,
    rejects_path: str | None = None,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    fail_on_invalid: bool = False,
) -> StreamingQuery:
    """T-4: stream messages into the keyed message store."""
    spark = stream.sparkSession
    progress = _checkpoint(spark, "ais_ingest", checkpoint)

    def store(df: DataFrame, batch_id: int) -> None:
        write_ais_batch(df, batch_id, store_path, rejects_path, fail_on_invalid, _query_id(spark, progress))

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", progress)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def type_count_stream(
    stream: DataFrame,
    path: str | None = None,
    checkpoint: str | None = None,
    window: str = "15 minutes",
    watermark: str = "1 hour",
    output_mode: str = "append",
    query_name: str | None = None,
    available_now: bool = True,
    dedupe: bool = False,
) -> StreamingQuery:
    """T-5 / T-6 / T-7: per-window message type counts of the live feed.

    Every good frame counts, redelivered ones too, as in ``message_type_counts``.
    With ``dedupe`` a message redelivered within the watermark is counted once:
    messages are de-duplicated by key before counting, with the same watermark, so
    both stateful steps keep bounded state.

    ``append`` emits a window once the watermark passes its end (final counts;
    rows later than the watermark are not counted). ``complete`` re-emits all
    windows each trigger (tests). With ``path`` the counts go to Parquet,
    otherwise to an in-memory table named ``query_name``."""
    spark = stream.sparkSession
    good = classify(stream).filter(F.col("reason") == OK).drop("reason")
    decoded = dedupe_messages(good, watermark=watermark) if dedupe else count_time(decode_ais(good))
    counts = type_counts(decoded, window=window, watermark=None if dedupe else watermark)
    writer = counts.writeStream.outputMode(output_mode)
    if path:
        writer = writer.format("parquet").option("path", path)
    else:
        writer = writer.format("memory").queryName(query_name or "message_type_counts")
    writer = writer.option("checkpointLocation", _checkpoint(spark, query_name or "type_counts", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
