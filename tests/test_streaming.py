"""Stream runs over a file source: batch == stream, replay-safe ingest."""

import os
import uuid

from pyspark.sql import functions as F

from tidewater.sources import fixtures as fx
from tidewater.streaming.ais import OK, classify, decode_ais, type_counts
from tidewater.streaming.ingest import ingest_ais, read_files, read_messages, type_count_stream, write_ais_batch

from .conftest import SF_SMALL


def land(spark, df, folder):
    """Write messages as JSON-lines files, the landing format of the feed."""
    df.select("event_id", "ts", "value").write.mode("overwrite").json(folder)
    return folder


def test_stream_type_counts_equal_batch(spark, scratch):
    run = os.path.join(scratch, f"types-{uuid.uuid4().hex}")
    landed = land(spark, fx.ais_raw(spark, SF_SMALL).repartition(4), os.path.join(run, "in"))
    q = type_count_stream(
        read_files(spark, landed, max_files_per_trigger=1),
        checkpoint=os.path.join(run, "chk"),
        output_mode="complete",
        query_name="type_counts_test",
    )
    q.awaitTermination(300)
    streamed = {tuple(r) for r in spark.table("type_counts_test").collect()}
    batch = {tuple(r) for r in type_counts(decode_ais(fx.ais_raw(spark, SF_SMALL))).collect()}
    assert streamed == batch and len(batch) > 0


def canonical(df):
    """Replays come with other white space: the text without any."""
    return F.replace(df["value"], F.lit(" "), F.lit(""))


def test_ingest_is_replay_safe(spark, scratch):
    run = os.path.join(scratch, f"ingest-{uuid.uuid4().hex}")
    dirty = fx.ais_dirty(spark, SF_SMALL)
    landed = land(spark, dirty.repartition(3), os.path.join(run, "in"))
    store, rejects = os.path.join(run, "store"), os.path.join(run, "rejects")

    q = ingest_ais(read_files(spark, landed, max_files_per_trigger=1), store, rejects, os.path.join(run, "chk"))
    q.awaitTermination(300)
    n_first = read_messages(spark, store).count()

    # the same files again through a fresh checkpoint (at-least-once redelivery)
    q2 = ingest_ais(read_files(spark, landed), store, rejects, os.path.join(run, "chk2"))
    q2.awaitTermination(300)
    stored = read_messages(spark, store)  # keys are unique at rest: no shuffle needed to read
    assert stored.count() == n_first == stored.select("message_key").distinct().count()

    tagged = classify(dirty)
    good = tagged.filter(F.col("reason") == OK)
    assert n_first == good.select(canonical(good)).distinct().count()
    n_rejects = spark.read.parquet(rejects).select("event_id", "reason").distinct().count()
    assert n_rejects == tagged.filter(F.col("reason") != OK).select("event_id").distinct().count()
    assert set(spark.read.parquet(rejects).select("reason").distinct().toPandas()["reason"]) <= {
        "no_value", "bad_json", "error_frame", "bad_structure",
    }


def test_a_new_checkpoint_keeps_what_another_stored(spark, scratch):
    """Two queries whose batches carry the same numbers, over different messages."""
    run = os.path.join(scratch, f"two-{uuid.uuid4().hex}")
    store, rejects = os.path.join(run, "store"), os.path.join(run, "rejects")
    dirty = fx.ais_dirty(spark, SF_SMALL)
    for k in (0, 1):
        landed = land(spark, dirty.filter(F.col("event_id") % 2 == k), os.path.join(run, f"in{k}"))
        ingest_ais(read_files(spark, landed), store, rejects, os.path.join(run, f"chk{k}")).awaitTermination(300)
    tagged = classify(dirty)
    good = tagged.filter(F.col("reason") == OK)
    assert read_messages(spark, store).count() == good.select(canonical(good)).distinct().count()
    assert spark.read.parquet(rejects).count() == tagged.filter(F.col("reason") != OK).count()


def test_a_failed_batch_resumes_on_its_checkpoint(spark, scratch):
    """The sink stops after the store was written and before the batch is
    committed; a restart on the same checkpoint replays it and adds nothing."""
    import pytest

    from tidewater.streaming import ingest

    run = os.path.join(scratch, f"resume-{uuid.uuid4().hex}")
    landed = land(spark, fx.ais_raw(spark, SF_SMALL).repartition(3), os.path.join(run, "in"))
    store, chk = os.path.join(run, "store"), os.path.join(run, "chk")
    original, calls = ingest.write_ais_batch, []

    def failing(df, batch_id, *args, **kw):
        original(df, batch_id, *args, **kw)
        calls.append(batch_id)
        if batch_id == 1:
            raise RuntimeError("the sink stops here")

    ingest.write_ais_batch = failing
    try:
        with pytest.raises(Exception, match="the sink stops here"):
            ingest_ais(read_files(spark, landed, max_files_per_trigger=1), store, checkpoint=chk).awaitTermination(300)
    finally:
        ingest.write_ais_batch = original
    half = read_messages(spark, store).count()
    ingest_ais(read_files(spark, landed, max_files_per_trigger=1), store, checkpoint=chk).awaitTermination(300)
    stored = read_messages(spark, store)
    want = fx.ais_raw(spark, SF_SMALL).select("value").distinct().count()
    assert calls == [0, 1] and 0 < half < want == stored.count() == stored.select("message_key").distinct().count()


def test_late_rows_leave_the_counts_and_stay_in_the_store(spark, scratch):
    run = os.path.join(scratch, f"late-{uuid.uuid4().hex}")
    landed = os.path.join(run, "in")

    def message(k, time):
        value = f'{{"MessageType":"A","Message":{{"MessageID":{k}}},"MetaData":{{"time_utc":"{time}"}}}}'
        d = spark.createDataFrame([(k, None, value)], "event_id long, ts timestamp, value string")
        d.coalesce(1).write.mode("append").json(landed)

    times = ["2024-01-01 10:00:00", "2024-01-01 15:00:00", "2024-01-01 15:20:00", "2024-01-01 10:01:00", "2024-01-01 20:00:00"]
    for k, time in enumerate(times):
        message(k, time)  # the fourth comes five hours late, a batch after the watermark passed it
    out = os.path.join(run, "out")
    type_count_stream(read_files(spark, landed, max_files_per_trigger=1), path=out, checkpoint=os.path.join(run, "c1"), watermark="1 hour").awaitTermination(300)
    counts = {str(r.window_start): r.message_count for r in spark.read.parquet(out).collect()}
    assert counts["2024-01-01 10:00:00"] == 1 and counts["2024-01-01 15:00:00"] == 1
    ingest_ais(read_files(spark, landed, max_files_per_trigger=1), os.path.join(run, "store"), checkpoint=os.path.join(run, "c2")).awaitTermination(300)
    assert read_messages(spark, os.path.join(run, "store")).count() == 5


def test_every_good_frame_is_counted(spark, scratch):
    """Missing types, missing and unreadable times and the feed's own time form:
    stream and batch count the same frames, and all of them."""
    run = os.path.join(scratch, f"all-{uuid.uuid4().hex}")
    dirty = fx.ais_dirty(spark, SF_SMALL)
    landed = land(spark, dirty, os.path.join(run, "in"))
    type_count_stream(read_files(spark, landed), checkpoint=os.path.join(run, "c"), output_mode="complete", query_name="all_frames").awaitTermination(300)
    from tidewater.queries import QUERIES

    batch = {tuple(r) for r in QUERIES["message_type_counts"](spark, SF_SMALL).collect()}
    assert {tuple(r) for r in spark.table("all_frames").collect()} == batch
    good = classify(dirty).filter(F.col("reason") == OK)
    assert sum(r[3] for r in batch) == good.count() and any(r[2] == "Unknown" for r in batch)


def test_append_mode_emits_closed_windows_with_final_counts(spark, scratch):
    """Append mode with a watermark: a window is emitted once, with its final
    count, after the watermark passes its end; the newest windows stay open."""
    run = os.path.join(scratch, f"append-{uuid.uuid4().hex}")
    landed = os.path.join(run, "in")
    raw = fx.ais_raw(spark, SF_SMALL)
    week = F.floor((F.dayofmonth("ts") - 1) / 8)
    for w in range(4):  # the feed arrives in time order: one file per week, written in sequence
        raw.filter(week == w).coalesce(1).select("event_id", "ts", "value").write.mode("append").json(landed)
    out = os.path.join(run, "out")
    q = type_count_stream(
        read_files(spark, landed, max_files_per_trigger=1),
        path=out,
        checkpoint=os.path.join(run, "chk"),
        output_mode="append",
        watermark="1 hour",
    )
    q.awaitTermination(300)
    emitted = {tuple(r) for r in spark.read.parquet(out).select(
        "window_start", "window_end", "message_type", "message_count").collect()}
    batch = {tuple(r) for r in type_counts(decode_ais(fx.ais_raw(spark, SF_SMALL))).collect()}
    assert emitted and emitted <= batch  # every emitted count is final
    assert len(emitted) >= 0.9 * len(batch)  # only windows within the watermark stay open


def test_stream_dedupe_within_watermark(spark, scratch):
    """Replayed messages (same key) inside the watermark collapse to one row;
    state for a key is dropped once the watermark passes it."""
    from tidewater.streaming.ais import dedupe_messages, route_invalid

    run = os.path.join(scratch, f"dedupe-{uuid.uuid4().hex}")
    landed = os.path.join(run, "in")
    dirty = fx.ais_dirty(spark, SF_SMALL)
    week = F.floor((F.dayofmonth("ts") - 1) / 8)
    for w in range(4):
        dirty.filter(week == w).coalesce(1).write.mode("append").json(landed)
    good, _ = route_invalid(read_files(spark, landed, max_files_per_trigger=1))
    q = (
        dedupe_messages(good, watermark="1 hour")
        .select("message_key", "value")
        .writeStream.format("memory").queryName("dedupe_test")
        .option("checkpointLocation", os.path.join(run, "chk"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(300)
    got = spark.table("dedupe_test")
    assert got.count() == got.select("message_key").distinct().count()
    good_batch, _ = route_invalid(dirty)
    assert got.count() == good_batch.select(canonical(good_batch)).distinct().count()


def test_batch_replay_and_redelivery_keep_keys_unique(spark, scratch):
    run = os.path.join(scratch, f"batches-{uuid.uuid4().hex}")
    store = os.path.join(run, "store")
    raw = fx.ais_raw(spark, SF_SMALL).select("event_id", "ts", "value")
    write_ais_batch(raw, 0, store, None)
    n = read_messages(spark, store).count()
    write_ais_batch(raw, 0, store, None)  # the same batch replayed after a failure
    assert read_messages(spark, store).count() == n
    write_ais_batch(raw, 1, store, None)  # every message redelivered in a later batch
    assert read_messages(spark, store).count() == n
    assert spark.read.parquet(store).select("load").distinct().count() == 1  # nothing new in the redelivered batch
    assert n == raw.select("value").distinct().count()


def test_a_batch_reads_and_writes_only_touched_partitions(spark, scratch):
    from tidewater.streaming.ingest import MESSAGE_BUCKETS, classify as tag, compact_days, fresh_messages, keyed_messages

    run = os.path.join(scratch, f"touched-{uuid.uuid4().hex}")
    store = os.path.join(run, "store")
    raw = fx.ais_raw(spark, SF_SMALL).select("event_id", "ts", "value")
    write_ais_batch(raw, 0, store, None)
    stored = spark.read.parquet(store)
    touched = stored.select("event_date", "bucket").distinct().count()
    assert len(stored.inputFiles()) <= touched <= stored.select("event_date").distinct().count() * MESSAGE_BUCKETS

    one = raw.filter("event_id = 7")
    fresh = fresh_messages(keyed_messages(tag(one).drop("reason")), store, "other-1")
    plan = spark._jvm.PythonSQLUtils.explainString(fresh._jdf.queryExecution(), "formatted")
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line and "load" in line]
    assert any("dynamicpruning" in s and "event_date" in s for s in scans)
    assert any("dynamicpruning" in s and "bucket" in s for s in scans)
    assert fresh.count() == 0

    import datetime

    compact_days(spark, store, os.path.join(run, "folded"), datetime.date(2024, 1, 10))
    assert read_messages(spark, os.path.join(run, "folded")).count() == stored.filter("event_date < '2024-01-10'").count()


def test_empty_first_batch_does_not_break_the_next(spark, scratch):
    run = os.path.join(scratch, f"empty-{uuid.uuid4().hex}")
    store = os.path.join(run, "store")
    raw = fx.ais_raw(spark, SF_SMALL).select("event_id", "ts", "value")
    write_ais_batch(raw.filter("value is null"), 0, store, None)  # a batch with no good messages
    write_ais_batch(raw, 1, store, None)
    assert read_messages(spark, store).count() == raw.select("value").distinct().count()


def test_redelivered_message_without_time_is_stored_once(spark, scratch):
    run = os.path.join(scratch, f"notime-{uuid.uuid4().hex}")
    store = os.path.join(run, "store")
    value = ('{"MessageType":"PositionReport","Message":{"MessageID":7,"PositionReport":{"Sog":1.0}},'
             '"MetaData":{"MMSI":1,"ShipName":"V","latitude":1.0,"longitude":2.0,"time_utc":"not a time"}}')
    batch = spark.createDataFrame([(1, None, value)], "event_id long, ts timestamp, value string")
    write_ais_batch(batch, 0, store, None)
    write_ais_batch(batch, 1, store, None)
    stored = read_messages(spark, store)
    assert stored.count() == 1 and stored.collect()[0].event_date is None


def test_type_counts_count_redelivered_messages_once(spark, scratch):
    from tidewater.streaming.ais import dedupe_messages, route_invalid

    run = os.path.join(scratch, f"typededupe-{uuid.uuid4().hex}")
    landed = os.path.join(run, "in")
    dirty = fx.ais_dirty(spark, SF_SMALL)  # every tenth message is delivered twice
    week = F.floor((F.dayofmonth("ts") - 1) / 8)
    for w in range(4):
        dirty.filter(week == w).coalesce(1).write.mode("append").json(landed)
    q = type_count_stream(
        read_files(spark, landed, max_files_per_trigger=1),
        checkpoint=os.path.join(run, "chk"),
        output_mode="complete",
        query_name="type_counts_dedupe",
        dedupe=True,
    )
    q.awaitTermination(300)
    streamed = {tuple(r) for r in spark.table("type_counts_dedupe").collect()}
    good, _ = route_invalid(dirty)
    batch = {tuple(r) for r in type_counts(dedupe_messages(good)).collect()}
    assert streamed == batch


def test_recent_window_prunes_message_store_by_date(spark, scratch):
    from tidewater.operators.filters import recent

    run = os.path.join(scratch, f"recent-{uuid.uuid4().hex}")
    store = os.path.join(run, "store")
    write_ais_batch(fx.ais_raw(spark, SF_SMALL).select("event_id", "ts", "value"), 0, store, None)
    messages = read_messages(spark, store)
    pruned = recent(messages, "event_time", 3600, date_col="event_date")
    plain = recent(messages, "event_time", 3600)
    assert sorted(map(tuple, pruned.select("message_key").collect())) == sorted(
        map(tuple, plain.select("message_key").collect()))
    plan = spark._jvm.PythonSQLUtils.explainString(pruned._jdf.queryExecution(), "formatted")
    main = plan.split("===== Subqueries =====")[0]
    assert "PartitionFilters: [isnotnull(event_date" in main and "Subquery" in main
    # the newest date comes from partition values, the newest time from that date's files
    inner = plan.split("===== Subqueries =====")[1]
    assert "ReadSchema: struct<>" in inner and "PartitionFilters: [isnotnull(event_date" in inner


def test_one_wrong_clock_closes_no_window(spark, scratch):
    """A frame dated 2099 counts under its arrival, so the watermark stays with the
    others: their counts are the same with and without it."""
    counted = []
    for wrong in (False, True):
        run = os.path.join(scratch, f"clock-{uuid.uuid4().hex}")
        for part in range(5):
            rows = [
                (k, f"2024-01-01 {10 + 2 * part}:{k % 50:02d}:00", f'{{"MessageType":"A","Message":{{"MessageID":{k}}},"MetaData":{{"time_utc":"2024-01-01 {10 + 2 * part}:{k % 50:02d}:00"}}}}')
                for k in range(40 * part, 40 * part + 40)
            ]
            if wrong and part == 0:
                rows.append((999, "2024-01-01 10:00:30", '{"MessageType":"B","Message":{"MessageID":999},"MetaData":{"time_utc":"2099-01-01 00:00:00"}}'))
            d = spark.createDataFrame(rows, "event_id long, ts string, value string").withColumn("ts", F.col("ts").cast("timestamp"))
            d.coalesce(1).write.mode("append").json(os.path.join(run, "in"))
        stream = read_files(spark, os.path.join(run, "in"), max_files_per_trigger=1)
        type_count_stream(stream, path=os.path.join(run, "out"), checkpoint=os.path.join(run, "c"), watermark="1 hour").awaitTermination(300)
        rows = spark.read.parquet(os.path.join(run, "out")).collect()
        counted.append({(str(r.window_start), r.message_type): r.message_count for r in rows})
    assert {k: v for k, v in counted[1].items() if k[1] == "A"} == counted[0] and sum(counted[0].values()) >= 160
    assert counted[1][("2024-01-01 10:00:00", "B")] == 1


def test_recent_holds_wrong_clocks_to_their_arrival(spark):
    from tidewater.operators.filters import recent

    rows = [(1, "2024-01-01 10:00:00", "2024-01-01 10:00:05"), (2, "2024-01-01 09:30:00", "2024-01-01 09:30:05"), (3, "2099-01-01 00:00:00", "2024-01-01 08:00:00"), (4, "2024-01-01 10:03:00", None)]
    d = spark.createDataFrame(rows, "k long, t string, ts string").selectExpr("k", "cast(t as timestamp) as t", "cast(ts as timestamp) as ts", "to_date(t) as d")
    keys = lambda df: sorted(r["k"] for r in df.collect())
    assert keys(recent(d, "t")) == [3]
    assert keys(recent(d, "t", arrival_col="ts")) == [1, 2, 4]
    now = F.lit("2024-06-01 00:00:00").cast("timestamp")
    assert keys(recent(d, "t", not_after=now)) == keys(recent(d, "t", date_col="d", not_after=now)) == [1, 2, 4]
