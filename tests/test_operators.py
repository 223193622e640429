"""Latest-per-key, upsert, cells round trip, filters, profiles."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators.cells import cells_to_rows, rows_to_cells
from tidewater.operators.dedup import latest_by_key, upsert
from tidewater.operators.filters import latest_run, recent
from tidewater.operators.profile import stage_counts
from tidewater.sources.catalog import PORTS, Catalog


def test_latest_by_key_picks_greatest_order_then_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "p"), ("b", 0, "q")], "k string, t int, v string"
    )
    out = {r.k: (r.t, r.v) for r in latest_by_key(df, ["k"], ["t"]).collect()}
    assert out == {"a": (2, "z"), "b": (0, "q")}  # null order is oldest; ties broken by the rest
    assert latest_by_key(df, ["k"], ["t"]).columns == ["k", "t", "v"]


def test_latest_by_key_plan_aggregates_partially(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = latest_by_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_upsert_is_idempotent_and_last_write_wins(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 1, "keep")], "k string, v int, s string")
    updates = spark.createDataFrame([("a", 2, "new"), ("c", 1, "add"), ("a", 0, "stale")], "k string, v int, s string")
    once = upsert(target, updates, ["k"], ["v"])
    twice = upsert(once, updates, ["k"], ["v"])
    expect = {("a", 2, "new"), ("b", 1, "keep"), ("c", 1, "add")}
    assert {tuple(r) for r in once.collect()} == expect
    assert {tuple(r) for r in twice.collect()} == expect


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5), st.sampled_from(["x", "y"])), max_size=20))
def test_upsert_twice_equals_once_property(spark, rows):
    schema = "k string, v int, s string"
    empty = spark.createDataFrame([], schema)
    updates = spark.createDataFrame(rows, schema)
    once = upsert(empty, updates, ["k"], ["v"])
    twice = upsert(once, updates, ["k"], ["v"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    # brute force: the max (v, s) per key
    best = {}
    for k, v, s in rows:
        best[k] = max(best.get(k, (v, s)), (v, s))
    assert sorted(map(tuple, once.collect())) == sorted((k, v, s) for k, (v, s) in best.items())


def test_cells_round_trip_is_identity_on_non_null(spark):
    cat = Catalog("t", "id", {"id": ("rowkey", "id"), "a": ("f", "qa"), "b": ("g", "qb"), "ts": ("m", "ts")})
    rows = spark.createDataFrame([("r1", "1", None, "10"), ("r2", "2", "x", "11")], "id string, a string, b string, ts string")
    cells = rows_to_cells(rows, cat, ts_col="ts")
    assert cells.count() == 5  # 3 value columns x 2 rows, the null cell skipped
    back = cells_to_rows(cells, cat)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_newest_cell_wins(spark):
    cells = spark.createDataFrame(
        [("P1", "info", "berths", "3", 1), ("P1", "info", "berths", "4", 2), ("P1", "info", "name", "Old", 1)],
        "row_key string, family string, qualifier string, value string, cell_ts bigint",
    )
    row = cells_to_rows(cells, PORTS).collect()[0]
    assert row.berths == "4" and row.port_name == "Old" and row.country is None and row.id == "P1"


def test_latest_run_is_global_and_per_key_variant(spark):
    df = spark.createDataFrame([("P1", 1), ("P1", 2), ("P2", 1)], "port_id string, ref_time bigint")
    assert [tuple(r) for r in latest_run(df).collect()] == [("P1", 2)]


def test_recent_window_whole_seconds(spark):
    df = spark.createDataFrame(
        [("2024-01-01 10:00:00.9",), ("2024-01-01 09:00:00.1",), ("2024-01-01 08:59:59.9",)], "t string"
    ).select(F.to_timestamp("t").alias("t"))
    assert recent(df, "t", 3600).count() == 2


def test_profiles_single_pass(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), (None, None)], "a string, b int")
    out = stage_counts(df, {"loaded": F.count("*"), "with_a": F.count_if(F.col("a").isNotNull())})
    assert {r.stage: r.row_count for r in out.collect()} == {"loaded": 3, "with_a": 1}


def test_upsert_store_missing_target_then_replayed_batches(spark, scratch):
    import os
    import uuid

    from tidewater.sinks import read_upserted, write_upsert_batch

    path = os.path.join(scratch, f"store-{uuid.uuid4().hex}")
    schema = "k string, v int, s string"
    assert read_upserted(spark, path, ["k"], ["v"], schema=schema).count() == 0  # K-3: nothing written yet
    b0 = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], schema)
    b1 = spark.createDataFrame([("a", 2, "z")], schema)
    write_upsert_batch(b0, path, 0)
    write_upsert_batch(b1, path, 1)
    write_upsert_batch(b1, path, 1)  # replay of batch 1 rewrites its own directory
    got = sorted(map(tuple, read_upserted(spark, path, ["k"], ["v"]).collect()))
    assert got == [("a", 2, "z"), ("b", 1, "y")]


def test_catalog_from_connector_json_and_scan(spark, scratch):
    import json
    import os
    import uuid

    from tidewater.sources.catalog import scan

    text = json.dumps({
        "table": {"namespace": "default", "name": "harbours"},
        "rowkey": "id",
        "columns": {
            "id": {"cf": "rowkey", "col": "id", "type": "string"},
            "harbour": {"cf": "info", "col": "name", "type": "string"},
            "depth": {"cf": "info", "col": "depth", "type": "string"},
            "seen": {"cf": "meta_data", "col": "timestamp", "type": "string"},
        },
    })
    cat = Catalog.from_json(text)
    assert cat.table == "harbours" and cat.value_columns == ["harbour", "depth", "seen"]
    assert cat.columns["harbour"] == ("info", "name")

    path = os.path.join(scratch, f"harbours-{uuid.uuid4().hex}")
    spark.createDataFrame([("h1", "North", "5"), ("h2", "South", None)], "id string, harbour string, seen string") \
        .write.parquet(path)
    got = scan(spark, cat, path)
    assert got.columns == ["id", "harbour", "depth", "seen"]  # absent cells come back as null text
    assert [r.depth for r in got.collect()] == [None, None]


def test_current_weather_rows_round_trip_through_cells(spark):
    from tidewater.sources import fixtures as fx
    from tidewater.sources.catalog import CURRENT_WEATHER
    from tidewater.sources.payloads import explode_current

    from .conftest import SF_SMALL

    rows, rejects = explode_current(fx.current_payloads(spark, SF_SMALL))
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    back = cells_to_rows(rows_to_cells(text, CURRENT_WEATHER, ts_col="timestamp"), CURRENT_WEATHER)
    cols = ["id", "port_id", "port_name", "timestamp", "wave_height", "sea_surface_temperature"]
    assert sorted(map(tuple, back.select(cols).collect())) == sorted(map(tuple, text.select(cols).collect()))
    assert rejects.count() + rows.count() == fx.table(spark, SF_SMALL, "supplier").count()


def test_compact_folds_batches_without_changing_the_read(spark, scratch):
    import os
    import uuid

    from tidewater.sinks import compact, read_upserted, write_upsert_batch

    path = os.path.join(scratch, f"store-{uuid.uuid4().hex}")
    schema = "k string, v int, s string"
    for i in range(3):
        write_upsert_batch(spark.createDataFrame([("a", i, f"a{i}"), (f"k{i}", 0, "x")], schema), path, i)
    before = sorted(map(tuple, read_upserted(spark, path, ["k"], ["v"]).collect()))
    target = os.path.join(scratch, f"compacted-{uuid.uuid4().hex}")
    compact(spark, path, target, ["k"], ["v"])
    after = sorted(map(tuple, read_upserted(spark, target, ["k"], ["v"]).collect()))
    assert before == after == [("a", 2, "a2"), ("k0", 0, "x"), ("k1", 0, "x"), ("k2", 0, "x")]
    assert spark.read.parquet(target).count() == 4  # one row per key after compaction


def test_read_upserted_narrows_before_the_shuffle(spark, scratch):
    import os
    import uuid

    from tidewater.sinks import read_upserted, write_upsert_batch

    path = os.path.join(scratch, f"store-{uuid.uuid4().hex}")
    schema = "k string, v int, s string, wide string"
    write_upsert_batch(spark.createDataFrame([("a", 1, "x", "w1"), ("b", 1, "y", "w2")], schema), path, 0)
    write_upsert_batch(spark.createDataFrame([("a", 2, "z", "w3")], schema), path, 1)
    df = read_upserted(spark, path, ["k"], ["v"], columns=["s"])
    assert df.columns == ["k", "s"]
    assert sorted(map(tuple, df.collect())) == [("a", "z"), ("b", "y")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan.split("ReadSchema:")[1].split("\n")[0]  # the unread column is not even scanned


def test_read_upserted_key_filter_prunes_partitions(spark, scratch):
    import os
    import uuid

    from tidewater.sinks import read_upserted, write_upsert_batch

    path = os.path.join(scratch, f"store-{uuid.uuid4().hex}")
    schema = "k string, d string, v int"
    b0 = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-01-02", 1), ("b", "2024-01-02", 1)], schema)
    b1 = spark.createDataFrame([("a", "2024-01-02", 2), ("b", "2024-01-01", 5)], schema)
    write_upsert_batch(b0, path, 0, partition_by=["d"])
    write_upsert_batch(b1, path, 1, partition_by=["d"])
    # a filter on a key that is also a partition column runs below the per-key
    # aggregate, so only that date's files are listed and read
    day = read_upserted(spark, path, ["k", "d"], ["v"]).filter(F.col("d") == "2024-01-02")
    assert sorted((r.k, r.v) for r in day.collect()) == [("a", 2), ("b", 1)]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "(d#" in plan.split("PartitionFilters:")[1].split("]")[0]
