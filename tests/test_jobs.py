"""End-to-end report jobs and SQL functions."""

import os
import uuid

import pytest

from tidewater.functions.sql import register_sql_functions
from tidewater.plans import jobs
from tidewater.queries import QUERIES
from tidewater.sources import fixtures as fx

from .conftest import SF_SMALL


def _same_rows(spark, path, df):
    written = spark.read.parquet(path)
    assert sorted(written.columns) == sorted(df.columns)
    cols = sorted(df.columns)
    return sorted(map(tuple, written.select(cols).collect()), key=str) == sorted(
        map(tuple, df.select(cols).collect()), key=str
    )


def test_weather_job_writes_every_report(spark, scratch):
    out = os.path.join(scratch, f"weather-{uuid.uuid4().hex}")
    paths = jobs.weather_job(fx.forecast_raw(spark, SF_SMALL), fx.ports_raw(spark, SF_SMALL), out)
    assert set(paths) >= {"weather_port_summary", "storm_detection", "temperature_analysis", "current_analysis",
                          "hazardous_ports", "regional_weather_comparison", "null_profile", "wave_comparison"}
    for name in ("weather_port_summary", "hazardous_ports", "regional_weather_comparison", "null_profile"):
        assert _same_rows(spark, paths[name], QUERIES[name](spark, SF_SMALL)), name


def test_fleet_job_writes_every_report(spark, scratch):
    out = os.path.join(scratch, f"fleet-{uuid.uuid4().hex}")
    paths = jobs.fleet_job(fx.ports_raw(spark, SF_SMALL), fx.vessels_raw(spark, SF_SMALL), out)
    assert len(paths) == 8
    for name in ("ports_by_country", "vessel_size_analysis", "largest_vessels"):
        assert _same_rows(spark, paths[name], QUERIES[name](spark, SF_SMALL)), name


def test_movement_job_writes_every_report(spark, scratch):
    out = os.path.join(scratch, f"movement-{uuid.uuid4().hex}")
    paths = jobs.movement_job(fx.ais_raw(spark, SF_SMALL), out)
    for name in ("speed_stats", "vessel_speed_patterns", "navigation_hotspots", "movement_status"):
        assert _same_rows(spark, paths[name], QUERIES[name](spark, SF_SMALL)), name


def test_sql_extractors_match_dataframe_path(spark):
    register_sql_functions(spark)
    store = fx.ais_store(spark, SF_SMALL)
    store.createOrReplaceTempView("ais_messages_store")
    via_sql = spark.sql(
        "select event_id, extract_sog(position_report) as s, extract_cog(position_report) as c, "
        "extract_heading(position_report) as h from ais_messages_store where message_type = 'PositionReport'"
    )
    via_df = QUERIES["ais_decode"](spark, SF_SMALL).filter("message_type = 'PositionReport'").selectExpr(
        "event_id", "speed_over_ground as s", "course_over_ground as c", "heading as h"
    )
    assert sorted(map(tuple, via_sql.collect()), key=str) == sorted(map(tuple, via_df.collect()), key=str)
    plan = via_sql._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_cli_runs_jobs_on_landed_tables(spark, scratch):
    from tidewater import cli

    run = os.path.join(scratch, f"cli-{uuid.uuid4().hex}")
    fx.forecast_raw(spark, SF_SMALL).write.parquet(os.path.join(run, "forecast"))
    fx.ports_raw(spark, SF_SMALL).write.parquet(os.path.join(run, "ports"))
    fx.vessels_raw(spark, SF_SMALL).write.parquet(os.path.join(run, "vessels"))
    fx.ais_raw(spark, SF_SMALL).write.parquet(os.path.join(run, "messages"))
    fx.ais_dirty(spark, SF_SMALL).select("event_id", "ts", "value").write.json(os.path.join(run, "landed"))

    weather = cli.main(["weather", "--forecast", f"{run}/forecast", "--ports", f"{run}/ports", "--out", f"{run}/w"])
    assert _same_rows(spark, weather["hazardous_ports"], QUERIES["hazardous_ports"](spark, SF_SMALL))
    fleet = cli.main(["fleet", "--ports", f"{run}/ports", "--vessels", f"{run}/vessels", "--out", f"{run}/f"])
    assert _same_rows(spark, fleet["vessels_by_flag"], QUERIES["vessels_by_flag"](spark, SF_SMALL))
    moves = cli.main(["movement", "--messages", f"{run}/messages", "--out", f"{run}/m"])
    assert _same_rows(spark, moves["movement_status"], QUERIES["movement_status"](spark, SF_SMALL))
    cli.main(["ingest-ais", "--files", f"{run}/landed", "--store", f"{run}/store", "--rejects", f"{run}/rej",
              "--checkpoint", f"{run}/chk"])
    assert spark.read.parquet(f"{run}/store").count() == QUERIES["ais_dedup"](spark, SF_SMALL).count()

    # reports over the ingested store equal reports over the de-duplicated good messages
    from tidewater.plans import movement as mv
    from tidewater.streaming.ais import decode_ais, dedupe_messages, route_invalid

    from_store = cli.main(["movement", "--store", f"{run}/store", "--out", f"{run}/ms"])
    good, _ = route_invalid(fx.ais_dirty(spark, SF_SMALL))
    expect = mv.movement_status(mv.positions(decode_ais(dedupe_messages(good).select("value"))))
    assert _same_rows(spark, from_store["movement_status"], expect)


def test_load_jobs_land_payloads_into_stores(spark, scratch):
    import pytest
    from pyspark.sql import functions as F

    from tidewater.sinks import read_upserted
    from tidewater.sources.catalog import PORTS
    from tidewater.sources.payloads import read_json_payloads

    run = os.path.join(scratch, f"load-{uuid.uuid4().hex}")
    fx.forecast_payloads(spark, SF_SMALL).write.json(f"{run}/landed_forecast")
    payloads = read_json_payloads(spark, f"{run}/landed_forecast")
    jobs.forecast_load_job(payloads, f"{run}/forecast")
    jobs.forecast_load_job(payloads, f"{run}/forecast")  # re-landing the same run
    store = spark.read.parquet(f"{run}/forecast")
    expect = QUERIES["forecast_unnest"](spark, SF_SMALL)
    assert store.count() == expect.count()
    assert store.select("ref_time").distinct().count() == 1
    assert store.filter(F.col("wave_height").isNotNull()).count() == expect.count()

    jobs.registry_load_job(fx.registry_payloads(spark, SF_SMALL), f"{run}/ports", PORTS, 1704067200, 0)
    ports = read_upserted(spark, f"{run}/ports", ["id"])
    assert ports.count() == QUERIES["registry_explode"](spark, SF_SMALL).count()
    assert ports.select("timestamp").distinct().collect()[0][0] == "1704067200"
    bad = spark.createDataFrame([('{"error": "quota exceeded"}',)], "payload string")
    with pytest.raises(RuntimeError, match="quota exceeded"):
        jobs.registry_load_job(bad, f"{run}/ports", PORTS, 1704070800, 1)
    cut = fx.registry_payloads(spark, SF_SMALL).select(F.substring("payload", 1, 50).alias("payload"))
    with pytest.raises(RuntimeError, match="unparseable"):
        jobs.registry_load_job(cut, f"{run}/ports", PORTS, 1704070800, 1)
    # the same load id with other content adds; the same content again changes nothing
    one = spark.createDataFrame([('{"error": false, "data": [{"port_id": "NEW"}]}',)], "payload string")
    before = ports.count()
    for _ in range(2):
        jobs.registry_load_job(one, f"{run}/ports", PORTS, 1704067200, 0)
        assert read_upserted(spark, f"{run}/ports", ["id"]).count() == before + 1

    # a document that cannot be read stops the load, or is kept apart
    dirty = fx.forecast_texts(spark, SF_SMALL).unionByName(spark.createDataFrame([("{cut",)], "payload string"))
    with pytest.raises(RuntimeError, match="unparseable"):
        jobs.forecast_load_job(dirty, f"{run}/forecast2")
    jobs.forecast_load_job(dirty, f"{run}/forecast2", f"{run}/forecast_rejects")
    assert spark.read.parquet(f"{run}/forecast_rejects").count() + spark.read.parquet(f"{run}/forecast2").select(
        "port_id").distinct().count() == dirty.count()

    jobs.current_load_job(fx.current_payloads(spark, SF_SMALL), f"{run}/current", 0, f"{run}/current_rejects")
    assert read_upserted(spark, f"{run}/current", ["id"]).count() + spark.read.parquet(
        f"{run}/current_rejects").count() == fx.table(spark, SF_SMALL, "supplier").count()


def test_cli_load_commands(spark, scratch):
    from tidewater import cli
    from tidewater.sinks import read_upserted

    run = os.path.join(scratch, f"cli-load-{uuid.uuid4().hex}")
    fx.forecast_payloads(spark, SF_SMALL).write.json(f"{run}/lf")
    fx.vessel_registry_payloads(spark, SF_SMALL).select("payload").write.text(f"{run}/lr")
    fx.current_payloads(spark, SF_SMALL).write.text(f"{run}/lc")
    cli.main(["forecast-load", "--payloads", f"{run}/lf", "--store", f"{run}/forecast"])
    assert spark.read.parquet(f"{run}/forecast").count() == QUERIES["forecast_unnest"](spark, SF_SMALL).count()
    fx.ports_raw(spark, SF_SMALL).write.parquet(f"{run}/ports")
    reports = cli.main(["weather", "--forecast", f"{run}/forecast", "--ports", f"{run}/ports", "--out", f"{run}/w"])
    summary = spark.read.parquet(reports["weather_port_summary"])
    assert summary.count() == fx.table(spark, SF_SMALL, "supplier").count()  # one row per landed port
    assert summary.filter("forecast_records = 72 and avg_wave_height is not null").count() == summary.count()
    assert summary.filter("latitude is null or longitude is null").count() == 0
    cli.main(["registry-load", "--payloads", f"{run}/lr", "--store", f"{run}/vessels", "--catalog", "vessels",
              "--fetched-at", "1704067200", "--batch-id", "0"])
    vessels = read_upserted(spark, f"{run}/vessels", ["id"])
    assert vessels.count() == QUERIES["vessel_registry_explode"](spark, SF_SMALL).count()
    cli.main(["current-load", "--payloads", f"{run}/lc", "--store", f"{run}/current", "--batch-id", "0"])
    assert read_upserted(spark, f"{run}/current", ["id"]).count() == QUERIES["current_weather_rows"](
        spark, SF_SMALL).count()


def test_forecast_store_merges_by_row_key(spark, scratch):
    """Re-landing one port of a run replaces its rows and leaves all others; a
    document delivered twice adds nothing."""
    path = os.path.join(scratch, f"merge-{uuid.uuid4().hex}")

    def document(port, wave, start=0):
        return (f'{{"port_id": "{port}", "hourly": {{"start": {start}, "interval": 1, "end": {start + 2}, "wave_height": [{wave}, {wave}]}}}}',)

    def load(*rows):
        jobs.forecast_load_job(spark.createDataFrame(list(rows), "payload string"), path)
        return sorted((r.port_id, r.ref_time, r.wave_height) for r in spark.read.parquet(path).collect())

    ports = [f"P{i}" for i in range(40)]
    first = load(*[document(p, 1.0) for p in ports], *[document(p, 1.0) for p in ports[:5]], document("P1", 9.0, start=100))
    assert first == sorted([(p, 0, 1.0) for p in ports for _ in (0, 1)] + [("P1", 100, 9.0)] * 2)
    second = load(document("P7", 2.0), document("P7", 2.0))
    assert second == sorted([r for r in first if r[0] != "P7"] + [("P7", 0, 2.0)] * 2)
    files = {f for f in spark.read.parquet(path).inputFiles() if "ref_time=0" in f}
    assert len(files) <= 16


def test_jobs_read_what_is_stored(spark, scratch):
    """Movement reports use the store's typed columns; the storm report is written
    without a global sort."""
    from tidewater.plans import movement, weather
    from tidewater.streaming.ingest import read_messages, write_ais_batch

    store = os.path.join(scratch, f"typed-{uuid.uuid4().hex}")
    write_ais_batch(fx.ais_raw(spark, SF_SMALL), 0, store, None)
    seen = []
    original = movement.positions
    movement.positions = lambda d, *a: seen.append(d) or original(d, *a)
    try:
        out = jobs.movement_job(read_messages(spark, store), f"{store}-out", since="2024-01-05", until="2024-01-09")
    finally:
        movement.positions = original
    plan = spark._jvm.PythonSQLUtils.explainString(seen[0]._jdf.queryExecution(), "formatted")
    assert "parse_json" not in plan and "PartitionFilters: [isnotnull(event_date" in plan
    days = read_messages(spark, store).filter("event_date >= '2024-01-05' and event_date < '2024-01-09'")
    assert _same_rows(spark, out["movement_status"], movement.movement_status(original(days)))
    storms = weather.storm_detection(weather.prepare_forecast(fx.forecast_raw(spark, SF_SMALL)), weather.latest_ports(fx.ports_raw(spark, SF_SMALL)))
    assert "rangepartitioning" not in storms._jdf.queryExecution().executedPlan().toString()


def test_reports_come_in_order(spark):
    """O-1: reports of a bounded size are sorted, nulls where the engine puts them."""
    def key(v, down):
        return (v is None, -v if down else v) if not isinstance(v, str) else (v is None, v)

    orders = {
        "weather_port_summary": [("avg_wave_height", True), ("port_id", False)], "hazardous_ports": [("hazard_count", True)],
        "ports_by_country": [("port_count", True)], "vessels_by_type": [("vessel_count", True)], "vessels_by_flag": [("vessel_count", True)],
        "largest_vessels": [("length", True)], "navigation_hotspots": [("vessel_count", True)], "movement_status": [("position_reports", True)],
        "temperature_analysis": [("avg_temp", False), ("port_id", False)], "current_analysis": [("avg_current_velocity", True)],
    }
    for name, columns in orders.items():
        rows = QUERIES[name](spark, SF_SMALL).collect()
        got = [tuple((0, 0) if r[c] is None and not down else key(r[c], down) if r[c] is not None else (True, 0) for c, down in columns) for r in rows]
        assert got == sorted(got) and len(got) > 1, name


def test_forecast_store_keeps_null_runs_and_missing_cells(spark, scratch):
    """Loads of different keys with a null run both stay, and a sparse load, by
    nulls or by columns it does not have, leaves the other cells alone."""
    from tidewater.sinks import store_schema, write_forecast_store

    path = os.path.join(scratch, f"cells-{uuid.uuid4().hex}")
    schema = "id string, port_id string, ref_time long, wave double, current double"

    def load(rows, columns=schema):
        write_forecast_store(spark.createDataFrame(rows, columns), path, buckets=1)

    load([("a", "P", None, 1.0, 2.0), ("b", "P", 5, 1.0, 2.0), ("c", "P", 5, 3.0, None)])
    load([("d", "P", None, 9.0, 9.0), ("b", "P", 5, None, 7.0)])
    load([("c", "P", 5, 4.0, 20.5)], "id string, port_id string, ref_time long, wave double, temp double")
    load([(None, "P", 5, 8.0, None), (None, "P", 5, None, 8.5)])
    got = {r["id"]: (r["ref_time"], r["wave"], r["current"], r["temp"]) for r in spark.read.schema(store_schema(spark, path)).parquet(path).collect()}
    assert got == {
        "a": (None, 1.0, 2.0, None), "d": (None, 9.0, 9.0, None), "b": (5, 1.0, 7.0, None), "c": (5, 4.0, None, 20.5), None: (5, 8.0, None, None),
    }
    with pytest.raises(ValueError, match="wave"):
        load([("x", "P", 5, "high", 1.0)], "id string, port_id string, ref_time long, wave string, current double")
