"""End-to-end report jobs: scan once, clean once, write every report (K-1).

The reference runs 31 / 11 / 10 / 7 actions per job, each rescanning the store.
Here each job cleans its input once, persists the frame all reports share
(``MEMORY_AND_DISK``: lost blocks are recomputed from the fixed input, so an
executor loss costs a recompute, not the job), writes its reports, and
unpersists. Report writes fail loudly.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tidewater.functions.clean import WEATHER_SENTINELS
from tidewater.plans import fleet, movement, weather
from tidewater.sinks import write_report
from tidewater.streaming.ais import decode_ais


def _write_all(reports: dict[str, DataFrame], out_base: str) -> dict[str, str]:
    return {name: write_report(df, out_base, name) for name, df in reports.items()}


def weather_job(forecast_raw: DataFrame, ports_raw: DataFrame, out_base: str) -> dict[str, str]:
    """Conditions, hazards and the country comparison over the newest run: the
    run's cleaned text is read and kept once, typed rows derive from it, and the
    registry's newest snapshots are kept once."""
    text = weather.latest_run_text(weather.clean_forecast_text(weather.forecast_scan(forecast_raw)))
    text = text.persist(StorageLevel.MEMORY_AND_DISK)
    newest = weather.type_forecast(text)
    snapshots = weather.ports_scan(ports_raw).persist(StorageLevel.MEMORY_AND_DISK)
    ports = weather.latest_ports(snapshots)
    ports_clean = weather.latest_ports(snapshots, sentinels=WEATHER_SENTINELS)
    try:
        return _write_all(
            {
                "weather_port_summary": weather.weather_port_summary(newest, ports),
                "storm_detection": weather.storm_detection(newest, ports),
                "temperature_analysis": weather.temperature_analysis(newest, ports),
                "current_analysis": weather.current_analysis(newest, ports),
                "wave_comparison": weather.wave_comparison(newest, ports),
                "hazardous_ports": weather.hazardous_ports(newest, ports),
                "regional_weather_comparison": weather.regional_weather_comparison(newest, ports_clean),
                "null_profile": weather.null_profile(text, ports),
            },
            out_base,
        )
    finally:
        text.unpersist()
        snapshots.unpersist()


def fleet_job(ports_raw: DataFrame, vessels_raw: DataFrame, out_base: str) -> dict[str, str]:
    """Port and vessel registry reports."""
    stats = fleet.port_statistics(ports_raw).persist(StorageLevel.MEMORY_AND_DISK)
    vessels = fleet.vessel_fleet(vessels_raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _write_all(
            {
                "port_statistics": stats,
                "ports_by_country": fleet.ports_by_country(stats),
                "regional_ports": fleet.regional_ports(stats),
                "vessel_fleet": vessels,
                "vessels_by_type": fleet.vessels_by_type(vessels),
                "vessels_by_flag": fleet.vessels_by_flag(vessels),
                "vessel_size_analysis": fleet.vessel_size_analysis(vessels),
                "largest_vessels": fleet.largest_vessels(vessels),
            },
            out_base,
        )
    finally:
        stats.unpersist()
        vessels.unpersist()


def movement_job(
    messages: DataFrame, out_base: str, value_col: str = "value", since: str | None = None, until: str | None = None
) -> dict[str, str]:
    """Movement reports over every position report (no row limit).

    Rows of the message store are typed already and used as they are; only raw
    messages (a ``value_col`` text without typed columns) are decoded. ``since``
    and ``until`` (dates, the latter exclusive) prune the store's partitions. Each
    report scans the columns it needs; the history is not cached."""
    typed = "speed_over_ground" in messages.columns
    decoded = messages if typed else decode_ais(messages, value_col)
    for bound, keep in ((since, ">="), (until, "<")):
        if bound:
            day = "event_date" if "event_date" in decoded.columns else "to_date(event_time)"
            decoded = decoded.filter(f"{day} {keep} date '{bound}'")
    pos = movement.positions(decoded)
    return _write_all(
        {
            "speed_stats": movement.speed_stats(pos),
            "vessel_speed_patterns": movement.vessel_speed_patterns(pos),
            "navigation_hotspots": movement.navigation_hotspots(pos),
            "movement_status": movement.movement_status(pos),
        },
        out_base,
    )


# ------------------------------------------------------------------ load jobs (landed payloads -> stores)

def _fail_on(rejects: DataFrame, what: str) -> None:
    """Stop a load on its first reject; at most one row reaches the driver."""
    first = rejects.limit(1).collect()
    if first:
        r = first[0].asDict()
        raise RuntimeError(f"{what}: {r['reason']}, {r.get('error') or (r['payload'] or '')[:200]}")


def forecast_load_job(payloads: DataFrame, store_path: str, rejects_path: str | None = None) -> str:
    """Hourly forecast texts -> typed rows -> the forecast store, merged by row
    key, so that re-landing any part of a run is idempotent and leaves the rest.
    Rejects go to ``rejects_path``; without one, the first reject fails the load."""
    from pyspark.sql import functions as F

    from tidewater.sinks import write_forecast_store
    from tidewater.sources.payloads import explode_forecast, split_forecast

    documents, rejects = split_forecast(payloads)
    if rejects_path:
        rejects.write.mode("append").parquet(rejects_path)
    else:
        _fail_on(rejects, "Forecast document")
    rows = explode_forecast(documents)
    return write_forecast_store(rows.withColumn("ref_time", F.col("ref_time").cast("bigint")), store_path)


def registry_load_job(
    payloads: DataFrame, store_path: str, catalog, fetched_at: int, batch_id: int, key_col: str | None = None
) -> str:
    """Registry pages -> snapshot rows -> one load of the upsert store. An error
    response or a corrupt page fails the load, as the reference's fetchers raise."""
    from tidewater.sinks import write_upsert_batch
    from tidewater.sources.payloads import explode_registry

    rows, errors = explode_registry(payloads, catalog, key_col=key_col, fetched_at=fetched_at)
    _fail_on(errors, "Registry API error")
    return write_upsert_batch(rows, store_path, batch_id)


def current_load_job(payloads: DataFrame, store_path: str, batch_id: int, rejects_path: str | None = None) -> str:
    """Current-conditions documents -> one row per port -> one load; failed
    documents go to ``rejects_path`` and the rest load."""
    from tidewater.sinks import write_upsert_batch
    from tidewater.sources.payloads import explode_current

    rows, rejects = explode_current(payloads)
    if rejects_path:
        write_upsert_batch(rejects, rejects_path, batch_id)
    return write_upsert_batch(rows, store_path, batch_id)
