"""Vessels in dangerous conditions: each position's nearest port, the forecast
that was known there at the time, and the hazard thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.clean import round_half_up
from tidewater.operators.asof import asof_join
from tidewater.operators.cut import cut
from tidewater.operators.nearest import nearest_place
from tidewater.plans.weather import hazard_condition

#: A position further from every port has no forecast of its own.
REACH_KM = 100.0
#: A forecast hour further away says nothing about a position, seconds.
TOLERANCE_SECONDS = 5400
#: Forecast measures that a position gets.
CONDITIONS = ("wave_height", "ocean_current_velocity", "sea_surface_temperature")


def nearest_ports(positions: DataFrame, ports: DataFrame, radius_km: float = REACH_KM) -> DataFrame:
    """``positions`` with the nearest of ``ports`` (port_id, latitude, longitude)
    within the radius and its distance, null where there is none."""
    places = ports.select("port_id", "latitude", "longitude")
    return nearest_place(positions, places, radius_km, "port_id")


def forecast_at(positions: DataFrame, forecast: DataFrame, tolerance: int = TOLERANCE_SECONDS) -> DataFrame:
    """``positions`` (with port_id and event_time) with what was forecast for their
    port and hour: of the newest run of the port that was known by then, the valid
    hour nearest to the position's time (the earlier of two equally near ones).
    Of several rows of one hour the greatest measures count."""
    # One row an hour of a run, written once: the runs and the hours both read it.
    known = forecast.filter("port_id is not null and ref_time is not null").groupBy("port_id", "ref_time", "forecast_timestamp")
    known = cut(known.agg(F.max(F.struct(*CONDITIONS)).alias("most")), "forecast-hours").select("port_id", "ref_time", "forecast_timestamp", "most.*")
    runs = known.select("port_id", "ref_time").distinct()
    at = positions.withColumn("__at", F.col("event_time").cast("timestamp"))
    with_run = cut(asof_join(cut(at, "positions"), runs, ["port_id"], "__at", "ref_time"), "with-run")
    out = asof_join(with_run, known, ["port_id", "ref_time"], "__at", "forecast_timestamp", "nearest", tolerance=tolerance)
    return out.drop("__at")


def dangerous_positions(positions: DataFrame, ports: DataFrame, forecast: DataFrame, radius_km: float = REACH_KM) -> DataFrame:
    """Positions in forecast conditions beyond the hazard thresholds."""
    near = nearest_ports(positions, ports, radius_km).filter("port_id is not null")
    danger = forecast_at(near, forecast).filter(hazard_condition())
    return danger.select(
        "event_id", "mmsi", "latitude", "longitude", "port_id", round_half_up("distance_km", 3).alias("distance_km"), "ref_time", "forecast_timestamp",
        *[round_half_up(c, 2).alias(c) for c in CONDITIONS],
    )
