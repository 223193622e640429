"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables under ``sf_dir`` through the fixtures
(store-shaped views of those tables) and runs over all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.clean import WEATHER_SENTINELS, round_half_up
from tidewater.functions.geo import parse_bbox
from tidewater.functions.sql import register_sql_functions
from tidewater.operators import cells
from tidewater.operators.dedup import upsert
from tidewater.plans import fleet, movement, profiles, safety, visits, weather
from tidewater.sources import fixtures as fx
from tidewater.sources import payloads
from tidewater.sources.catalog import PORTS, VESSELS
from tidewater.streaming import ais

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    """Register a query. Times in the store are UTC; the query pins the session
    zone to UTC so results do not depend on the caller's session settings."""

    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__ = run.__qualname__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run

    return deco


# ------------------------------------------------------------------ weather

def _forecast(spark, d):
    return weather.prepare_forecast(fx.forecast_raw(spark, d))


def _ports(spark, d):
    return weather.latest_ports(fx.ports_raw(spark, d))


@register("clean_forecast")
def clean_forecast(spark, d):
    return _forecast(spark, d)


@register("latest_run")
def latest_run(spark, d):
    from tidewater.operators.filters import latest_run as newest

    return newest(_forecast(spark, d))


@register("latest_ports")
def latest_ports(spark, d):
    return _ports(spark, d)


@register("weather_port_summary")
def weather_port_summary(spark, d):
    return weather.weather_port_summary(_forecast(spark, d), _ports(spark, d))


@register("storm_detection")
def storm_detection(spark, d):
    return weather.storm_detection(_forecast(spark, d), _ports(spark, d))


@register("temperature_analysis")
def temperature_analysis(spark, d):
    return weather.temperature_analysis(_forecast(spark, d), _ports(spark, d))


@register("current_analysis")
def current_analysis(spark, d):
    return weather.current_analysis(_forecast(spark, d), _ports(spark, d))


@register("wave_comparison")
def wave_comparison(spark, d):
    return weather.wave_comparison(_forecast(spark, d), _ports(spark, d))


@register("hazardous_ports")
def hazardous_ports(spark, d):
    return weather.hazardous_ports(_forecast(spark, d), _ports(spark, d))


@register("regional_weather_comparison")
def regional_weather_comparison(spark, d):
    ports_clean = weather.latest_ports(fx.ports_raw(spark, d), sentinels=WEATHER_SENTINELS)
    return weather.regional_weather_comparison(_forecast(spark, d), ports_clean)


@register("null_profile")
def null_profile(spark, d):
    text = weather.clean_forecast_text(weather.forecast_scan(fx.forecast_raw(spark, d)))
    return weather.null_profile(text, _ports(spark, d))


# ------------------------------------------------------------------ ports and fleet

def _port_stats(spark, d):
    return fleet.port_statistics(fx.ports_raw(spark, d))


def _fleet(spark, d):
    return fleet.vessel_fleet(fx.vessels_raw(spark, d))


@register("port_statistics")
def port_statistics(spark, d):
    return _port_stats(spark, d)


@register("ports_by_country")
def ports_by_country(spark, d):
    return fleet.ports_by_country(_port_stats(spark, d))


@register("regional_ports")
def regional_ports(spark, d):
    return fleet.regional_ports(_port_stats(spark, d))


@register("vessel_fleet")
def vessel_fleet(spark, d):
    return _fleet(spark, d)


@register("vessels_by_type")
def vessels_by_type(spark, d):
    return fleet.vessels_by_type(_fleet(spark, d))


@register("vessels_by_flag")
def vessels_by_flag(spark, d):
    return fleet.vessels_by_flag(_fleet(spark, d))


@register("vessel_size_analysis")
def vessel_size_analysis(spark, d):
    return fleet.vessel_size_analysis(_fleet(spark, d))


@register("largest_vessels")
def largest_vessels(spark, d):
    return fleet.largest_vessels(_fleet(spark, d))


# ------------------------------------------------------------------ AIS and movements

# Fixed value: the example box used by the bbox query, in the fetchers'
# [[[min_lon, max_lon], [min_lat, max_lat]]] form.
BBOX_TEXT = "[[[-10.0, 20.0], [40.0, 60.0]]]"

DECODED_COLS = ["event_id", "message_type", "message_id", "mmsi", "ship_name", "latitude", "longitude",
                "time_utc", "speed_over_ground", "course_over_ground", "heading"]


def _decoded(spark, d):
    return ais.decode_ais(fx.ais_raw(spark, d))


def _positions(spark, d):
    return movement.positions(_decoded(spark, d))


@register("ais_decode")
def ais_decode(spark, d):
    return _decoded(spark, d).select(*DECODED_COLS)


@register("ais_positions")
def ais_positions(spark, d):
    return _positions(spark, d).select(*movement.POSITION_COLS)


@register("ais_repr_positions")
def ais_repr_positions(spark, d):
    return movement.store_positions(fx.ais_store(spark, d)).select(*movement.POSITION_COLS)


@register("recent_positions")
def recent_positions(spark, d):
    return movement.recent_positions(_positions(spark, d)).select(*movement.POSITION_COLS, "time_utc")


@register("bbox_filter")
def bbox_filter(spark, d):
    box = parse_bbox(BBOX_TEXT)
    return movement.bbox_positions(_positions(spark, d), box).select(*movement.POSITION_COLS)


@register("speed_stats")
def speed_stats(spark, d):
    return movement.speed_stats(_positions(spark, d))


@register("vessel_speed_patterns")
def vessel_speed_patterns(spark, d):
    return movement.vessel_speed_patterns(_positions(spark, d))


@register("navigation_hotspots")
def navigation_hotspots(spark, d):
    return movement.navigation_hotspots(_positions(spark, d))


@register("movement_status")
def movement_status(spark, d):
    return movement.movement_status(_positions(spark, d))


@register("message_type_counts")
def message_type_counts(spark, d):
    """Every good frame of the dirty feed, redelivered ones too, as the stream counts."""
    good, _ = ais.route_invalid(fx.ais_dirty(spark, d))
    return ais.type_counts(ais.decode_ais(good))


@register("ais_rejects")
def ais_rejects(spark, d):
    _, rejects = ais.route_invalid(fx.ais_dirty(spark, d))
    return rejects.select("event_id", "reason", "value")


@register("ais_dedup")
def ais_dedup(spark, d):
    good, _ = ais.route_invalid(fx.ais_dirty(spark, d))
    return ais.dedupe_messages(good).select("event_id", "message_type")


@register("sql_extractors")
def sql_extractors(spark, d):
    """X-1 ... X-3 as a SQL user calls them on the stored report text."""
    names = register_sql_functions(spark)
    return fx.ais_store(spark, d).selectExpr("event_id", *[f"{n}(position_report) as {n[len('extract_'):]}" for n in names])


# ------------------------------------------------------------------ safety and port visits

def _typed_ports(spark, d):
    return _port_stats(spark, d)


def _stays(spark, d):
    return visits.port_stays(_positions(spark, d), _typed_ports(spark, d))


@register("nearest_ports")
def nearest_ports(spark, d):
    near = safety.nearest_ports(_positions(spark, d), _typed_ports(spark, d))
    return near.select("event_id", "mmsi", "port_id", round_half_up("distance_km", 3).alias("distance_km"))


@register("forecast_at_positions")
def forecast_at_positions(spark, d):
    near = safety.nearest_ports(_positions(spark, d), _typed_ports(spark, d))
    known = safety.forecast_at(near, _forecast(spark, d))
    return known.select("event_id", "port_id", "ref_time", "forecast_timestamp", *safety.CONDITIONS)


@register("dangerous_positions")
def dangerous_positions(spark, d):
    return safety.dangerous_positions(_positions(spark, d), _typed_ports(spark, d), _forecast(spark, d))


@register("port_stays")
def port_stays(spark, d):
    return _stays(spark, d).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("arrival", "departure")})


@register("port_throughput")
def port_throughput(spark, d):
    return visits.port_throughput(_stays(spark, d))


@register("berth_demand")
def berth_demand(spark, d):
    return visits.berth_demand(_stays(spark, d), _typed_ports(spark, d))


@register("tide_at_arrival")
def tide_at_arrival(spark, d):
    return visits.tide_at_arrival(_stays(spark, d), _forecast(spark, d))


# ------------------------------------------------------------------ ingest transforms

FORECAST_KEY = ["id"]
FORECAST_ORDER = ["seq1", "seq2"]


@register("forecast_unnest")
def forecast_unnest(spark, d):
    return payloads.explode_forecast(fx.forecast_payloads(spark, d))


@register("forecast_upsert")
def forecast_upsert(spark, d):
    """Updates merged into a store that already holds rows: a third of the rows is
    in the store only, a third comes in anew (some of it older than what the store
    has under the key), and a third is in both."""
    rows = fx.forecast_raw(spark, d)
    return upsert(rows.filter("seq1 % 3 <> 1"), rows.filter("seq1 % 3 <= 1"), FORECAST_KEY, FORECAST_ORDER)


@register("forecast_rejects")
def forecast_rejects(spark, d):
    _documents, rejects = payloads.split_forecast(fx.forecast_texts(spark, d))
    return rejects.select("reason", "payload")


@register("rows_to_cells")
def rows_to_cells(spark, d):
    return fx.ports_cells(spark, d)


@register("cells_to_rows")
def cells_to_rows(spark, d):
    return cells.cells_to_rows(fx.ports_cells(spark, d), PORTS)


@register("registry_explode")
def registry_explode(spark, d):
    rows, _errors = payloads.explode_registry(fx.registry_payloads(spark, d), PORTS)
    return rows


# Fixed value: the load time of the registry snapshot query, epoch seconds.
FETCHED_AT = 1704067200

VESSEL_REGISTRY_COLS = ["mmsi", "ship_name", "ship_type", "flag", "length", "width", "draft", "beam", "imo", "status"]


@register("vessel_registry_explode")
def vessel_registry_explode(spark, d):
    rows, _errors = payloads.explode_registry(fx.vessel_registry_payloads(spark, d), VESSELS)
    return rows.select(*VESSEL_REGISTRY_COLS)


@register("registry_snapshot")
def registry_snapshot(spark, d):
    """P-12: fetch time and snapshot key on every row."""
    rows, _errors = payloads.explode_registry(fx.registry_payloads(spark, d), PORTS, fetched_at=FETCHED_AT)
    return rows


@register("registry_errors")
def registry_errors(spark, d):
    _rows, errors = payloads.explode_registry(fx.registry_failures(spark, d), PORTS)
    return errors.groupBy("reason", "error").agg(F.count("*").alias("responses"))


@register("current_weather_rows")
def current_weather_rows(spark, d):
    rows, _rejects = payloads.explode_current(fx.current_payloads(spark, d))
    return rows


@register("current_rejects")
def current_rejects(spark, d):
    _rows, rejects = payloads.explode_current(fx.current_payloads(spark, d))
    return rejects.select("reason", "payload")


# ------------------------------------------------------------------ profiles

@register("load_profile")
def load_profile(spark, d):
    return profiles.load_profile(
        forecast=_forecast(spark, d),
        ports=fx.ports_raw(spark, d),
        vessels=fx.vessels_raw(spark, d),
        decoded=_decoded(spark, d),
    )
