"""Weather reports over the port forecast store (A-12 ... A-18, F-1, J-1 ... J-3).

Plan shape shared by the per-port reports: filter to the newest run (scalar
subquery), aggregate per ``port_id`` on the forecast (hash aggregate, partial on
the map side, so a port holding a third of all rows is pre-reduced before the
shuffle), and only then join the port attributes onto the per-port result.
Port attributes come from the latest registry snapshot, one row per port, so
``port_name`` / ``country`` are functions of ``port_id`` and grouping before the
join gives the same groups as the reference's join-then-group, while the join
inputs shrink from forecast rows to ports. Row-level reports (storms, wave
comparison) join per row; Spark broadcasts the ports side only while its size is
under the session's broadcast threshold, else shuffles with skew splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.clean import (
    WEATHER_SENTINELS,
    epoch_to_time,
    null_sentinels,
    round_half_up,
    to_number,
)
from tidewater.operators.dedup import latest_by_key
from tidewater.operators.filters import latest_run
from tidewater.sources.catalog import FORECAST, PORTS, WEATHER_FIELDS

_TIME_COLS = ("ref_time", "forecast_timestamp", "timestamp")
_NUMERIC = set(WEATHER_FIELDS)

# Report thresholds (all comparisons strict).
STORM_WAVE_M = 3.0
HAZARD_WAVE_M = 4.0
HAZARD_CURRENT = 1.5
HAZARD_TEMP_LOW = 0.0
HAZARD_TEMP_HIGH = 35.0


def r2(c):
    return round_half_up(c, 2)


# ---------------------------------------------------------------- inputs

def forecast_scan(forecast_raw: DataFrame) -> DataFrame:
    """The forecast store as the analysis catalog sees it (absent cells null)."""
    return FORECAST.project(forecast_raw)


def clean_forecast_text(forecast: DataFrame) -> DataFrame:
    """Sentinel cleaning on the text (P-1), before any cast."""
    return null_sentinels(forecast, WEATHER_SENTINELS)


def type_forecast(clean: DataFrame) -> DataFrame:
    """Text -> numbers (P-2): epoch columns to bigint, weather fields to double.
    Coordinates stay text: the port summary groups by them as stored."""
    return clean.select(
        *[
            to_number(c, "bigint") if c in _TIME_COLS else to_number(c) if c in _NUMERIC else F.col(c)
            for c in clean.columns
        ]
    )


def prepare_forecast(forecast_raw: DataFrame) -> DataFrame:
    return type_forecast(clean_forecast_text(forecast_scan(forecast_raw)))


def ports_scan(ports_raw: DataFrame) -> DataFrame:
    """The port registry as its catalog sees it (S-3), without the row key."""
    return PORTS.project(ports_raw, PORTS.value_columns)


def latest_ports(ports_raw: DataFrame, sentinels=()) -> DataFrame:
    """One registry row per port: the newest snapshot by numeric timestamp (F-2,
    U-1), optionally after sentinel cleaning."""
    ports = ports_scan(ports_raw)
    ports = null_sentinels(ports, sentinels) if sentinels else ports
    return latest_by_key(ports, ["port_id"], [to_number("timestamp", "bigint")])


def _port_names(ports: DataFrame) -> DataFrame:
    return ports.select("port_id", "port_name")


# ---------------------------------------------------------------- reports

def weather_port_summary(forecast: DataFrame, ports: DataFrame, circular: bool = False) -> DataFrame:
    """A-12: per port and stored coordinates, 13 rounded measures + row count.
    ``circular=True`` adds circular means of the two direction columns
    (``circ_wind_direction``, ``circ_current_direction``) next to the
    reference's arithmetic ones."""
    extra = []
    if circular:
        extra = [
            F.pmod(r2(circular_mean_deg(F.col(c))), F.lit(360.0)).alias(name)
            for c, name in (("wind_wave_direction", "circ_wind_direction"),
                            ("ocean_current_direction", "circ_current_direction"))
        ]
    per_port = (
        latest_run(forecast)
        .groupBy("port_id", "latitude", "longitude")
        .agg(
            r2(F.avg("wave_height")).alias("avg_wave_height"),
            r2(F.max("wave_height")).alias("max_wave_height"),
            r2(F.avg("wave_period")).alias("avg_wave_period"),
            r2(F.avg("wind_wave_height")).alias("avg_wind_wave_height"),
            # arithmetic mean of directions, as in the reference (350 and 10 give 180)
            r2(F.avg("wind_wave_direction")).alias("avg_wind_direction"),
            r2(F.avg("swell_wave_height")).alias("avg_swell_wave_height"),
            r2(F.avg("swell_wave_period")).alias("avg_swell_period"),
            r2(F.avg("sea_surface_temperature")).alias("avg_temperature"),
            r2(F.min("sea_surface_temperature")).alias("min_temperature"),
            r2(F.max("sea_surface_temperature")).alias("max_temperature"),
            r2(F.avg("sea_level_height_msl")).alias("avg_sea_level"),
            r2(F.avg("ocean_current_velocity")).alias("avg_current_velocity"),
            r2(F.avg("ocean_current_direction")).alias("avg_current_direction"),
            F.count("*").alias("forecast_records"),
            *extra,
        )
    )
    out = per_port.join(_port_names(ports), "port_id", "left")
    cols = ["port_id", "port_name", "latitude", "longitude"] + [
        c for c in per_port.columns if c not in ("port_id", "latitude", "longitude")
    ]
    return out.select(*cols).orderBy(F.desc("avg_wave_height"), "port_id", "latitude", "longitude")


def circular_mean_deg(c) -> F.Column:
    """Extra: mean direction on the circle (350 and 10 give 0), in [0, 360)."""
    rad = F.radians(c)
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(rad)), F.avg(F.cos(rad)))), F.lit(360.0))


def storm_detection(forecast: DataFrame, ports: DataFrame, threshold: float = STORM_WAVE_M) -> DataFrame:
    """A-13: newest-run rows with wave height above the threshold (F-7, P-5). A
    row-level report that grows with the data: rows are sorted within partitions
    (O-1), so files are ordered inside; order globally only for a preview."""
    storms = latest_run(forecast).filter(F.col("wave_height") > threshold)  # null fails the test
    rows = storms.select(
        "port_id",
        r2("wave_height").alias("wave_height"),
        r2("swell_wave_height").alias("swell_height"),
        epoch_to_time("forecast_timestamp").alias("forecast_time"),
    )
    out = rows.join(_port_names(ports), "port_id", "left")
    return out.select("port_id", "port_name", "wave_height", "swell_height", "forecast_time").sortWithinPartitions(
        F.desc("wave_height"), "port_id", "forecast_time"
    )


def temperature_analysis(forecast: DataFrame, ports: DataFrame) -> DataFrame:
    """A-14: sea-surface temperature mean, sample stddev, range per port (F-9)."""
    sst = "sea_surface_temperature"
    per_port = (
        latest_run(forecast)
        .groupBy("port_id")
        .agg(
            r2(F.avg(sst)).alias("avg_temp"),
            r2(F.stddev_samp(sst)).alias("temp_stddev"),
            r2(F.min(sst)).alias("min_temp"),
            r2(F.max(sst)).alias("max_temp"),
        )
        .filter(F.col("avg_temp").isNotNull())
    )
    out = per_port.join(_port_names(ports), "port_id", "left")
    return out.select("port_id", "port_name", "avg_temp", "temp_stddev", "min_temp", "max_temp").orderBy(
        "avg_temp", "port_id"
    )


def current_analysis(forecast: DataFrame, ports: DataFrame) -> DataFrame:
    """A-15: ocean current velocity statistics per port (F-9)."""
    v = "ocean_current_velocity"
    per_port = (
        latest_run(forecast)
        .groupBy("port_id")
        .agg(
            r2(F.avg(v)).alias("avg_current_velocity"),
            r2(F.max(v)).alias("max_current_velocity"),
            r2(F.stddev_samp(v)).alias("current_stddev"),
            F.count("*").alias("measurements"),
        )
        .filter(F.col("avg_current_velocity").isNotNull())
    )
    out = per_port.join(_port_names(ports), "port_id", "left")
    return out.select(
        "port_id", "port_name", "avg_current_velocity", "max_current_velocity", "current_stddev", "measurements"
    ).orderBy(F.desc("avg_current_velocity"), "port_id")


def wave_comparison(forecast: DataFrame, ports: DataFrame) -> DataFrame:
    """A-16: total vs wind vs swell wave height per newest-run row (F-11)."""
    rows = latest_run(forecast).select(
        "port_id",
        r2("wave_height").alias("total_waves"),
        r2("wind_wave_height").alias("wind_waves"),
        r2("swell_wave_height").alias("swell_waves"),
    ).filter(F.col("total_waves").isNotNull())
    out = rows.join(_port_names(ports), "port_id", "left")
    return out.select("port_id", "port_name", "total_waves", "wind_waves", "swell_waves")


def hazard_condition(
    wave: float = HAZARD_WAVE_M,
    current: float = HAZARD_CURRENT,
    temp_low: float = HAZARD_TEMP_LOW,
    temp_high: float = HAZARD_TEMP_HIGH,
):
    """F-8: any of four strict threshold tests. A null reading fails its test:
    in a filter an unknown comparison counts as false, so the reference's
    explicit not-null guards are implied. Each column is referenced as few
    times as possible because a pushed-down filter re-derives every reference."""
    w, c, t = F.col("wave_height"), F.col("ocean_current_velocity"), F.col("sea_surface_temperature")
    return (w > wave) | (c > current) | (t < temp_low) | (t > temp_high)


def hazardous_ports(forecast: DataFrame, ports: DataFrame, **thresholds) -> DataFrame:
    """A-17: per port, number of hazardous newest-run rows and their maxima."""
    per_port = (
        latest_run(forecast)
        .filter(hazard_condition(**thresholds))
        .groupBy("port_id")
        .agg(
            F.count("*").alias("hazard_count"),
            r2(F.max("wave_height")).alias("max_wave_height"),
            r2(F.max("ocean_current_velocity")).alias("max_current_velocity"),
        )
    )
    out = per_port.join(_port_names(ports), "port_id", "left")
    return out.select("port_id", "port_name", "hazard_count", "max_wave_height", "max_current_velocity").orderBy(
        F.desc("hazard_count"), "port_id"
    )


def regional_weather_comparison(forecast: DataFrame, ports_clean: DataFrame) -> DataFrame:
    """A-18: averages per country (F-10, J-3).

    Two-level aggregation: exact sums and counts per port on the forecast, then
    the (cleaned, latest) registry adds the country, then sums per country. The
    mean is sum/count of the same values the reference averages.
    """
    measures = {
        "avg_wave_height": "wave_height",
        "avg_temperature": "sea_surface_temperature",
        "avg_current": "ocean_current_velocity",
    }
    partial = []
    for name, col in measures.items():
        partial += [F.sum(col).alias(f"__s_{name}"), F.count(col).alias(f"__c_{name}")]
    per_port = latest_run(forecast).groupBy("port_id").agg(*partial, F.count("*").alias("__n"))
    with_country = per_port.join(ports_clean.select("port_id", "country"), "port_id", "left")
    by_country = with_country.groupBy("country").agg(
        *[r2(F.try_divide(F.sum(f"__s_{n}"), F.sum(f"__c_{n}"))).alias(n) for n in measures],
        F.sum("__n").alias("total_measurements"),
    )
    keep = F.col("country").isNotNull() & (
        F.col("avg_wave_height").isNotNull() | F.col("avg_temperature").isNotNull() | F.col("avg_current").isNotNull()
    )
    return by_country.filter(keep).orderBy(F.desc("avg_wave_height"), "country")


def latest_run_text(clean_text: DataFrame) -> DataFrame:
    """The newest run of a cleaned, still untyped forecast (F-1)."""
    run = to_number("ref_time", "bigint").alias("__run")
    return latest_run(clean_text.select("*", run), "__run").drop("__run")


def null_profile(clean_text: DataFrame, ports: DataFrame) -> DataFrame:
    """A-19: null count of every column of the cleaned newest-run frame with the
    joined ``port_name``, in one pass.

    Nulls are counted per port on the forecast first; the port-name side is
    then a per-port join (a port without a registry row contributes all its rows
    to ``port_name``'s count).
    """
    newest = latest_run_text(clean_text)
    cols = [c for c in newest.columns if c != "port_id"]
    per_port = newest.groupBy("port_id").agg(
        F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    )
    joined = per_port.join(_port_names(ports), "port_id", "left")

    def rows_where_null(c):
        return F.sum(F.when(F.col(c).isNull(), F.col("__n")).otherwise(F.lit(0))).cast("bigint")

    totals = joined.agg(
        *[
            rows_where_null(c).alias(c) if c == "port_id" else F.sum(c).cast("bigint").alias(c)
            for c in newest.columns
        ],
        rows_where_null("port_name").alias("port_name"),
    )
    return totals.unpivot([], totals.columns, "column_name", "null_count")
