"""Port registry and vessel fleet reports (A-1 ... A-7, largest vessels).

The registry reports clear only the exact sentinel ``"nan"`` (the reference's
own list), so a ``"None"`` country or flag stays a group of its own. One row per
port / vessel is the newest snapshot by numeric timestamp (latest_by_key), not
an arbitrary survivor. Group counts are hash aggregates with a partial step on
the map side, so a hot country, type or flag is pre-reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.clean import REGISTRY_SENTINELS, null_sentinels, round_half_up, to_number
from tidewater.functions.geo import latitude_region
from tidewater.operators.dedup import latest_by_key
from tidewater.sources.catalog import PORTS, VESSELS

_TS = "__ts"

# The registry columns that the fleet report reads.
FLEET_COLUMNS = (
    "mmsi", "ship_name", "ship_type", "flag", "length", "width", "draft", "beam", "imo", "status", "timestamp",
)


def r2(c):
    return round_half_up(c, 2)


def port_statistics(ports_raw: DataFrame, sentinels=REGISTRY_SENTINELS) -> DataFrame:
    """A-1: one cleaned, typed row per port (newest snapshot)."""
    ports = null_sentinels(PORTS.project(ports_raw, PORTS.value_columns), sentinels)
    typed = ports.select(
        "port_id", "port_name", "country", "berths", "un_locode",
        to_number("latitude"), to_number("longitude"),
        to_number("timestamp", "bigint").alias(_TS),
    )
    return latest_by_key(typed, ["port_id"], [_TS]).drop(_TS)


def ports_by_country(stats: DataFrame) -> DataFrame:
    """A-2: ports per country."""
    return (
        stats.groupBy("country")
        .agg(F.count("port_id").alias("port_count"))
        .orderBy(F.desc("port_count"), "country")
    )


def regional_ports(stats: DataFrame) -> DataFrame:
    """A-3: ports per latitude band with mean coordinates."""
    return (
        stats.groupBy(latitude_region("latitude").alias("region"))
        .agg(
            F.count("port_id").alias("port_count"),
            r2(F.avg("latitude")).alias("avg_latitude"),
            r2(F.avg("longitude")).alias("avg_longitude"),
        )
        .orderBy(F.desc("port_count"), "region")
    )


def vessel_fleet(vessels_raw: DataFrame, sentinels=REGISTRY_SENTINELS) -> DataFrame:
    """A-4: one cleaned, typed row per vessel (newest snapshot). ``length``,
    ``width``, ``draft``, ``beam`` are the AIS dimension cells a, b, c, d."""
    vessels = null_sentinels(VESSELS.project(vessels_raw, FLEET_COLUMNS), sentinels)
    typed = vessels.select(
        "mmsi", "ship_name", "ship_type", "flag",
        to_number("length"), to_number("width"), to_number("draft"), to_number("beam"),
        "imo", "status",
        to_number("timestamp", "bigint").alias(_TS),
    )
    return latest_by_key(typed, ["mmsi"], [_TS]).drop(_TS)


def vessels_by_type(fleet: DataFrame) -> DataFrame:
    """A-5."""
    return (
        fleet.groupBy("ship_type")
        .agg(F.count("mmsi").alias("vessel_count"))
        .orderBy(F.desc("vessel_count"), "ship_type")
    )


def vessels_by_flag(fleet: DataFrame) -> DataFrame:
    """A-6."""
    return (
        fleet.groupBy("flag")
        .agg(F.count("mmsi").alias("vessel_count"))
        .orderBy(F.desc("vessel_count"), "flag")
    )


def vessel_size_analysis(fleet: DataFrame) -> DataFrame:
    """A-7: size statistics per ship type over vessels with length and beam (F-5)."""
    return (
        fleet.filter(F.col("length").isNotNull() & F.col("beam").isNotNull())
        .groupBy("ship_type")
        .agg(
            r2(F.avg("length")).alias("avg_length"),
            r2(F.max("length")).alias("max_length"),
            r2(F.avg("beam")).alias("avg_beam"),
            r2(F.avg("draft")).alias("avg_draft"),
            F.count("*").alias("vessel_count"),
        )
        .orderBy(F.desc("vessel_count"), "ship_type")
    )


def largest_vessels(fleet: DataFrame, k: int = 10) -> DataFrame:
    """Top-k by length (F-6, O-2). A distributed top-k (each partition keeps its
    k best, then one merge of at most k x partitions rows); ``imo`` breaks ties
    so the k rows are repeatable."""
    return (
        fleet.filter(F.col("length").isNotNull())
        .select("ship_name", "ship_type", "flag", "status", "imo", "length", "beam")
        .orderBy(F.desc("length"), "imo")
        .limit(k)
    )
