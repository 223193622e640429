"""Store catalogs: which column of a table lives in which (family, qualifier) cell.

A catalog is the whole schema system of the landed store: every cell is text,
the row key is one column, every other column maps to ``family:qualifier``.
The JSON form accepted by :meth:`Catalog.from_json` is the one the store
connector uses (``{"table":..., "rowkey": "id", "columns": {name: {"cf", "col",
"type"}}}``), so existing catalogs can be reused unchanged.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Catalog:
    table: str
    rowkey: str
    # column name -> (family, qualifier); the row key maps to ("rowkey", rowkey)
    columns: dict[str, tuple[str, str]] = field(default_factory=dict)
    # column name -> qualifiers some writers use instead, tried in order
    alternates: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @classmethod
    def from_json(cls, text: str) -> Catalog:
        spec = json.loads(text)
        cols = {name: (c["cf"], c["col"]) for name, c in spec["columns"].items()}
        return cls(spec["table"]["name"], spec["rowkey"], cols)

    @property
    def value_columns(self) -> list[str]:
        """Columns stored in cells (everything but the row key), in catalog order."""
        return [c for c, (fam, _) in self.columns.items() if fam != "rowkey"]

    def project(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Select the catalog's columns (or ``columns`` of them) from a flat frame,
        in catalog order.

        The store is sparse: a column the frame lacks is an absent cell, so it
        comes back as null text. Selecting only mapped columns is what prunes
        the scan down to the columns a report needs.
        """
        unknown = set(columns or ()) - set(self.columns)
        if unknown:
            raise ValueError(f"{self.table} maps no {sorted(unknown)}")
        present = set(df.columns)

        def value(c: str) -> Column:
            held = [F.col(n) for n in (c, *self.alternates.get(c, ())) if n in present]
            return (F.coalesce(*held) if len(held) > 1 else held[0] if held else F.lit(None).cast("string")).alias(c)

        return df.select(*[value(c) for c in self.columns if columns is None or c in columns])


def scan(
    spark: SparkSession, catalog: Catalog, path: str, fmt: str = "parquet", columns: Sequence[str] | None = None
) -> DataFrame:
    """Read a flat landed table and return the catalog's text columns, or those
    of ``columns``; no other column is read."""
    return catalog.project(spark.read.format(fmt).load(path), columns)


# The column -> (family, qualifier) maps of the store tables.
PORTS = Catalog(
    "ports_info",
    "id",
    {
        "id": ("rowkey", "id"),
        "port_id": ("info", "port_id"),
        "port_name": ("info", "name"),
        "country": ("info", "country"),
        "berths": ("info", "berths"),
        "un_locode": ("info", "un_locode"),
        "latitude": ("info", "lat"),
        "longitude": ("info", "long"),
        "timestamp": ("meta_data", "timestamp"),
    },
    # the weather fetchers read the port's name from info:port_name
    alternates={"port_name": ("name", "port_name")},
)

VESSELS = Catalog(
    "vessel_info",
    "id",
    {
        "id": ("rowkey", "id"),
        "mmsi": ("info", "mmsi"),
        "ship_name": ("info", "name"),
        "call_sign": ("info", "call_sign"),
        "ship_type": ("info", "type"),
        "flag": ("info", "flag"),
        # AIS dimension cells a, b, c, d are published under these names
        "length": ("info", "a"),
        "width": ("info", "b"),
        "draft": ("info", "c"),
        "beam": ("info", "d"),
        "imo": ("info", "imo"),
        "status": ("info", "status"),
        "destination": ("info", "dest"),
        "eta": ("info", "eta"),
        "latitude": ("info", "lat"),
        "longitude": ("info", "lng"),
        "speed_over_ground": ("info", "sog"),
        "course_over_ground": ("info", "cog"),
        "heading": ("info", "hdt"),
        "rate_of_turn": ("info", "rot"),
        "timestamp": ("meta_data", "timestamp"),
    },
)

AIS_MESSAGES = Catalog(
    "ais_messages",
    "id",
    {
        "id": ("rowkey", "id"),
        "mmsi": ("meta_data", "MMSI"),
        "ship_name": ("meta_data", "ShipName"),
        "latitude": ("meta_data", "latitude"),
        "longitude": ("meta_data", "longitude"),
        "message_type": ("meta_data", "message_type"),
        "time_utc": ("meta_data", "time_utc"),
        "position_report": ("message", "PositionReport"),
    },
)

# The hourly marine variables the forecast and current-weather
# feeds deliver, in feed order.
WEATHER_FIELDS = (
    "wave_height", "wave_direction", "wave_period", "wave_peak_period",
    "wind_wave_height", "wind_wave_direction", "wind_wave_period", "wind_wave_peak_period",
    "swell_wave_height", "swell_wave_direction", "swell_wave_period", "swell_wave_peak_period",
    "secondary_swell_wave_height", "secondary_swell_wave_period", "secondary_swell_wave_direction",
    "tertiary_swell_wave_height", "tertiary_swell_wave_period", "tertiary_swell_wave_direction",
    "sea_level_height_msl", "sea_surface_temperature", "ocean_current_velocity", "ocean_current_direction",
)

# The weather columns the analysis catalog maps.
FORECAST_ANALYSIS_FIELDS = (
    "wave_height", "wave_direction", "wave_period", "wind_wave_height", "wind_wave_direction",
    "wind_wave_period", "swell_wave_height", "swell_wave_direction", "swell_wave_period",
    "sea_surface_temperature", "sea_level_height_msl", "ocean_current_velocity",
    "ocean_current_direction",
)

FORECAST = Catalog(
    "port_weather_forecast",
    "id",
    {
        "id": ("rowkey", "id"),
        "port_id": ("meta_data", "port_id"),
        "latitude": ("meta_data", "lat"),
        "longitude": ("meta_data", "long"),
        "forecast_timestamp": ("meta_data", "forecast_timestamp"),
        "ref_time": ("meta_data", "ref_time"),
        **{f: ("weather_data", f) for f in FORECAST_ANALYSIS_FIELDS},
    },
)

CURRENT_WEATHER = Catalog(
    "port_weather",
    "id",
    {
        "id": ("rowkey", "id"),
        "port_id": ("meta_data", "port_id"),
        "port_name": ("meta_data", "port_name"),
        "latitude": ("meta_data", "lat"),
        "longitude": ("meta_data", "long"),
        "timestamp": ("meta_data", "timestamp"),
        **{f: ("weather_data", f) for f in WEATHER_FIELDS},
    },
)
