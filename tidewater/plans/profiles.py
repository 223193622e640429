"""Row counts at each stage of the jobs (A-20).

The reference prints a ``count()`` per stage, each a separate job that rescans
the store. Here each input is scanned once and all of its stage counts are
conditional counts in that single aggregate; the stages are then stacked into
``(stage, row_count)`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.profile import stage_counts


def load_profile(forecast: DataFrame, ports: DataFrame, vessels: DataFrame, decoded: DataFrame) -> DataFrame:
    newest_run = forecast.agg(F.max("ref_time")).scalar()
    position = F.col("message_type") == "PositionReport"
    moving = F.coalesce("speed_over_ground", "course_over_ground", "heading").isNotNull()
    parts = [
        stage_counts(
            forecast,
            {"forecast_loaded": F.count("*"), "forecast_latest_run": F.count_if(F.col("ref_time") == newest_run)},
        ),
        stage_counts(ports, {"ports_loaded": F.count("*"), "ports_unique": F.count_distinct("port_id")}),
        stage_counts(vessels, {"vessels_loaded": F.count("*"), "vessels_unique": F.count_distinct("mmsi")}),
        stage_counts(
            decoded,
            {
                "ais_loaded": F.count("*"),
                "ais_position_reports": F.count_if(position),
                "ais_valid_movements": F.count_if(position & moving),
            },
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
