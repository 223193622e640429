"""Geographic and banding expressions: bounding boxes, grid cells, regions, speed classes."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.clean import round_half_up

# Latitude bands of the ports report, checked top-down with a
# strict ">" (so exactly 60 is Central Europe, exactly 40 is Other).
LATITUDE_BANDS = ((60, "Northern Europe"), (50, "Central Europe"), (40, "Mediterranean"))
LATITUDE_OTHER = "Other"

# Speed-over-ground classes (knots) of the movement report,
# checked bottom-up with a strict "<". A null or NaN speed fails every test and
# lands in the last class, as in the reference.
SPEED_BANDS = ((0.5, "Anchored/Stationary"), (5, "Slow Moving"), (15, "Normal Transit"))
SPEED_OTHER = "High Speed"


@dataclass(frozen=True)
class BBox:
    min_lon: float
    max_lon: float
    min_lat: float
    max_lat: float


def parse_bbox(text: str) -> BBox:
    """Read a box from configuration text: one box, as a longitude range and a
    latitude range, ``[[[min_lon, max_lon], [min_lat, max_lat]]]``.

    Runs once on the driver over a setting, not over data. A text that is no box
    raises ``ValueError`` and says what is wrong with it."""
    try:
        boxes = json.loads(text)
    except json.JSONDecodeError as exc:
        raise ValueError(f"the box is not JSON: {exc}") from exc
    ranges = boxes[0] if isinstance(boxes, list) and len(boxes) == 1 else None
    if not (isinstance(ranges, list) and len(ranges) == 2 and all(isinstance(r, list) and len(r) == 2 for r in ranges)):
        raise ValueError("the box must be one list of a longitude range and a latitude range")
    for name, limit, pair in zip(("longitude", "latitude"), (180.0, 90.0), ranges, strict=True):
        if not all(isinstance(v, int | float) and not isinstance(v, bool) and math.isfinite(v) for v in pair):
            raise ValueError(f"{name} bounds must be finite numbers, not {pair}")
        if pair[0] > pair[1]:
            raise ValueError(f"{name} range {pair} runs backwards")
        if max(map(abs, pair)) > limit:
            raise ValueError(f"{name} range {pair} leaves [-{limit:g}, {limit:g}]")
    lon, lat = ranges
    return BBox(float(lon[0]), float(lon[1]), float(lat[0]), float(lat[1]))


def within_bbox(df: DataFrame, box: BBox, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows inside the box, edges included. Plain range predicates, so Parquet
    min/max statistics can skip row groups when the columns are stored typed."""
    return df.filter(
        F.col(lat).between(box.min_lat, box.max_lat) & F.col(lon).between(box.min_lon, box.max_lon)
    )


def grid_cell(c: str | Column, digits: int = 1) -> Column:
    """Coordinate rounded to a grid of ``10**-digits`` degrees."""
    return round_half_up(c, digits)


def _band(c: Column, bands: Sequence[tuple[float, str]], other: str, greater: bool) -> Column:
    expr = None
    for bound, label in bands:
        test = c > bound if greater else c < bound
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    return expr.otherwise(other)


def latitude_region(c: str | Column, bands=LATITUDE_BANDS, other: str = LATITUDE_OTHER) -> Column:
    return _band(F.col(c) if isinstance(c, str) else c, bands, other, greater=True)


def movement_class(c: str | Column, bands=SPEED_BANDS, other: str = SPEED_OTHER) -> Column:
    return _band(F.col(c) if isinstance(c, str) else c, bands, other, greater=False)
