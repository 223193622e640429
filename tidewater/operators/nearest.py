"""Nearest place on the sphere within a radius, by grid cells in widening rings.

Places are spread over every cell that the circle of a ring's radius around them
touches; a point looks into its own cell alone, so the join is an equality on the
cell. Cells are bands of latitude as high as the radius, cut into as many cells of
longitude as keep a circle within a few of them, fewer towards the poles; circles
wrap at the date line, and one that holds a pole covers its bands whole. A cell
therefore holds every place within the ring's radius of any of its points: the
least great-circle distance found, if it is within that radius, is the least there
is. Points without a place so near go on to the next, wider ring.

Points are looked up once per distinct coordinate. The candidates of a point meet
in one task of the cell join and are reduced before they are shuffled. Both sides
of that join come straight from a shuffle, so adaptive execution splits a cell that
holds very many points. Points and coordinates grow with the positions, and their
size as planned is that of compressed files: joins of them are merge joins, never
broadcast.

Defined results. Null or non-finite coordinates, and latitudes beyond the poles,
have no nearest place; longitudes count modulo 360. Places like that are never
found. Distances are compared in whole millimetres; of equally near places the
least id is taken. No places: every result is null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.cut import cut

#: Mean radius of the earth, km.
EARTH_KM = 6371.0088
#: Each ring's radius is this many times the one before.
WIDEN = 4.0
#: Radius of the first ring, km.
FIRST_KM = 10.0
#: Circles are drawn this much wider, so that rounding loses no place.
MARGIN = 1.000001


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the haversine formula, to the millimetre."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0))
    b = F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    h = a + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * b
    return F.round(2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), h))), 6)


def _on_sphere(lat: Column, lon: Column) -> Column:
    """Finite coordinates between the poles."""
    sound = lat.between(-90.0, 90.0) & (F.abs(lon) < float("inf"))  # NaN exceeds every bound
    return F.coalesce(sound, F.lit(False))


def _east(lon: Column) -> Column:
    """Degrees east of the date line, in [0, 360)."""
    return F.pmod(lon + 180.0, F.lit(360.0))


def _bands(km: float) -> int:
    return max(1, math.floor(180.0 / math.degrees(km * MARGIN / EARTH_KM)))


def _band(lat: Column, bands: int) -> Column:
    return F.least(F.floor((lat + 90.0) * (bands / 180.0)), F.lit(bands - 1)).cast("int")


def _cells(band: Column, km: float, bands: int) -> Column:
    """Cells of a band: as wide as a circle at its edge nearest a pole, one there."""
    height = 180.0 / bands
    edge = F.least(F.lit(90.0), F.greatest(F.abs(band * height - 90.0), F.abs((band + 1) * height - 90.0)))
    return F.greatest(F.lit(1), F.floor(F.cos(F.radians(edge)) * (180.0 / math.degrees(km * MARGIN / EARTH_KM)))).cast("int")


def _cover(places: DataFrame, km: float) -> DataFrame:
    """``places`` (id, lat, lon) in every cell that their circle touches."""
    bands, angle = _bands(km), km * MARGIN / EARTH_KM
    reach = math.degrees(angle)
    low, high = (F.greatest(F.lit(0), _band(F.greatest(F.lit(-90.0), F.col("lat") - reach), bands)), _band(F.least(F.lit(90.0), F.col("lat") + reach), bands))
    c = places.select("*", F.explode(F.sequence(low, high)).alias("band"))
    # The circle's greatest extent in longitude; without bound where it holds a pole.
    wide = F.when(F.abs(F.col("lat")) + reach < 90.0, F.degrees(F.asin(F.lit(math.sin(angle)) / F.cos(F.radians("lat"))))).otherwise(360.0)
    c = c.withColumns({"n": _cells(F.col("band"), km, bands), "wide": wide * MARGIN})
    east = _east(F.col("lon"))
    first, last = (F.floor((east + side * F.col("wide")) * F.col("n") / 360.0).cast("int") for side in (-1, 1))
    whole = last - first + 1 >= F.col("n")
    cells = F.sequence(F.when(whole, 0).otherwise(first), F.when(whole, F.col("n") - 1).otherwise(last))
    return c.select("id", "lat", "lon", "band", F.explode(F.transform(cells, lambda x: F.pmod(x, F.col("n")))).alias("cell"))


def _within(points: DataFrame, places: DataFrame, km: float) -> DataFrame:
    """(lat, lon, best) of the points with a place within ``km``."""
    bands = _bands(km)
    band = _band(F.col("lat"), bands)
    p = points.withColumn("band", band)
    n = _cells(F.col("band"), km, bands)
    p = p.withColumn("cell", F.least(F.floor(_east(F.col("lon")) * n / 360.0).cast("int"), n - 1))
    c = _cover(places, km).select("band", "cell", F.col("id").alias("place"), F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    both = p.hint("merge").join(c, ["band", "cell"]).withColumn("km", great_circle_km(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon")))
    near = both.filter(F.col("km") <= km)
    return near.groupBy("lat", "lon").agg(F.min(F.struct("km", "place")).alias("best"))


def rings(radius_km: float, first_km: float = FIRST_KM, widen: float = WIDEN) -> list[float]:
    out = [min(first_km, radius_km)]
    while out[-1] < radius_km:
        out.append(min(out[-1] * widen, radius_km))
    return out


def nearest_place(
    points: DataFrame, places: DataFrame, radius_km: float, place_id: str, lat: str = "latitude", lon: str = "longitude",
    first_km: float = FIRST_KM, out_id: str | None = None, out_km: str = "distance_km",
) -> DataFrame:
    """``points`` with the id of the nearest of ``places`` (columns ``place_id``,
    ``lat``, ``lon``) within ``radius_km`` and its distance, null where none is."""
    if not 0 < radius_km < math.pi * EARTH_KM / 2:
        raise ValueError("the radius must be positive and less than a quarter of the earth's girth")
    a, b = F.col(lat).cast("double"), F.col(lon).cast("double")
    at = places.select(F.col(place_id).alias("id"), a.alias("lat"), b.alias("lon")).filter(_on_sphere(F.col("lat"), F.col("lon")) & F.col("id").isNotNull())
    at = cut(at, "places")
    todo = cut(points.select(a.alias("lat"), b.alias("lon")).filter(_on_sphere(F.col("lat"), F.col("lon"))).distinct(), "points")
    found = None
    for km in rings(radius_km, first_km):
        hits = _within(todo, at, km)
        hits = cut(hits, "within-ring") if km < radius_km else hits
        found = hits if found is None else found.unionByName(hits)
        todo = todo.hint("merge").join(hits.select("lat", "lon"), ["lat", "lon"], "left_anti")
    found = found.select(F.col("lat").alias("__lat"), F.col("lon").alias("__lon"), F.col("best.place").alias(out_id or place_id), F.col("best.km").alias(out_km))
    return points.hint("merge").join(found, (a == F.col("__lat")) & (b == F.col("__lon")), "left").drop("__lat", "__lon")
