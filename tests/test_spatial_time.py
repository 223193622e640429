"""Nearest places and as-of joins against brute force."""

import datetime
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidewater.operators.asof import asof_join, last_known
from tidewater.operators.nearest import EARTH_KM, nearest_place, rings

PLACE = "port_id string, latitude double, longitude double"
POINT = "k long, latitude double, longitude double"


def _km(a, b, c, d):
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return round(2 * EARTH_KM * math.asin(math.sqrt(min(1.0, h))), 6)


def _good(lat, lon):
    return lat is not None and lon is not None and math.isfinite(lat) and math.isfinite(lon) and abs(lat) <= 90


def _brute(points, places, radius):
    out = {}
    for k, lat, lon in points:
        near = [(_km(lat, lon, a, b), p) for p, a, b in places if p is not None and _good(a, b)] if _good(lat, lon) else []
        km, p = min(near, default=(math.inf, None))
        out[k] = (p, km) if km <= radius else (None, None)
    return out


def _world(seed, n, places):
    rng = random.Random(seed)

    def spot():
        kind = rng.random()
        if kind < 0.2:
            return rng.uniform(87, 90) * rng.choice([-1, 1]), rng.uniform(-180, 180)
        if kind < 0.4:
            return rng.uniform(-60, 60), rng.choice([-180, 180]) + rng.uniform(-3, 3)
        if kind < 0.7:
            return 45 + rng.gauss(0, 0.3), 10 + rng.gauss(0, 0.3)
        return rng.uniform(-90, 90), rng.uniform(-180, 180)

    ports = [(f"P{i}", *spot()) for i in range(places)]
    ports += [("P-twin", ports[0][1], ports[0][2]), ("A-twin", ports[0][1], ports[0][2]), ("pole", 90.0, 77.0), ("south", -90.0, 0.0), ("null", None, 1.0), (None, 45.0, 10.0), ("far", 95.0, 0.0)]
    points = [(i, *spot()) for i in range(n)] + [(n, ports[0][1], ports[0][2]), (n + 1, 89.99, -100.0), (n + 2, -89.5, 179.9), (n + 3, 0.0, 540.0)]
    points += [(n + 4, None, 0.0), (n + 5, float("nan"), 0.0), (n + 6, 0.0, float("inf")), (n + 7, 91.0, 0.0), (n + 8, 44.0, 10.0), (n + 9, 44.0, 10.0)]
    return points, ports


@pytest.mark.parametrize("radius", [3.0, 60.0, 700.0, 4000.0])
def test_nearest_place_equals_brute_force(spark, radius):
    points, ports = _world(int(radius), 400, 120)
    got = nearest_place(spark.createDataFrame(points, POINT), spark.createDataFrame(ports, PLACE), radius, "port_id")
    assert got.columns == ["k", "latitude", "longitude", "port_id", "distance_km"]
    rows = got.collect()
    want = _brute(points, ports, radius)
    assert len(rows) == len(points)
    for r in rows:
        p, km = want[r["k"]]
        assert r["port_id"] == p and (km is None) == (r["distance_km"] is None), (r, p, km)
        assert km is None or abs(r["distance_km"] - km) < 1e-5


def test_nearest_place_without_places_or_points(spark):
    points, ports = _world(1, 5, 3)
    none = nearest_place(spark.createDataFrame(points, POINT), spark.createDataFrame([], PLACE), 50, "port_id")
    assert {r["port_id"] for r in none.collect()} == {None} and none.count() == len(points)
    assert nearest_place(spark.createDataFrame([], POINT), spark.createDataFrame(ports, PLACE), 50, "port_id").count() == 0
    with pytest.raises(ValueError):
        nearest_place(spark.createDataFrame(points, POINT), spark.createDataFrame(ports, PLACE), 0, "port_id")
    assert rings(100) == [10, 40, 100] and rings(5) == [5]


def test_a_crowded_cell_is_split(spark):
    """A third of all points in one cell: no cross join, and its partition is dealt anew."""
    points = spark.range(60_000).selectExpr("id as k", "45 + (id % 20000) / 1e7 as latitude", "case when id < 40000 then 10 + id / 1e7 else (id % 360) - 180 end as longitude")
    ports = spark.createDataFrame([(f"P{i}", 44.0 + i / 100, 10.0) for i in range(200)], PLACE)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",  # few rows would meet in one map task, which cannot be split
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = nearest_place(points, ports, 10, "port_id")
        assert df.filter("port_id is not null").count() >= 40_000
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


# ------------------------------------------------------------------ as-of joins

def _series(seed, n):
    rng = random.Random(seed)
    left = [(i, rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice([None, *range(-50, 4000)]), "x") for i in range(n)]
    right = [(rng.choice(["a", "hot", "c", None]), rng.choice([None, *range(-100, 4000, 3)]), i % 7, i) for i in range(n // 3)]
    return left, right


def _brute_asof(left, right, direction, tolerance):
    out = {}
    for i, key, t, _ in left:
        best = None
        if key is not None and t is not None:
            rows = [(rt, a, b) for k, rt, a, b in right if k == key and rt is not None]
            back = max(((rt, a, b) for rt, a, b in rows if rt <= t), default=None)
            first = min((rt for rt, _, _ in rows if rt >= t), default=None)
            ahead = max((r for r in rows if r[0] == first), default=None) if first is not None else None
            if direction == "backward":
                best = back
            elif direction == "forward":
                best = ahead
            else:
                best = back if ahead is None or back is not None and t - back[0] <= ahead[0] - t else ahead
            if best is not None and tolerance is not None and abs(best[0] - t) > tolerance:
                best = None
        out[i] = best or (None, None, None)
    return out


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("block", [100, 10_000])
@pytest.mark.parametrize("tolerance", [None, 4])
def test_asof_join_equals_brute_force(spark, direction, block, tolerance):
    left, right = _series(block, 300)
    lf = spark.createDataFrame(left, "i long, key string, t long, extra string")
    rf = spark.createDataFrame(right, "key string, rt long, a long, b long")
    got = asof_join(lf, rf, ["key"], "t", "rt", direction, tolerance=tolerance, block_seconds=block)
    assert got.columns == ["i", "key", "t", "extra", "rt", "a", "b"]
    assert {r["i"]: (r["rt"], r["a"], r["b"]) for r in got.collect()} == _brute_asof(left, right, direction, tolerance)


def test_asof_join_on_timestamps_and_edges(spark):
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    lf = spark.createDataFrame([(1, "a", at(0.5)), (2, "a", at(90000)), (3, "a", at(-1))], "i long, key string, t timestamp")
    rf = spark.createDataFrame([("a", at(0.5), 1), ("a", at(0.6), 2)], "key string, rt timestamp, v long")
    got = {r["i"]: r["v"] for r in asof_join(lf, rf, ["key"], "t", "rt").collect()}
    assert got == {1: 1, 2: 2, 3: None}
    assert asof_join(lf.limit(0), rf, ["key"], "t", "rt").count() == 0
    assert {r["v"] for r in asof_join(lf, rf.limit(0), ["key"], "t", "rt", "nearest").collect()} == {None}
    with pytest.raises(ValueError):
        asof_join(lf, rf.withColumn("i", F.lit(1)), ["key"], "t", "rt")
    with pytest.raises(ValueError):
        asof_join(lf, rf, ["key"], "t", "rt", "sideways")


def test_last_known_carries_over_blocks(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), rng.randrange(2000), i, rng.choice([None, None, i])) for i in range(400)]
    d = spark.createDataFrame(rows, "key string, t long, tie long, v long")
    got = last_known(d, ["key"], ["t", "tie"], {"own": (F.col("v"), True), "before": (F.col("v"), False)}, block_seconds=60)
    want, last = {}, {}
    for key, _, tie, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        before = last.get(key)
        if v is not None:
            last[key] = v
        want[tie] = (last.get(key), before)
    assert {r["tie"]: (r["own"], r["before"]) for r in got.collect()} == want


def test_windows_run_within_blocks(spark):
    """No window over a key's rows: only over its blocks' summaries."""
    lf = spark.range(1000).selectExpr("'hot' as key", "id * 3600 as t")
    rf = spark.range(1000).selectExpr("'hot' as key", "id * 3600 as rt", "id as v")
    df = asof_join(lf, rf, ["key"], "t", "rt")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
    over_rows = [line for line in windows if "__found" in line]
    assert windows and over_rows and all(re.search(r"windowspecdefinition\(key#\d+, __block#", line) for line in over_rows)
    assert df.count() == 1000


def test_a_ring_does_not_plan_the_rings_before_it(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 5.0)], POINT)
    places = spark.createDataFrame([("A", 0.05, 0.0)], PLACE)
    near = nearest_place(points, places, 640, "port_id")
    assert len(rings(640)) == 4
    assert near._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 5  # 27 with every ring planned in all later ones
    assert {r[0]: r["port_id"] for r in near.collect()} == {1: "A", 2: None}


def test_positions_are_never_broadcast(spark):
    """However small their files look: a filter on the result makes the last join an inner one, which may build either side."""
    points = spark.createDataFrame([(i, i % 3 / 100, 0.0) for i in range(20)], POINT)
    places = spark.range(5000).selectExpr("concat('P', id) as port_id", "0.05 + id as latitude", "cast(id as double) as longitude")
    near = nearest_place(points, places, 10, "port_id").filter("port_id is not null")
    right = spark.createDataFrame([("P0", 0, 1)], "port_id string, at long, v long")
    known = asof_join(near, right, ["port_id"], "k", "at")
    for df in (near, known):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        df.collect()
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert {r["k"]: (r["port_id"], r["v"]) for r in known.collect()} == {i: ("P0", 1) for i in range(20)}
