"""Stays, berth demand, tides and forecasts at positions against brute force."""

import datetime
import random

import pytest

from tests.test_spatial_time import _km
from tidewater.operators import sweep
from tidewater.plans import safety, visits

T0 = datetime.datetime(2024, 3, 1)
POSITION = "event_id long, mmsi string, event_time timestamp, latitude double, longitude double"
PORT = "port_id string, berths string, latitude double, longitude double"
PORTS = [("A", "1", 10.0, 10.0), ("B", "2", 10.0, 10.5), ("C", None, -60.0, 179.95), ("nowhere", "3", None, None)]


def at(seconds):
    return T0 + datetime.timedelta(seconds=seconds)


def tracks(seed, vessels=6, n=120):
    """Vessels that dwell, swing across the inner line, hop between ports and cross
    day edges; one stays in port to the end, and times repeat."""
    rng, rows, k = random.Random(seed), [], 0
    for v in range(vessels):
        t, (lat, lon) = rng.randrange(80_000), (10.0, 10.2)
        for _ in range(n):
            t += rng.choice([0, 60, 1800, 7200, 40_000])
            port = rng.choice(PORTS[:3])
            if rng.random() < 0.4:
                lat, lon = port[2] + rng.choice([0.02, 0.08, 0.12, 0.2, 0.5, -0.3]), port[3] + rng.choice([0, 0, 0.05, 0.24])
            rows.append((k, f"v{v}", at(t), lat, lon))
            k += 1
        rows.append((k, f"v{v}", at(t + 10), None, 5.0))
        k += 1
    rows.append((k, "home", at(0), 10.0, 10.0))
    rows += [(k + 1, None, at(5), 10.0, 10.0), (k + 2, "v0", None, 10.0, 10.0), (k + 3, "sea", at(1), 0.0, 0.0)]
    rng.shuffle(rows)
    return rows


def brute_stays(rows, enter, leave):
    out, state = [], {}
    for k, mmsi, t, lat, lon in sorted((r for r in rows if r[1] and r[2] and r[3] is not None), key=lambda r: (r[2], r[0])):
        near = min(((_km(lat, lon, p[2], p[3]), p[0]) for p in PORTS if p[2] is not None))
        port = near[1] if near[0] <= leave else None
        now, since = state.get(mmsi, (None, None))
        if port and near[0] <= enter:
            after = port
        else:
            after = now if port and port == now else None
        if after != now:
            if now:
                out.append((mmsi, now, since, t))
            since = t
        state[mmsi] = (after, since)
    out += [(m, p, since, None) for m, (p, since) in state.items() if p]
    return sorted(map(str, out))


@pytest.mark.parametrize("radii", [(10.0, 30.0), (5.0, 5.0)])
def test_stays_equal_brute_force(spark, radii):
    rows = tracks(int(radii[0]))
    stays = visits.port_stays(spark.createDataFrame(rows, POSITION), spark.createDataFrame(PORTS, PORT), *radii)
    want = brute_stays(rows, *radii)
    assert len(want) > 25
    assert sorted(str(tuple(r)) for r in stays.select("mmsi", "port_id", "arrival", "departure").collect()) == want


def test_stays_of_nothing(spark):
    none = visits.port_stays(spark.createDataFrame([], POSITION), spark.createDataFrame(PORTS, PORT))
    assert none.count() == 0 and visits.port_throughput(none).count() == 0 and visits.berth_demand(none, spark.createDataFrame(PORTS, PORT)).count() == 0
    assert visits.port_stays(spark.createDataFrame(tracks(1), POSITION), spark.createDataFrame([], PORT)).count() == 0
    with pytest.raises(ValueError):
        visits.port_stays(none, none, 30, 10)


def stays_frame(spark, rows):
    return spark.createDataFrame([(f"v{i}", p, at(a), at(b) if b is not None else None) for i, (p, a, b) in enumerate(rows)], "mmsi string, port_id string, arrival timestamp, departure timestamp")


@pytest.mark.parametrize("block", [900, 86_400])
def test_occupancy_equals_brute_force(spark, block):
    rng = random.Random(block)
    rows = []
    for _ in range(300):
        a = rng.randrange(0, 200_000, 300)
        rows.append((rng.choice("AAAB"), a, rng.choice([a, a + 300, a + rng.randrange(0, 60_000, 300), None])))
    got = sweep.occupancy(stays_frame(spark, rows), ["port_id"], "arrival", "departure", block).collect()
    real = [r for r in rows if r[2] is None or r[2] > r[1]]
    want = {(p, at(t)): sum(1 for q, a, b in real if q == p and a <= t and (b is None or b > t)) for p, a, b in real for t in (a, b) if t is not None}
    assert {(r["port_id"], r["time"]): r["occupied"] for r in got} == want and len(got) == len(want)


def test_berth_demand_by_hour(spark):
    """Touching stays share no moment; quiet hours repeat the level; a stay of no
    length occupies nothing."""
    h = 3600
    rows = [("A", 0, h), ("A", h, 2 * h), ("A", 2 * h - 1, 6 * h + 5), ("B", 100, 100), ("B", 200, None), ("B", 5 * h, 5 * h + 1), ("C", 30, 60)]
    got = visits.berth_demand(stays_frame(spark, rows), spark.createDataFrame(PORTS, PORT)).collect()
    hours = lambda p: {int((r["hour"] - T0).total_seconds() // h): (r["peak"], r["berths"], r["waiting"]) for r in got if r["port_id"] == p}
    assert hours("A") == {0: (1, 1, 0), 1: (2, 1, 1), 2: (1, 1, 0), 3: (1, 1, 0), 4: (1, 1, 0), 5: (1, 1, 0), 6: (1, 1, 0)}
    assert hours("B") == {0: (1, 2, 0), 1: (1, 2, 0), 2: (1, 2, 0), 3: (1, 2, 0), 4: (1, 2, 0), 5: (2, 2, 0)}
    assert hours("C") == {0: (1, None, None)}
    through = {(r["port_id"], r["hour"]): (r["arrivals"], r["departures"], r["mean_stay_hours"]) for r in visits.port_throughput(stays_frame(spark, rows)).collect()}
    assert through["A", at(h)] == (2, 1, 1.0) and through["B", at(0)] == (2, 1, 0.0) and through["A", at(6 * h)] == (0, 1, 4.0)


def brute_turns(series):
    steps = []
    for t in sorted(series):
        if not steps or steps[-1][1] != series[t]:
            steps.append((t, series[t]))
    out = []
    for a, b, c in zip(steps, steps[1:], steps[2:]):
        if (b[1] > a[1]) != (c[1] > b[1]):
            out.append((b[0], b[1], "high" if b[1] > a[1] else "low"))
    return out


def test_turning_points_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(p, t, rng.choice([0.1, 0.2, 0.2, 0.3])) for p in "ab" for t in range(0, 1_000_000, 3600) for _ in range(rng.choice([0, 1, 2]))]
    rows += [("flat", t, 1.0) for t in range(5)] + [("a", None, 1.0), ("a", 7, None), (None, 7, 1.0)]
    got = visits.turning_points(spark.createDataFrame(rows, "port_id string, t long, level double"), ["port_id"], "t", "level").collect()
    for p in ("a", "b", "flat"):
        series = {}
        for q, t, v in rows:
            if q == p and t is not None and v is not None:
                series[t] = max(v, series.get(t, v))
        assert sorted((r["t"], r["level"], r["kind"]) for r in got if r["port_id"] == p) == brute_turns(series)
    assert {r["port_id"] for r in got} == {"a", "b"}


def test_tide_at_arrival(spark):
    level = {0: 0.0, 1: 1.0, 2: 1.0, 3: 0.5, 4: 0.2, 5: 0.9, 6: 1.0}  # high at 1, low at 4
    start = int(T0.replace(tzinfo=datetime.UTC).timestamp())
    f = spark.createDataFrame([("A", 100, start + 3600 * t, v) for t, v in level.items()] + [("A", 99, start, 9.0)], "port_id string, ref_time long, forecast_timestamp long, sea_level_height_msl double")
    stays = stays_frame(spark, [("A", 3600, None), ("A", 9000, None), ("A", 4 * 3600, None), ("A", 0, None), ("A", 30_000, None), ("B", 9000, None)])
    got = {r["mmsi"]: tuple(r)[3:] for r in visits.tide_at_arrival(stays, f).collect()}
    assert got == {"v0": ("rising", 0.0, "high", 1.0), "v1": ("falling", 1.5, "low", 0.2), "v2": ("falling", 0.0, "low", 0.2)}


def test_forecast_known_at_a_position(spark):
    """The newest run known by then, not a later one; the nearer hour, ties to the
    earlier; nothing beyond the tolerance."""
    start = int(T0.replace(tzinfo=datetime.UTC).timestamp())
    hours = [("A", 0, h, 1.0 + h) for h in range(0, 30, 3)] + [("A", 10, h, 100.0 + h) for h in range(10, 13)] + [("A", 10, 12, 50.0)]
    f = spark.createDataFrame([(p, start + 3600 * r, start + 3600 * h, w, None, None) for p, r, h, w in hours], "port_id string, ref_time long, forecast_timestamp long, wave_height double, ocean_current_velocity double, sea_surface_temperature double")
    rows = [(1, "A", 5400), (2, "A", 9 * 3600 + 3599), (3, "A", 10 * 3600), (4, "A", 20 * 3600), (5, "A", -60), (6, "B", 5400), (7, None, 5400), (8, "A", 12 * 3600 + 1)]
    p = spark.createDataFrame([(k, port, at(t)) for k, port, t in rows], "event_id long, port_id string, event_time timestamp")
    got = {r["event_id"]: (r["ref_time"] and (r["ref_time"] - start) // 3600, r["wave_height"]) for r in safety.forecast_at(p, f).collect()}
    assert got == {1: (0, 1.0), 2: (0, 10.0), 3: (10, 110.0), 4: (10, None), 5: (None, None), 6: (None, None), 7: (None, None), 8: (10, 112.0)}


def test_dangerous_positions(spark):
    start = int(T0.replace(tzinfo=datetime.UTC).timestamp())
    f = spark.createDataFrame([("A", start, start, 4.5, 0.1, 20.0), ("B", start, start, 1.0, 0.1, 20.0)], "port_id string, ref_time long, forecast_timestamp long, wave_height double, ocean_current_velocity double, sea_surface_temperature double")
    p = spark.createDataFrame([(1, "x", at(60), 10.1, 10.0), (2, "x", at(60), 10.0, 10.5), (3, "x", at(60), 30.0, 10.0), (4, "x", at(90_000), 10.1, 10.0)], POSITION)
    out = safety.dangerous_positions(p, spark.createDataFrame(PORTS, PORT), f).collect()
    assert [(r["event_id"], r["port_id"], r["wave_height"]) for r in out] == [(1, "A", 4.5)] and abs(out[0]["distance_km"] - 11.12) < 0.01
