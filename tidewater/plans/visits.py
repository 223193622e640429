"""Port visits from positions: stays, throughput, berth demand and tides.

A vessel is in a port from the first position within ENTER_KM of it until the
first one that is neither within LEAVE_KM of it, as its nearest port, nor in
another port: between the two radii it stays where it was, so a vessel that swings
across the inner line makes one visit. All steps run within blocks of time and
carry one value across (``operators.asof``), so no vessel's history, and no
port's, sits in one task. As each step reads its input twice, for the blocks' last
values and for the rows, inputs that took work are cut (``operators.cut``).

Defined results. Positions without vessel, time or sound coordinates say nothing.
Positions of one time count in the order of their ids. A vessel still in port at
its last position has a stay without departure. Stays are half-open: a berth is
free at the moment of departure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.clean import round_half_up
from tidewater.operators.asof import asof_join, last_known
from tidewater.operators.cut import cut
from tidewater.operators.filters import latest_run
from tidewater.operators.nearest import nearest_place
from tidewater.operators.sweep import occupancy, peak_by_hour

ENTER_KM = 10.0
LEAVE_KM = 30.0
SEA = ""


def _sound(lat: Column, lon: Column) -> Column:
    return lat.between(-90.0, 90.0) & (F.abs(lon) < float("inf"))


def _moves(positions: DataFrame, ports: DataFrame, enter_km: float, leave_km: float) -> DataFrame:
    """(mmsi, event_time, event_id, state, before) where a vessel's port changes."""
    p = positions.select("mmsi", F.col("event_time").cast("timestamp").alias("event_time"), "event_id", "latitude", "longitude")
    p = p.filter(F.col("mmsi").isNotNull() & F.col("event_time").isNotNull() & _sound(F.col("latitude"), F.col("longitude")))
    near = nearest_place(p, ports.select("port_id", "latitude", "longitude"), leave_km, "port_id")
    kind = F.when(F.col("port_id").isNull(), "out").when(F.col("distance_km") <= enter_km, "in").otherwise("near")
    at = near.select("mmsi", "event_time", "event_id", F.struct(kind.alias("kind"), "port_id").alias("at"))
    order = ["event_time", "event_id"]
    at = cut(at, "track")
    at = last_known(at, ["mmsi"], order, {"prev": (F.col("at"), False)})
    at = cut(at.filter(F.col("prev").isNull() | (F.col("prev") != F.col("at"))), "changes")
    # Between the radii a vessel keeps its state if it was near the same port before, else it is at sea.
    keeps = (F.col("at.kind") == "near") & F.coalesce(F.col("prev.port_id") == F.col("at.port_id"), F.lit(False))
    becomes = F.when(F.col("at.kind") == "in", F.col("at.port_id")).when(keeps, None).otherwise(SEA)
    state = last_known(at.select("mmsi", *order, becomes.alias("becomes")), ["mmsi"], order, {"state": (F.col("becomes"), True), "before": (F.col("becomes"), False)})
    moved = state.select("mmsi", *order, F.coalesce("state", F.lit(SEA)).alias("state"), F.coalesce("before", F.lit(SEA)).alias("before"))
    return moved.filter("state <> before")


def port_stays(positions: DataFrame, ports: DataFrame, enter_km: float = ENTER_KM, leave_km: float = LEAVE_KM) -> DataFrame:
    """(mmsi, port_id, arrival, departure) of every visit."""
    if not 0 < enter_km <= leave_km:
        raise ValueError("a vessel must enter within the radius that it leaves")
    moves = cut(_moves(positions, ports, enter_km, leave_km), "moves")
    arrival = F.when(F.col("state") != SEA, F.col("event_time"))
    known = last_known(moves, ["mmsi"], ["event_time", "event_id"], {"since": (arrival, False)})
    ended = known.filter(F.col("before") != SEA).select("mmsi", F.col("before").alias("port_id"), F.col("since").alias("arrival"), F.col("event_time").alias("departure"))
    last = moves.groupBy("mmsi").agg(F.max_by(F.struct("state", "event_time"), F.struct("event_time", "event_id")).alias("m"))
    open_ = last.filter(F.col("m.state") != SEA).select("mmsi", F.col("m.state").alias("port_id"), F.col("m.event_time").alias("arrival"), F.lit(None).cast("timestamp").alias("departure"))
    return cut(ended.unionByName(open_), "stays")


def port_throughput(stays: DataFrame) -> DataFrame:
    """Arrivals, departures and mean hours of the ended stays, per port and hour of
    the event (stays count in the hour they end)."""
    one = F.explode(
        F.array(
            F.struct(F.col("arrival").alias("time"), F.lit(1).alias("came"), F.lit(None).cast("double").alias("hours")),
            F.struct(F.col("departure").alias("time"), F.lit(0).alias("came"), ((F.unix_micros("departure") - F.unix_micros("arrival")) / 3.6e9).alias("hours")),
        )
    )
    events = stays.select("port_id", one.alias("e")).filter("e.time is not null")
    return events.groupBy("port_id", F.date_trunc("hour", "e.time").cast("timestamp_ntz").alias("hour")).agg(
        F.sum("e.came").alias("arrivals"), F.sum(1 - F.col("e.came")).alias("departures"), round_half_up(F.avg("e.hours"), 2).alias("mean_stay_hours")
    )


def berth_demand(stays: DataFrame, ports: DataFrame) -> DataFrame:
    """Per port and hour, from its first visit to its last change: the most vessels
    in port at once, its berths, and how many of them must wait for one (null where
    the berths are not known)."""
    peak = peak_by_hour(cut(occupancy(stays, ["port_id"], "arrival", "departure"), "levels"), ["port_id"])
    berths = ports.select("port_id", F.col("berths").try_cast("long").alias("berths"))
    out = peak.join(berths, "port_id", "left")
    return out.select("port_id", F.col("hour").cast("timestamp_ntz").alias("hour"), "peak", "berths", F.when(F.col("berths").isNotNull(), F.greatest(F.lit(0).cast("long"), F.col("peak") - F.col("berths"))).alias("waiting"))


def turning_points(levels: DataFrame, by: list[str], time: str, level: str) -> DataFrame:
    """(by, time, level, kind) of a series' highs and lows: values that differ from
    both neighbours on the same side. A plateau is one value, at its first time; the
    ends of a series are no turning points. Null levels say nothing; of several
    levels of one time the greatest counts."""
    s = levels.filter(" and ".join(f"`{c}` is not null" for c in [*by, time, level])).groupBy(*by, time).agg(F.max(level).alias("level"))
    s = last_known(cut(s, "series"), by, [time], {"prev": (F.col("level"), False)}).filter("prev is null or prev <> level")
    way = F.when(F.col("level") > F.col("prev"), 1).when(F.col("level") < F.col("prev"), -1)
    s = s.select(*by, F.struct(F.col(time).alias("time"), "level", way.alias("way")).alias("at"), time)
    s = last_known(cut(s, "steps"), by, [time], {"prev": (F.col("at"), False)}).filter(F.col("prev.way") != F.col("at.way"))
    return s.select(*by, F.col("prev.time").alias(time), F.col("prev.level").alias("level"), F.when(F.col("prev.way") > 0, "high").otherwise("low").alias("kind"))


def tide_at_arrival(stays: DataFrame, forecast: DataFrame) -> DataFrame:
    """Arrivals between two turning points of their port's sea level (in the newest
    forecast run): whether the tide rises or falls, the hours to the turn, and the
    turn's kind and level."""
    turns = cut(turning_points(latest_run(forecast), ["port_id"], "forecast_timestamp", "sea_level_height_msl"), "turns")
    last = turns.select("port_id", F.col("forecast_timestamp").alias("last_turn"))
    following = turns.select("port_id", F.col("forecast_timestamp").alias("next_turn"), "kind", F.col("level").alias("turn_level"))
    arrivals = stays.select("mmsi", "port_id", "arrival")
    passed = cut(asof_join(arrivals, last, ["port_id"], "arrival", "last_turn"), "passed")
    both = asof_join(passed, following, ["port_id"], "arrival", "next_turn", "forward")
    hours = (F.col("next_turn") * 1000000 - F.unix_micros("arrival")) / 3.6e9
    return both.filter("last_turn is not null and next_turn is not null").select(
        "mmsi", "port_id", F.col("arrival").cast("timestamp_ntz").alias("arrival"), F.when(F.col("kind") == "high", "rising").otherwise("falling").alias("tide"),
        round_half_up(hours, 2).alias("hours_to_turn"), F.col("kind").alias("turn"), round_half_up("turn_level", 2).alias("turn_level"),
    )
