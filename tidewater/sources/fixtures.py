"""Store-shaped inputs derived from the driver's TPC-H-ish tables.

The reference ships no data; its store tables (port and vessel registries,
forecasts, AIS messages) are produced here from ``supplier``, ``nation``,
``part``, ``lineitem`` and ``events``, so every query's work grows with those
tables. The column expressions are plain SQL text shared with the DuckDB
oracle (``tidewater.oracle``): both engines build byte-identical inputs, and only
the operators on top differ (DataFrame API here, hand-written SQL there).

Snapshots are generated with ``explode`` (Spark) / ``unnest`` (DuckDB), never a
cross join. No join carries a broadcast hint; the planner decides by size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.catalog import FORECAST_ANALYSIS_FIELDS, WEATHER_FIELDS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# Shared view expressions (valid in Spark SQL and DuckDB)
# --------------------------------------------------------------------------

SNAPSHOT_TS = "cast(1704067200 + 86400 * snap as string)"

# ports_info snapshots: two per supplier; sentinels in country and latitude.
PORTS_RAW = [
    "concat('P', cast(s_suppkey as string)) as port_id",
    "s_name as port_name",
    "case when s_suppkey % 17 = 0 then 'nan' when s_suppkey % 19 = 0 then 'None' else n_name end as country",
    "cast((s_suppkey + snap) % 12 as string) as berths",
    "concat('XX', cast(s_suppkey as string)) as un_locode",
    "case when s_suppkey % 23 = 0 then 'nan' "
    "else cast(cast(350 + (s_suppkey * 7) % 300 as double) / 10 as string) end as latitude",
    "cast(cast((s_suppkey * 13) % 510 - 260 as double) / 10 as string) as longitude",
    f"{SNAPSHOT_TS} as timestamp",
]

# vessel_info snapshots: two per part; sentinels in flag, length, beam.
VESSELS_RAW = [
    "cast(200000000 + p_partkey as string) as mmsi",
    "p_name as ship_name",
    "p_type as ship_type",
    "case when p_partkey % 31 = 0 then 'nan' else p_brand end as flag",
    "case when p_partkey % 13 = 0 then 'nan' else cast(p_size * 6 as string) end as length",
    "cast(p_size as string) as width",
    "cast(cast(p_size as double) / 4 as string) as draft",
    "case when p_partkey % 29 = 0 then 'None' else cast(cast(p_size as double) / 2 as string) end as beam",
    "cast(9000000 + p_partkey as string) as imo",
    "cast(p_partkey % 9 as string) as status",
    f"{SNAPSHOT_TS} as timestamp",
]

_REF = "1704067200 + 86400 * (l_orderkey % 2)"
_VALID = f"{_REF} + 3600 * (l_partkey % 72)"
# Every 37th port has forecasts but no registry row.
_FORECAST_PORT = "concat(case when l_suppkey % 37 = 0 then 'U' else 'P' end, cast(l_suppkey as string))"

# port_weather_forecast rows: two runs, duplicate keys, mixed sentinels. The
# port's coordinates are copied in as text, as the forecast fetcher does.
FORECAST_RAW = [
    f"concat({_FORECAST_PORT}, '-', cast({_REF} as string), '-', cast({_VALID} as string)) as id",
    f"{_FORECAST_PORT} as port_id",
    "case when l_suppkey % 23 = 0 then 'nan' "
    "else cast(cast(350 + (l_suppkey * 7) % 300 as double) / 10 as string) end as latitude",
    "cast(cast((l_suppkey * 13) % 510 - 260 as double) / 10 as string) as longitude",
    f"cast({_REF} as string) as ref_time",
    f"cast({_VALID} as string) as forecast_timestamp",
    "case when l_orderkey % 29 = 0 then 'nan' else cast(l_quantity / 10 as string) end as wave_height",
    "case when l_orderkey % 31 = 0 then 'NaN' else cast(l_quantity / 5 as string) end as wave_period",
    "case when l_partkey % 7 = 0 then 'Nan' else cast((l_partkey + l_linenumber) % 360 as string) end as wave_direction",
    "cast(l_quantity / 20 as string) as wind_wave_height",
    "cast(l_partkey % 360 as string) as wind_wave_direction",
    "cast(cast(l_quantity + l_linenumber as double) / 4 as string) as wind_wave_period",
    "cast(cast(l_linenumber as double) / 2 as string) as swell_wave_height",
    "case when l_orderkey % 19 = 0 then 'NAN' else cast(l_orderkey % 180 as string) end as swell_wave_direction",
    "cast(l_linenumber + 4 as string) as swell_wave_period",
    # ports whose temperature and current are never measured
    "case when l_suppkey % 41 = 0 or l_partkey % 11 = 0 then 'nan' "
    "else cast(cast((l_partkey * 37 + l_orderkey) % 400 as double) / 10 - 2 as string) end as sea_surface_temperature",
    "cast(cast(l_partkey % 50 as double) / 100 as string) as sea_level_height_msl",
    "case when l_suppkey % 41 = 0 or l_partkey % 13 = 0 then 'None' "
    "else cast(cast((l_orderkey + l_linenumber) % 80 as double) / 40 as string) end as ocean_current_velocity",
    "cast(l_orderkey % 360 as string) as ocean_current_direction",
    "l_orderkey as seq1",
    "l_linenumber as seq2",
]

# Weather columns present in forecast_raw: all that the analysis reads.
FORECAST_FIELDS = FORECAST_ANALYSIS_FIELDS

# AIS wire messages, one per event: message type from the event type, JSON
# nulls for some MessageID / Sog values, the 511 "no heading" code.
AIS_FIELDS = [
    "event_id",
    "ts",
    "user_id",
    "case event_type when 'signup' then 'ShipStaticData' when 'error' then 'SafetyBroadcastMessage' "
    "else 'PositionReport' end as mt",
    "case when event_id % 41 = 0 then 'null' else cast(event_id as string) end as mid",
    # every 43rd report holds no movement field at all
    "case when event_id % 37 = 0 or event_id % 43 = 0 then 'null' "
    "else cast(cast((event_id * 7) % 1000 as double) / 40 as string) end as sog",
    "case when event_id % 43 = 0 then 'null' else cast(cast((event_id * 37) % 3600 as double) / 10 as string) end as cog",
    "case when event_id % 43 = 0 then 'null' when event_id % 50 = 0 then '511' else cast(event_id % 360 as string) end as hdg",
    "cast(200000000 + user_id as string) as mmsi",
    "cast(cast(350 + (user_id * 7 + event_id % 20) % 300 as double) / 10 + 0.03 as string) as lat",
    "cast(cast((user_id * 13 + event_id % 20) % 510 - 260 as double) / 10 + 0.03 as string) as lon",
]
AIS_RAW = [
    "event_id",
    "ts",
    "concat('{\"MessageType\":\"', mt, '\",\"Message\":{\"MessageID\":', mid, ',\"', mt, "
    "'\":{\"Sog\":', sog, ',\"Cog\":', cog, ',\"TrueHeading\":', hdg, '}},\"MetaData\":{\"MMSI\":', mmsi, "
    "',\"ShipName\":\"V', cast(user_id as string), '\",\"latitude\":', lat, ',\"longitude\":', lon, "
    "',\"time_utc\":\"', cast(ts as string), '\"}}') as value",
]

# ais_raw plus replays, one kind of bad record per rule, and good records with a
# missing type, no time, an unreadable time, or the feed's own time form. The
# replay branch re-delivers every tenth message a second time (at-least-once
# delivery), encoded with other white space.
AIS_DIRTY = [
    "event_id",
    "ts",
    "case when event_id % 97 = 0 then 'not json' "
    "when event_id % 89 = 0 then '{\"MessageType\":\"PositionReport\",\"Message\":[],\"MetaData\":{}}' "
    "when event_id % 83 = 0 then '{\"MessageType\":\"PositionReport\",\"Message\":{\"MessageID\":1}}' "
    "when event_id % 79 = 0 then cast(null as string) "
    "when event_id % 73 = 0 then '{\"error\":\"overload\"}' "
    "when event_id % 71 = 0 then replace(value, '\"MessageType\":', '\"Kind\":') "
    "when event_id % 67 = 0 then replace(value, '\"time_utc\":', '\"time\":') "
    "when event_id % 61 = 0 then replace(value, '\"time_utc\":\"', '\"time_utc\":\"not a time ') "
    "when event_id % 59 = 0 then replace(value, '\"}}', ' +0000 UTC\"}}') "
    "else value end as value",
]
AIS_REPLAY_PREDICATE = "event_id % 10 = 0"
AIS_REPLAY = ["event_id", "ts", "replace(replace(value, '\":', '\": '), ',\"', ', \"') as value"]


# --------------------------------------------------------------------------
# Spark builders
# --------------------------------------------------------------------------

def _snapshots(df: DataFrame, snapshots: Sequence[int], *cols: str) -> DataFrame:
    return df.select(*cols, F.explode(F.array(*map(F.lit, snapshots))).alias("snap"))


def ports_raw(spark: SparkSession, sf_dir: str, snapshots: Sequence[int] = (0, 1)) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return _snapshots(joined, snapshots, "s_suppkey", "s_name", "n_name").selectExpr(*PORTS_RAW)


def vessels_raw(spark: SparkSession, sf_dir: str, snapshots: Sequence[int] = (0, 1)) -> DataFrame:
    part = table(spark, sf_dir, "part")
    base = _snapshots(part, snapshots, "p_partkey", "p_name", "p_type", "p_brand", "p_size")
    return base.selectExpr(*VESSELS_RAW)


def forecast_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*FORECAST_RAW)


def ais_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*AIS_FIELDS).selectExpr(*AIS_RAW)


def ais_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = ais_raw(spark, sf_dir)
    dirty = raw.selectExpr(*AIS_DIRTY)
    return dirty.unionByName(dirty.filter(AIS_REPLAY_PREDICATE).selectExpr(*AIS_REPLAY))


def ais_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ais_messages as the store holds them: metadata cells as text and the
    nested position report as the text of a Python dict (single quotes,
    ``None``), which is what ``str(dict)`` wrote into the cell."""
    raw = ais_raw(spark, sf_dir)
    body = F.get_json_object("value", "$.Message.PositionReport")
    as_repr = body
    for pattern, replacement in (('"', "'"), (":", ": "), (",", ", "), (r"\bnull\b", "None")):
        as_repr = F.regexp_replace(as_repr, pattern, replacement)
    meta = lambda k: F.get_json_object("value", f"$.MetaData.{k}")
    return raw.select(
        "event_id",
        meta("MMSI").alias("mmsi"),
        meta("ShipName").alias("ship_name"),
        meta("latitude").alias("latitude"),
        meta("longitude").alias("longitude"),
        F.get_json_object("value", "$.MessageType").alias("message_type"),
        meta("time_utc").alias("time_utc"),
        as_repr.alias("position_report"),
    )


def ports_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ports_raw as store cells with row key = port_id, so both snapshots land
    in the same row and the newest cell must win when read back."""
    from tidewater.operators.cells import rows_to_cells
    from tidewater.sources.catalog import PORTS

    ports = ports_raw(spark, sf_dir).withColumn("id", F.col("port_id"))
    return rows_to_cells(ports, PORTS, ts_col="timestamp")


# --------------------------------------------------------------------------
# Landed API payloads (what the fetchers receive), built from the same tables
# --------------------------------------------------------------------------

FORECAST_T0 = 1704067200
FORECAST_STEP = 3600
FORECAST_STEPS = 72


# Element i of hourly variable f of port k, and its current value: integer rules
# that both engines evaluate alike.
def hourly_value(f: str, k: str, i: str) -> str:
    n = WEATHER_FIELDS.index(f)
    return f"(({k} * {n + 3} + {i}) % {50 + 10 * n}) / 10"


def current_value(f: str, k: str) -> str:
    n = WEATHER_FIELDS.index(f)
    return f"({k} * {n + 1} % {50 + 10 * n}) / 10"


PORT_LATITUDE = "cast(cast(350 + (s_suppkey * 7) % 300 as double) / 10 as string)"
PORT_LONGITUDE = "cast(cast((s_suppkey * 13) % 510 - 260 as double) / 10 as string)"


def forecast_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hourly forecast response per supplier-port: its coordinates, 22 parallel
    arrays, and start / interval / end (72 steps)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    end = FORECAST_T0 + FORECAST_STEPS * FORECAST_STEP
    arrays = ", ".join(
        f"'{f}', transform(sequence(0, {FORECAST_STEPS - 1}), i -> {hourly_value(f, 's_suppkey', 'i')})" for f in WEATHER_FIELDS
    )
    return s.selectExpr(
        "concat('P', cast(s_suppkey as string)) as port_id",
        "s_name as port_name",
        f"{PORT_LATITUDE} as latitude",
        f"{PORT_LONGITUDE} as longitude",
        f"named_struct('start', cast({FORECAST_T0} as bigint), 'interval', cast({FORECAST_STEP} as bigint), "
        f"'end', cast({end} as bigint), {arrays}) as hourly",
    )


def forecast_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast responses as landed texts: every 41st cut off, every 43rd without
    its hourly block, every 47th with no step length."""
    d = forecast_payloads(spark, sf_dir).withColumn("k", F.regexp_extract("port_id", r"(\d+)", 1).cast("bigint"))
    h = F.col("hourly")
    hourly = F.when(F.col("k") % 43 != 0, h.withField("interval", F.when(F.col("k") % 47 != 0, h["interval"])))
    text = F.to_json(F.struct("port_id", "port_name", "latitude", "longitude", hourly.alias("hourly")))
    return d.select(F.when(F.col("k") % 41 == 0, F.substring(text, 1, 30)).otherwise(text).alias("payload"))


def _registry_pages(rows: DataFrame, catalog, key: str, page_size: int) -> DataFrame:
    """Registry API responses as JSON text: ``{"error": null, "data": [...]}``,
    items keyed by the catalog's ``info`` qualifiers. One response per page of
    at most ``page_size`` consecutive ids, so no response grows with the data."""
    item = F.struct(
        *[F.col(c).alias(qual) for c, (fam, qual) in catalog.columns.items() if fam == "info" and c in rows.columns]
    )
    page = F.floor(F.regexp_extract(F.col(key), r"(\d+)$", 1).try_cast("bigint") / page_size)
    pages = rows.groupBy(page.alias("page")).agg(F.to_json(F.collect_list(item)).alias("data"))
    # responses that report no error spell it in several ways
    none = F.element_at(F.array(*map(F.lit, ("null", "false", '""', "0"))), (F.col("page") % 4 + 1).cast("int"))
    return pages.select("page", F.concat(F.lit('{"error":'), none, F.lit(',"data":'), F.col("data"), F.lit("}")).alias("payload"))


def registry_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every registry page, a good response and three that fail: one cut off,
    one with an error, one without data."""
    pages = registry_payloads(spark, sf_dir)
    bad = F.array(F.col("payload"), F.substring("payload", 1, 40), F.concat(F.lit('{"error":"quota '), "page", F.lit('","data":[]}')), F.lit('{"error":null}'))
    return pages.select(F.explode(bad).alias("payload"))


def registry_payloads(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    """Port registry responses: snapshot 0 of ``ports_raw``."""
    from tidewater.sources.catalog import PORTS

    ports = ports_raw(spark, sf_dir, snapshots=(0,))
    return _registry_pages(ports, PORTS, "port_id", page_size)


def vessel_registry_payloads(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    """Vessel registry responses: snapshot 0 of ``vessels_raw``."""
    from tidewater.sources.catalog import VESSELS

    vessels = vessels_raw(spark, sf_dir, snapshots=(0,))
    return _registry_pages(vessels, VESSELS, "mmsi", page_size)


def current_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current-weather responses per supplier-port as JSON text, with coordinates
    and 22 variables. Every 53rd supplier's fetch failed and landed without a
    ``current`` block; every 59th response is cut off."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    fields = ", ".join(f"'{f}', {current_value(f, 's_suppkey')}" for f in WEATHER_FIELDS)
    time = f"cast({FORECAST_T0} + (s_suppkey % 24) * {FORECAST_STEP} as bigint)"
    body = (
        f"to_json(named_struct('port_id', concat('P', cast(s_suppkey as string)), 'port_name', s_name, "
        f"'latitude', {PORT_LATITUDE}, 'longitude', {PORT_LONGITUDE}, "
        f"'current', case when s_suppkey % 53 <> 0 then named_struct('time', {time}, {fields}) end))"
    )
    return s.selectExpr(f"case when s_suppkey % 59 = 0 then substring({body}, 1, 30) else {body} end as payload")
