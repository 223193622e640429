"""Independent DuckDB SQL for every registered query (the correctness oracle).

Inputs are the same view expressions the Spark fixtures use
(``tidewater.sources.fixtures``), pasted as CTEs; everything on top is written
here directly in SQL: joins before grouping, ``row_number`` windows for
latest-per-key, JSON functions for message decoding. Rounding follows the rule
of ``functions.clean.round_half_up``.
"""

from __future__ import annotations

from tidewater.operators.nearest import EARTH_KM
from tidewater.plans import safety, visits
from tidewater.sources import fixtures as fx
from tidewater.sources.catalog import FORECAST_ANALYSIS_FIELDS, WEATHER_FIELDS

WEATHER_SENTINELS_SQL = "('nan', 'NaN', 'Nan', 'NAN', 'None')"


def N(c: str, sentinels: str = WEATHER_SENTINELS_SQL) -> str:
    """Sentinel text -> null."""
    return f"case when {c} in {sentinels} then null else {c} end"


def N1(c: str) -> str:
    return N(c, "('nan')")


def R(x: str, digits: int = 2) -> str:
    return f"cast(round(cast({x} as decimal(24,8)), {digits}) as double)"


def _sel(exprs) -> str:
    return ",\n    ".join(exprs)


def _forecast_clean() -> str:
    cols = [
        "id", "port_id", f"{N('latitude')} as latitude", f"{N('longitude')} as longitude",
        f"try_cast({N('forecast_timestamp')} as bigint) as forecast_timestamp",
        f"try_cast({N('ref_time')} as bigint) as ref_time",
    ]
    for f in FORECAST_ANALYSIS_FIELDS:
        cols.append(
            f"try_cast({N(f)} as double) as {f}" if f in fx.FORECAST_FIELDS else f"cast(null as double) as {f}"
        )
    return f"select {_sel(cols)} from forecast_raw"


def _latest(table: str, key: str, order: list[str], cols: list[str]) -> str:
    ob = ", ".join(f"{o} desc nulls last" for o in order)
    return (
        f"select {', '.join(cols)} from (select *, row_number() over (partition by {key} order by {ob}) as rn "
        f"from {table}) where rn = 1"
    )


PORT_COLS = ["port_id", "port_name", "country", "berths", "un_locode", "latitude", "longitude", "timestamp"]
PORT_ORDER = ["try_cast(timestamp as bigint)"] + PORT_COLS[1:]

AIS_OK = (
    "value is not null and json_valid(value) and json_extract(value, '$.error') is null "
    "and coalesce(json_type(value, '$.Message') = 'OBJECT', false) "
    "and coalesce(json_type(value, '$.MetaData') = 'OBJECT', false)"
)

CTES: dict[str, tuple[str, list[str]]] = {
    "ports_base": (
        "select s_suppkey, s_name, n_name, unnest([0, 1]) as snap from supplier join nation on s_nationkey = n_nationkey",
        [],
    ),
    "ports_raw": (f"select {_sel(fx.PORTS_RAW)} from ports_base", ["ports_base"]),
    "vessels_base": ("select p_partkey, p_name, p_type, p_brand, p_size, unnest([0, 1]) as snap from part", []),
    "vessels_raw": (f"select {_sel(fx.VESSELS_RAW)} from vessels_base", ["vessels_base"]),
    "forecast_raw": (f"select {_sel(fx.FORECAST_RAW)} from lineitem", []),
    "ais_events": (f"select {_sel(fx.AIS_FIELDS)} from events", []),
    "ais_raw": (f"select {_sel(fx.AIS_RAW)} from ais_events", ["ais_events"]),
    "ais_dirty": (
        f"select * from dirty_once union all select {_sel(fx.AIS_REPLAY)} from dirty_once where {fx.AIS_REPLAY_PREDICATE}",
        ["dirty_once"],
    ),
    "dirty_once": (f"select {_sel(fx.AIS_DIRTY)} from ais_raw", ["ais_raw"]),
    "forecast_clean": (_forecast_clean(), ["forecast_raw"]),
    "forecast_latest": (
        "select * from forecast_clean where ref_time = (select max(ref_time) from forecast_clean)",
        ["forecast_clean"],
    ),
    "ports_latest": (_latest("ports_raw", "port_id", PORT_ORDER, PORT_COLS), ["ports_raw"]),
    "ports_clean5": (
        "select " + ", ".join(f"{N(c)} as {c}" for c in PORT_COLS) + " from ports_raw",
        ["ports_raw"],
    ),
    "ports_latest5": (_latest("ports_clean5", "port_id", PORT_ORDER, PORT_COLS), ["ports_clean5"]),
}


def sql(body: str, *needs: str) -> str:
    """``WITH`` the CTEs ``needs`` (and their dependencies, in order) + body."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in CTES[name][1]:
            visit(dep)
        ordered.append(name)

    for n in needs:
        visit(n)
    if not ordered:
        return body
    return "with " + ",\n".join(f"{n} as ({CTES[n][0]})" for n in ordered) + "\n" + body


ORACLE: dict[str, str] = {}

# ------------------------------------------------------------------ weather

ORACLE["clean_forecast"] = sql("select * from forecast_clean", "forecast_clean")
ORACLE["latest_run"] = sql("select * from forecast_latest", "forecast_latest")
ORACLE["latest_ports"] = sql("select * from ports_latest", "ports_latest")

ORACLE["weather_port_summary"] = sql(
    f"""select f.port_id, p.port_name, f.latitude, f.longitude,
    {R('avg(wave_height)')} as avg_wave_height, {R('max(wave_height)')} as max_wave_height,
    {R('avg(wave_period)')} as avg_wave_period, {R('avg(wind_wave_height)')} as avg_wind_wave_height,
    {R('avg(wind_wave_direction)')} as avg_wind_direction, {R('avg(swell_wave_height)')} as avg_swell_wave_height,
    {R('avg(swell_wave_period)')} as avg_swell_period, {R('avg(sea_surface_temperature)')} as avg_temperature,
    {R('min(sea_surface_temperature)')} as min_temperature, {R('max(sea_surface_temperature)')} as max_temperature,
    {R('avg(sea_level_height_msl)')} as avg_sea_level, {R('avg(ocean_current_velocity)')} as avg_current_velocity,
    {R('avg(ocean_current_direction)')} as avg_current_direction, count(*) as forecast_records
  from forecast_latest f left join ports_latest p on f.port_id = p.port_id
  group by f.port_id, p.port_name, f.latitude, f.longitude
  order by avg_wave_height desc nulls last""",
    "forecast_latest", "ports_latest",
)

ORACLE["storm_detection"] = sql(
    f"""select f.port_id, p.port_name, {R('f.wave_height')} as wave_height,
    {R('f.swell_wave_height')} as swell_height,
    strftime(make_timestamp(f.forecast_timestamp * 1000000), '%Y-%m-%d %H:%M:%S') as forecast_time
  from forecast_latest f left join ports_latest p on f.port_id = p.port_id
  where f.wave_height is not null and f.wave_height > 3.0
  order by wave_height desc""",
    "forecast_latest", "ports_latest",
)

ORACLE["temperature_analysis"] = sql(
    f"""select * from (select f.port_id, p.port_name,
    {R('avg(sea_surface_temperature)')} as avg_temp, {R('stddev_samp(sea_surface_temperature)')} as temp_stddev,
    {R('min(sea_surface_temperature)')} as min_temp, {R('max(sea_surface_temperature)')} as max_temp
  from forecast_latest f left join ports_latest p on f.port_id = p.port_id
  group by f.port_id, p.port_name) where avg_temp is not null order by avg_temp""",
    "forecast_latest", "ports_latest",
)

ORACLE["current_analysis"] = sql(
    f"""select * from (select f.port_id, p.port_name,
    {R('avg(ocean_current_velocity)')} as avg_current_velocity, {R('max(ocean_current_velocity)')} as max_current_velocity,
    {R('stddev_samp(ocean_current_velocity)')} as current_stddev, count(*) as measurements
  from forecast_latest f left join ports_latest p on f.port_id = p.port_id
  group by f.port_id, p.port_name) where avg_current_velocity is not null order by avg_current_velocity desc""",
    "forecast_latest", "ports_latest",
)

ORACLE["wave_comparison"] = sql(
    f"""select * from (select f.port_id, p.port_name, {R('f.wave_height')} as total_waves,
    {R('f.wind_wave_height')} as wind_waves, {R('f.swell_wave_height')} as swell_waves
  from forecast_latest f left join ports_latest p on f.port_id = p.port_id) where total_waves is not null""",
    "forecast_latest", "ports_latest",
)

ORACLE["hazardous_ports"] = sql(
    f"""select f.port_id, p.port_name, count(*) as hazard_count,
    {R('max(wave_height)')} as max_wave_height, {R('max(ocean_current_velocity)')} as max_current_velocity
  from forecast_latest f left join ports_latest p on f.port_id = p.port_id
  where (wave_height is not null and wave_height > 4.0)
     or (ocean_current_velocity is not null and ocean_current_velocity > 1.5)
     or (sea_surface_temperature is not null and sea_surface_temperature < 0)
     or (sea_surface_temperature is not null and sea_surface_temperature > 35)
  group by f.port_id, p.port_name order by hazard_count desc""",
    "forecast_latest", "ports_latest",
)

ORACLE["regional_weather_comparison"] = sql(
    f"""select * from (select p.country,
    {R('avg(f.wave_height)')} as avg_wave_height, {R('avg(f.sea_surface_temperature)')} as avg_temperature,
    {R('avg(f.ocean_current_velocity)')} as avg_current, count(*) as total_measurements
  from forecast_latest f left join ports_latest5 p on f.port_id = p.port_id
  group by p.country)
  where country is not null and (avg_wave_height is not null or avg_temperature is not null or avg_current is not null)
  order by avg_wave_height desc nulls last""",
    "forecast_latest", "ports_latest5",
)

_PROFILE_COLS = [
    "id", "port_id", "latitude", "longitude", "forecast_timestamp", "ref_time", *FORECAST_ANALYSIS_FIELDS, "port_name",
]
ORACLE["null_profile"] = sql(
    "select column_name, null_count from (select "
    + ", ".join(f"cast(count_if({c} is null) as bigint) as {c}" for c in _PROFILE_COLS)
    + " from (select f.*, p.port_name from forecast_latest f left join ports_latest p on f.port_id = p.port_id)) "
    + "unpivot (null_count for column_name in (" + ", ".join(_PROFILE_COLS) + "))",
    "forecast_latest", "ports_latest",
)

# ------------------------------------------------------------------ ports and fleet

CTES["ports_typed1"] = (
    f"select port_id, {N1('port_name')} as port_name, {N1('country')} as country, {N1('berths')} as berths, "
    f"{N1('un_locode')} as un_locode, try_cast({N1('latitude')} as double) as latitude, "
    f"try_cast({N1('longitude')} as double) as longitude, try_cast({N1('timestamp')} as bigint) as ts "
    "from (select * replace (" + N1("port_id") + " as port_id) from ports_raw)",
    ["ports_raw"],
)
CTES["port_stats"] = (
    _latest(
        "ports_typed1", "port_id",
        ["ts", "port_name", "country", "berths", "un_locode", "latitude", "longitude"],
        ["port_id", "port_name", "country", "berths", "un_locode", "latitude", "longitude"],
    ),
    ["ports_typed1"],
)
_VESSEL_TEXT = ["ship_name", "ship_type", "flag", "imo", "status"]
CTES["vessels_typed1"] = (
    "select " + N1("mmsi") + " as mmsi, "
    + ", ".join(f"{N1(c)} as {c}" for c in ["ship_name", "ship_type", "flag"])
    + ", " + ", ".join(f"try_cast({N1(c)} as double) as {c}" for c in ["length", "width", "draft", "beam"])
    + ", " + ", ".join(f"{N1(c)} as {c}" for c in ["imo", "status"])
    + f", try_cast({N1('timestamp')} as bigint) as ts from vessels_raw",
    ["vessels_raw"],
)
_FLEET_COLS = ["mmsi", "ship_name", "ship_type", "flag", "length", "width", "draft", "beam", "imo", "status"]
CTES["fleet"] = (
    _latest("vessels_typed1", "mmsi", ["ts"] + _FLEET_COLS[1:], _FLEET_COLS),
    ["vessels_typed1"],
)

ORACLE["port_statistics"] = sql("select * from port_stats", "port_stats")
ORACLE["ports_by_country"] = sql(
    "select country, count(port_id) as port_count from port_stats group by country order by port_count desc",
    "port_stats",
)
ORACLE["regional_ports"] = sql(
    f"""select region, count(port_id) as port_count, {R('avg(latitude)')} as avg_latitude,
    {R('avg(longitude)')} as avg_longitude
  from (select *, case when latitude > 60 then 'Northern Europe' when latitude > 50 then 'Central Europe'
                      when latitude > 40 then 'Mediterranean' else 'Other' end as region from port_stats)
  group by region order by port_count desc""",
    "port_stats",
)
ORACLE["vessel_fleet"] = sql("select * from fleet", "fleet")
ORACLE["vessels_by_type"] = sql(
    "select ship_type, count(mmsi) as vessel_count from fleet group by ship_type order by vessel_count desc", "fleet"
)
ORACLE["vessels_by_flag"] = sql(
    "select flag, count(mmsi) as vessel_count from fleet group by flag order by vessel_count desc", "fleet"
)
ORACLE["vessel_size_analysis"] = sql(
    f"""select ship_type, {R('avg(length)')} as avg_length, {R('max(length)')} as max_length,
    {R('avg(beam)')} as avg_beam, {R('avg(draft)')} as avg_draft, count(*) as vessel_count
  from fleet where length is not null and beam is not null group by ship_type order by vessel_count desc""",
    "fleet",
)
ORACLE["largest_vessels"] = sql(
    """select ship_name, ship_type, flag, status, imo, length, beam from fleet where length is not null
  order by length desc, imo asc limit 10""",
    "fleet",
)

# ------------------------------------------------------------------ AIS and movements


def _jnum(path: str) -> str:
    return f"try_cast(json_extract_string(value, '{path}') as double)"


CTES["ais_decoded"] = (
    f"""select event_id, value,
    json_extract_string(value, '$.MessageType') as message_type,
    json_extract_string(value, '$.Message.MessageID') as message_id,
    json_extract_string(value, '$.MetaData.MMSI') as mmsi,
    json_extract_string(value, '$.MetaData.ShipName') as ship_name,
    {_jnum('$.MetaData.latitude')} as latitude,
    {_jnum('$.MetaData.longitude')} as longitude,
    json_extract_string(value, '$.MetaData.time_utc') as time_utc,
    try_cast(json_extract_string(value, '$.MetaData.time_utc') as timestamp) as event_time,
    {_jnum('$.Message.PositionReport.Sog')} as speed_over_ground,
    {_jnum('$.Message.PositionReport.Cog')} as course_over_ground,
    {_jnum('$.Message.PositionReport.TrueHeading')} as heading
  from ais_raw""",
    ["ais_raw"],
)
CTES["positions"] = (
    "select * from ais_decoded where message_type = 'PositionReport' "
    "and coalesce(speed_over_ground, course_over_ground, heading) is not null",
    ["ais_decoded"],
)
_POS = "mmsi, ship_name, latitude, longitude, speed_over_ground, course_over_ground, heading"

ORACLE["ais_decode"] = sql(
    "select event_id, message_type, message_id, mmsi, ship_name, latitude, longitude, time_utc, "
    "speed_over_ground, course_over_ground, heading from ais_decoded",
    "ais_decoded",
)
ORACLE["ais_positions"] = sql(f"select {_POS} from positions", "positions")
ORACLE["ais_repr_positions"] = ORACLE["ais_positions"]
ORACLE["recent_positions"] = sql(
    f"""select {_POS}, time_utc from positions
  where cast(floor(epoch(event_time)) as bigint) >=
        (select max(cast(floor(epoch(event_time)) as bigint)) from positions) - 3600""",
    "positions",
)
ORACLE["bbox_filter"] = sql(
    f"select {_POS} from positions where latitude between 40.0 and 60.0 and longitude between -10.0 and 20.0",
    "positions",
)
ORACLE["speed_stats"] = sql(
    f"""select {R('avg(speed_over_ground)')} as avg_speed_kts, {R('max(speed_over_ground)')} as max_speed_kts,
    {R('min(speed_over_ground)')} as min_speed_kts from positions""",
    "positions",
)
ORACLE["vessel_speed_patterns"] = sql(
    f"""select mmsi, {R('avg(speed_over_ground)')} as avg_speed_kts, {R('max(speed_over_ground)')} as max_speed_kts,
    count(*) as position_reports
  from positions group by mmsi order by avg_speed_kts desc nulls last, mmsi asc limit 20""",
    "positions",
)
ORACLE["navigation_hotspots"] = sql(
    f"""select {R('latitude', 1)} as lat_zone, {R('longitude', 1)} as lon_zone, count(*) as vessel_count,
    {R('avg(speed_over_ground)')} as avg_speed
  from positions group by lat_zone, lon_zone
  order by vessel_count desc, lat_zone asc nulls first, lon_zone asc nulls first limit 20""",
    "positions",
)
ORACLE["movement_status"] = sql(
    """select movement_class, count(*) as position_reports, count(distinct mmsi) as unique_vessels
  from (select *, case when speed_over_ground < 0.5 then 'Anchored/Stationary'
                       when speed_over_ground < 5 then 'Slow Moving'
                       when speed_over_ground < 15 then 'Normal Transit' else 'High Speed' end as movement_class
        from positions)
  group by movement_class order by position_reports desc""",
    "positions",
)
CTES["ais_classified"] = (
    """select event_id, ts, value, case
      when value is null then 'no_value'
      when not json_valid(value) then 'bad_json'
      when json_extract(value, '$.error') is not null then 'error_frame'
      when not (coalesce(json_type(value, '$.Message') = 'OBJECT', false)
                and coalesce(json_type(value, '$.MetaData') = 'OBJECT', false)) then 'bad_structure'
      else 'ok' end as reason
  from ais_dirty""",
    ["ais_dirty"],
)
ORACLE["ais_rejects"] = sql(
    "select event_id, reason, value from ais_classified where reason <> 'ok'", "ais_classified"
)
ORACLE["ais_dedup"] = sql(
    "select min(event_id) as event_id, any_value(json_extract_string(value, '$.MessageType')) as message_type "
    "from ais_classified where reason = 'ok' group by replace(value, ' ', '')",
    "ais_classified",
)
CTES["counted"] = (
    """select json_extract_string(value, '$.MessageType') as message_type,
    case when own > ts + interval 5 minutes then ts else coalesce(own, ts) end as t
  from (select value, ts, try_cast(replace(json_extract_string(value, '$.MetaData.time_utc'), ' +0000 UTC', '') as timestamp) as own
    from ais_classified where reason = 'ok')""",
    ["ais_classified"],
)
ORACLE["message_type_counts"] = sql(
    """select to_timestamp(floor(epoch(t) / 900) * 900)::timestamp as window_start,
    to_timestamp(floor(epoch(t) / 900) * 900 + 900)::timestamp as window_end,
    coalesce(message_type, 'Unknown') as message_type, count(*) as message_count
  from counted group by all""",
    "counted",
)
ORACLE["sql_extractors"] = sql(
    f"""select event_id, {_jnum('$.Message.PositionReport.Sog')} as sog, {_jnum('$.Message.PositionReport.Cog')} as cog,
    {_jnum('$.Message.PositionReport.TrueHeading')} as heading from ais_raw""",
    "ais_raw",
)

# ------------------------------------------------------------------ safety and port visits

# Every position against every port; the least distance, then the least id.
CTES["near_all"] = (
    f"""select p.event_id, p.mmsi, p.event_time, epoch_us(p.event_time) as us, p.latitude, p.longitude, q.port_id,
    round(2 * {EARTH_KM} * asin(sqrt(least(1.0, pow(sin(radians(q.latitude - p.latitude) / 2), 2)
      + cos(radians(p.latitude)) * cos(radians(q.latitude)) * pow(sin(radians(q.longitude - p.longitude) / 2), 2)))), 6) as km
  from positions p join port_stats q on q.latitude is not null and q.longitude is not null""",
    ["positions", "port_stats"],
)


def _near(km: float) -> str:
    return f"""select p.event_id, p.mmsi, p.event_time, epoch_us(p.event_time) as us, p.latitude, p.longitude, n.port_id, n.km
  from positions p left join (
    select event_id, arg_min(port_id, (km, port_id)) as port_id, min(km) as km from near_all where km <= {km} group by event_id) n
  on n.event_id = p.event_id"""


CTES["near_ports"] = (_near(safety.REACH_KM), ["near_all", "positions"])
ORACLE["nearest_ports"] = sql(f"select event_id, mmsi, port_id, {R('km', 3)} as distance_km from near_ports", "near_ports")

CTES["known_hours"] = (
    f"""select port_id, ref_time, forecast_timestamp, {', '.join(safety.CONDITIONS)}
  from forecast_clean where port_id is not null and ref_time is not null and forecast_timestamp is not null
  qualify row_number() over (partition by port_id, ref_time, forecast_timestamp
    order by {', '.join(f'{c} desc nulls last' for c in safety.CONDITIONS)}) = 1""",
    ["forecast_clean"],
)
CTES["at_run"] = (
    """select n.*, r.ref_time from near_ports n asof left join (select distinct port_id, ref_time, ref_time * 1000000 as run_us from known_hours) r
  on r.port_id = n.port_id and n.us >= r.run_us""",
    ["near_ports", "known_hours"],
)
CTES["at_back"] = (
    """select a.event_id, h.forecast_timestamp as back from at_run a asof left join (select *, forecast_timestamp * 1000000 as h_us from known_hours) h
  on h.port_id = a.port_id and h.ref_time = a.ref_time and a.us >= h.h_us""",
    ["at_run", "known_hours"],
)
CTES["at_ahead"] = (
    """select a.event_id, h.forecast_timestamp as ahead from at_run a asof left join (select *, forecast_timestamp * 1000000 as h_us from known_hours) h
  on h.port_id = a.port_id and h.ref_time = a.ref_time and a.us <= h.h_us""",
    ["at_run", "known_hours"],
)
CTES["at_hour"] = (
    f"""select a.*, case when ahead is null or us - back * 1000000 <= ahead * 1000000 - us then back else ahead end as hour_at
  from at_run a join at_back using (event_id) join at_ahead using (event_id)""",
    ["at_run", "at_back", "at_ahead"],
)
CTES["at_forecast"] = (
    f"""select a.event_id, a.mmsi, a.latitude, a.longitude, a.port_id, a.km, a.ref_time, h.forecast_timestamp, {', '.join(f'h.{c}' for c in safety.CONDITIONS)}
  from at_hour a left join known_hours h on h.port_id = a.port_id and h.ref_time = a.ref_time and h.forecast_timestamp = a.hour_at
    and abs(a.us - a.hour_at * 1000000) <= {safety.TOLERANCE_SECONDS * 1000000}""",
    ["at_hour", "known_hours"],
)
ORACLE["forecast_at_positions"] = sql(
    f"select event_id, port_id, ref_time, forecast_timestamp, {', '.join(safety.CONDITIONS)} from at_forecast", "at_forecast"
)
ORACLE["dangerous_positions"] = sql(
    f"""select event_id, mmsi, latitude, longitude, port_id, {R('km', 3)} as distance_km, ref_time, forecast_timestamp,
    {', '.join(f'{R(c)} as {c}' for c in safety.CONDITIONS)}
  from at_forecast where port_id is not null and (wave_height > 4.0 or ocean_current_velocity > 1.5
    or sea_surface_temperature < 0 or sea_surface_temperature > 35)""",
    "at_forecast",
)

# A vessel's state after each position, by windows over its whole history.
CTES["near_track"] = (_near(visits.LEAVE_KM), ["near_all", "positions"])
CTES["track"] = (
    f"""select mmsi, event_time, event_id, port_id, case when port_id is null then 'out' when km <= {visits.ENTER_KM} then 'in' else 'near' end as kind,
    lag(port_id) over w as prev
  from near_track where mmsi is not null and event_time is not null and latitude is not null and longitude is not null
  window w as (partition by mmsi order by event_time, event_id)""",
    ["near_track"],
)
CTES["track_state"] = (
    """select *, coalesce(last_value(becomes ignore nulls) over (partition by mmsi order by event_time, event_id rows unbounded preceding), '') as state
  from (select *, case when kind = 'in' then port_id when kind = 'near' and prev = port_id then null else '' end as becomes from track)""",
    ["track"],
)
CTES["moves"] = (
    """select *, row_number() over (partition by mmsi order by event_time, event_id) as k
  from (select *, coalesce(lag(state) over (partition by mmsi order by event_time, event_id), '') as before from track_state)
  where state <> before""",
    ["track_state"],
)
CTES["stays"] = (
    """select a.mmsi, a.state as port_id, a.event_time as arrival, b.event_time as departure
  from moves a left join moves b on b.mmsi = a.mmsi and b.k = a.k + 1 where a.state <> ''""",
    ["moves"],
)
ORACLE["port_stays"] = sql("select * from stays", "stays")
ORACLE["port_throughput"] = sql(
    f"""select port_id, hour, sum(came) as arrivals, sum(1 - came) as departures, {R('avg(hours)')} as mean_stay_hours
  from (select port_id, date_trunc('hour', arrival) as hour, 1 as came, cast(null as double) as hours from stays
    union all select port_id, date_trunc('hour', departure), 0, (epoch_us(departure) - epoch_us(arrival)) / 3.6e9 from stays where departure is not null)
  group by port_id, hour""",
    "stays",
)
CTES["port_hours"] = (
    """select port_id, unnest(range(date_trunc('hour', min(t)), date_trunc('hour', max(t)) + interval 1 hour, interval 1 hour)) as hour
  from (select port_id, arrival as t from stays where departure is null or departure > arrival
    union all select port_id, departure from stays where departure > arrival) group by port_id""",
    ["stays"],
)
# Vessels in port as each hour begins and at every arrival within it.
CTES["port_moments"] = (
    """select port_id, hour, hour as t from port_hours
  union all select port_id, date_trunc('hour', arrival), arrival from stays where departure is null or departure > arrival""",
    ["port_hours", "stays"],
)
CTES["port_levels"] = (
    """select m.port_id, m.hour, m.t, count(s.mmsi) as n from port_moments m
  left join stays s on s.port_id = m.port_id and s.arrival <= m.t and (s.departure is null or s.departure > m.t)
  group by all""",
    ["port_moments", "stays"],
)
ORACLE["berth_demand"] = sql(
    """select l.port_id, l.hour, max(n) as peak, any_value(try_cast(p.berths as bigint)) as berths,
    case when any_value(try_cast(p.berths as bigint)) is not null then greatest(0, max(n) - any_value(try_cast(p.berths as bigint))) end as waiting
  from port_levels l left join port_stats p on p.port_id = l.port_id group by l.port_id, l.hour""",
    "port_levels", "port_stats",
)
CTES["levels"] = (
    """select port_id, forecast_timestamp as t, max(sea_level_height_msl) as level from forecast_latest
  where port_id is not null and forecast_timestamp is not null and sea_level_height_msl is not null group by all""",
    ["forecast_latest"],
)
CTES["steps"] = (
    """select port_id, t, level, level - prev as rise from (select *, lag(level) over (partition by port_id order by t) as prev from levels)
  where prev is null or prev <> level""",
    ["levels"],
)
CTES["turns"] = (
    """select port_id, t, level, case when rise > 0 then 'high' else 'low' end as kind
  from (select *, lead(rise) over (partition by port_id order by t) as after from steps) where sign(rise) * sign(after) < 0""",
    ["steps"],
)
ORACLE["tide_at_arrival"] = sql(
    f"""select s.mmsi, s.port_id, s.arrival, case when n.kind = 'high' then 'rising' else 'falling' end as tide,
    {R('(n.t * 1000000 - epoch_us(s.arrival)) / 3.6e9')} as hours_to_turn, n.kind as turn, {R('n.level')} as turn_level
  from stays s
  asof join (select port_id, t * 1000000 as us from turns) l on l.port_id = s.port_id and epoch_us(s.arrival) >= l.us
  asof join (select *, t * 1000000 as us from turns) n on n.port_id = s.port_id and epoch_us(s.arrival) <= n.us""",
    "stays", "turns",
)

# ------------------------------------------------------------------ ingest transforms

_HOURLY = ",\n    ".join(f"{fx.hourly_value(f, 's_suppkey', 'i')} as {f}" for f in WEATHER_FIELDS)
ORACLE["forecast_unnest"] = sql(
    f"""select concat('P', cast(s_suppkey as varchar), '-', '1704067200', '-', cast(1704067200 + i * 3600 as varchar)) as id,
    concat('P', cast(s_suppkey as varchar)) as port_id, s_name as port_name,
    {fx.PORT_LATITUDE} as latitude, {fx.PORT_LONGITUDE} as longitude,
    cast(1704067200 as bigint) as ref_time, cast(1704067200 + i * 3600 as bigint) as forecast_timestamp, {_HOURLY}
  from (select s_suppkey, s_name, unnest(range(72)) as i from supplier)"""
)
_PLACE_JSON = (
    "concat('{\"port_id\":\"P', s_suppkey, '\",\"port_name\":\"', s_name, '\",\"latitude\":\"', "
    f"{fx.PORT_LATITUDE}, '\",\"longitude\":\"', {fx.PORT_LONGITUDE}, '\"'"
)
_HOURLY_JSON = ", ',', ".join(
    f"'\"{f}\":[', array_to_string(list_transform(range({fx.FORECAST_STEPS}), lambda i: cast({fx.hourly_value(f, 's_suppkey', 'i')} as varchar)), ','), ']'"
    for f in WEATHER_FIELDS
)
ORACLE["forecast_rejects"] = sql(
    f"""with t as (
    select s_suppkey, {_PLACE_JSON}, case when s_suppkey % 43 <> 0 then concat(
        ',"hourly":{{"start":{fx.FORECAST_T0},', case when s_suppkey % 47 <> 0 then '"interval":{fx.FORECAST_STEP},' end,
        '"end":{fx.FORECAST_T0 + fx.FORECAST_STEPS * fx.FORECAST_STEP},', {_HOURLY_JSON}, '}}') end, '}}') as payload
    from supplier where s_suppkey % 41 = 0 or s_suppkey % 43 = 0 or s_suppkey % 47 = 0)
  select case when s_suppkey % 41 = 0 then 'unparseable' else 'incomplete' end as reason,
    case when s_suppkey % 41 = 0 then substring(payload, 1, 30) else payload end as payload from t"""
)
ORACLE["current_rejects"] = sql(
    f"""with t as (
    select s_suppkey, {_PLACE_JSON}, '}}') as payload from supplier where s_suppkey % 53 = 0 or s_suppkey % 59 = 0)
  select case when s_suppkey % 59 = 0 then 'unparseable' else 'incomplete' end as reason,
    case when s_suppkey % 59 = 0 then substring(payload, 1, 30) else payload end as payload from t"""
)

_RAW_FORECAST_COLS = [e.rsplit(" as ", 1)[1] for e in fx.FORECAST_RAW]
ORACLE["forecast_upsert"] = sql(
    _latest(
        "forecast_raw", "id",
        ["seq1", "seq2"] + [c for c in _RAW_FORECAST_COLS if c != "id"],
        _RAW_FORECAST_COLS,
    ),
    "forecast_raw",
)

_PORT_CELLS = [
    ("port_id", "info", "port_id"), ("port_name", "info", "name"), ("country", "info", "country"),
    ("berths", "info", "berths"), ("un_locode", "info", "un_locode"), ("latitude", "info", "lat"),
    ("longitude", "info", "long"), ("timestamp", "meta_data", "timestamp"),
]
CTES["cells"] = (
    "select * from ("
    + " union all ".join(
        f"select port_id as row_key, '{fam}' as family, '{q}' as qualifier, {c} as value, "
        "try_cast(timestamp as bigint) as cell_ts from ports_raw"
        for c, fam, q in _PORT_CELLS
    )
    + ") where value is not null",
    ["ports_raw"],
)
ORACLE["rows_to_cells"] = sql("select * from cells", "cells")
ORACLE["cells_to_rows"] = sql(
    "select row_key as id, "
    + ", ".join(
        f"max(case when family = '{fam}' and qualifier = '{q}' then value end) as {c}" for c, fam, q in _PORT_CELLS
    )
    + " from (select *, row_number() over (partition by row_key, family, qualifier "
    "order by cell_ts desc nulls last, value desc) as rn from cells) where rn = 1 group by row_key",
    "cells",
)
ORACLE["registry_explode"] = sql(
    "select port_id, port_name, country, berths, un_locode, latitude, longitude from ports_raw "
    "where timestamp = '1704067200'",
    "ports_raw",
)
ORACLE["vessel_registry_explode"] = sql(
    "select mmsi, ship_name, ship_type, flag, length, width, draft, beam, imo, status from vessels_raw "
    "where timestamp = '1704067200'",
    "vessels_raw",
)
_CURRENT = ",\n    ".join(f"{fx.current_value(f, 's_suppkey')} as {f}" for f in WEATHER_FIELDS)
ORACLE["current_weather_rows"] = sql(
    f"""select concat('P', cast(s_suppkey as varchar), '-', cast(1704067200 + (s_suppkey % 24) * 3600 as varchar)) as id,
    concat('P', cast(s_suppkey as varchar)) as port_id, s_name as port_name,
    {fx.PORT_LATITUDE} as latitude, {fx.PORT_LONGITUDE} as longitude,
    cast(1704067200 + (s_suppkey % 24) * 3600 as bigint) as timestamp, {_CURRENT}
  from supplier where s_suppkey % 53 <> 0 and s_suppkey % 59 <> 0"""
)
ORACLE["registry_snapshot"] = sql(
    "select concat(port_id, '-1704067200000') as id, port_id, port_name, country, berths, un_locode, latitude, longitude, "
    "'1704067200' as timestamp from ports_raw where timestamp = '1704067200'",
    "ports_raw",
)
ORACLE["registry_errors"] = sql(
    """with pages as (select distinct floor(s_suppkey / 100) as page from supplier)
  select 'unparseable' as reason, cast(null as varchar) as error, count(*) as responses from pages
  union all select 'no_data', null, count(*) from pages
  union all select 'api_error', concat('quota ', cast(cast(page as bigint) as varchar)), count(*) from pages group by page"""
)

# ------------------------------------------------------------------ profiles

ORACLE["load_profile"] = sql(
    """select 'forecast_loaded' as stage, count(*) as row_count from forecast_raw
  union all select 'forecast_latest_run', count(*) from forecast_latest
  union all select 'ports_loaded', count(*) from ports_raw
  union all select 'ports_unique', count(distinct port_id) from ports_raw
  union all select 'vessels_loaded', count(*) from vessels_raw
  union all select 'vessels_unique', count(distinct mmsi) from vessels_raw
  union all select 'ais_loaded', count(*) from ais_decoded
  union all select 'ais_position_reports', count(*) from ais_decoded where message_type = 'PositionReport'
  union all select 'ais_valid_movements', count(*) from positions""",
    "forecast_raw", "forecast_latest", "ports_raw", "vessels_raw", "ais_decoded", "positions",
)
