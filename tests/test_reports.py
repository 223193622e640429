"""Report edge cases: thresholds, one-row stddev, unmatched ports, snapshots."""

import pytest

from tidewater.plans import fleet, weather

FORECAST_COLS = [
    "id", "port_id", "latitude", "longitude", "ref_time", "forecast_timestamp", "wave_height",
    "ocean_current_velocity", "sea_surface_temperature", "swell_wave_height", "wind_wave_height",
]
PORT_SCHEMA = (
    "port_id string, port_name string, country string, berths string, un_locode string, "
    "latitude string, longitude string, timestamp string"
)


def forecast(spark, rows):
    """rows: (port_id, ref_time, wave, current, temp) as text."""
    data = [
        (f"{p}-{r}-{i}", p, "50.0", "1.0", r, str(int(r) + 3600 * i), w, c, t, "1.0", "0.5")
        for i, (p, r, w, c, t) in enumerate(rows)
    ]
    raw = spark.createDataFrame(data, ", ".join(f"{c} string" for c in FORECAST_COLS))
    return weather.prepare_forecast(raw)


def ports(spark, rows):
    return weather.latest_ports(spark.createDataFrame(rows, PORT_SCHEMA))


@pytest.fixture
def two_ports(spark):
    return ports(
        spark,
        [
            ("P1", "Old Name", "NO", "1", "X1", "60.0", "5.0", "100"),
            ("P1", "Harbor One", "NO", "2", "X1", "60.0", "5.0", "200"),
            ("P2", "Harbor Two", "nan", "3", "X2", "40.0", "1.0", "100"),
        ],
    )


def test_storm_threshold_is_strict(spark, two_ports):
    f = forecast(spark, [("P1", "10", "3.0", "0", "10"), ("P1", "10", "3.01", "0", "10"), ("P1", "10", "nan", "0", "10")])
    rows = weather.storm_detection(f, two_ports).collect()
    assert [r.wave_height for r in rows] == [3.01]
    assert rows[0].port_name == "Harbor One"  # newest snapshot's name
    assert rows[0].forecast_time == "1970-01-01 01:00:10"


def test_hazard_edges_all_dropped_and_one_null_kept(spark, two_ports):
    edges = [("P1", "10", "4.0", "1.5", "0"), ("P1", "10", "1.0", "1.0", "35")]
    f = forecast(spark, edges + [("P2", "10", "None", "1.6", "None")])
    rows = weather.hazardous_ports(f, two_ports).collect()
    assert [(r.port_id, r.hazard_count, r.max_wave_height, r.max_current_velocity) for r in rows] == [
        ("P2", 1, None, 1.6)
    ]


def test_one_row_stddev_is_null(spark, two_ports):
    f = forecast(spark, [("P1", "10", "1.0", "0.5", "12.5")])
    row = weather.temperature_analysis(f, two_ports).collect()[0]
    assert row.avg_temp == 12.5 and row.temp_stddev is None


def test_port_without_registry_row_kept_with_null_name(spark, two_ports):
    f = forecast(spark, [("P9", "10", "1.0", "0.5", "12.5")])
    rows = weather.weather_port_summary(f, two_ports).collect()
    assert len(rows) == 1 and rows[0].port_id == "P9" and rows[0].port_name is None


def test_two_snapshots_do_not_double_counts(spark, two_ports):
    f = forecast(spark, [("P1", "10", "1.0", "0.5", "12.5"), ("P1", "10", "2.0", "0.5", "12.5")])
    row = weather.weather_port_summary(f, two_ports).collect()[0]
    assert row.forecast_records == 2 and row.avg_wave_height == 1.5


def test_only_newest_run_is_reported(spark, two_ports):
    f = forecast(spark, [("P1", "10", "9.0", "0.5", "12.5"), ("P1", "20", "1.0", "0.5", "12.5")])
    row = weather.weather_port_summary(f, two_ports).collect()[0]
    assert row.max_wave_height == 1.0 and row.forecast_records == 1


def test_country_comparison_drops_null_country(spark):
    raw_ports = spark.createDataFrame(
        [("P1", "A", "NO", "1", "X", "1", "1", "1"), ("P2", "B", "NaN", "1", "X", "1", "1", "1")], PORT_SCHEMA
    )
    clean = weather.latest_ports(raw_ports, sentinels=("nan", "NaN", "Nan", "NAN", "None"))
    f = forecast(spark, [("P1", "10", "1.0", "0.5", "10"), ("P1", "10", "2.0", None, "20"), ("P2", "10", "5", "1", "1")])
    rows = weather.regional_weather_comparison(f, clean).collect()
    assert [(r.country, r.avg_wave_height, r.avg_current, r.avg_temperature, r.total_measurements) for r in rows] == [
        ("NO", 1.5, 0.5, 15.0, 2)
    ]


def test_registry_reports_keep_none_text_group(spark):
    raw = spark.createDataFrame(
        [
            ("P1", "A", "None", "1", "X", "45.0", "1", "1"),
            ("P2", "B", "nan", "1", "X", "nan", "1", "1"),
            ("P3", "C", "NO", "1", "X", "61", "1", "1"),
        ],
        PORT_SCHEMA,
    )
    stats = fleet.port_statistics(raw)
    by_country = {r.country: r.port_count for r in fleet.ports_by_country(stats).collect()}
    assert by_country == {"None": 1, None: 1, "NO": 1}
    regions = {r.region: r.port_count for r in fleet.regional_ports(stats).collect()}
    assert regions == {"Mediterranean": 1, "Other": 1, "Northern Europe": 1}


def test_largest_vessels_tie_break_by_imo(spark):
    schema = (
        "mmsi string, ship_name string, ship_type string, flag string, length string, width string, "
        "draft string, beam string, imo string, status string, timestamp string"
    )
    rows = [(str(i), f"S{i}", "Cargo", "F", "300", "1", "1", "1", str(100 - i), "0", "1") for i in range(12)]
    rows.append(("99", "S99", "Cargo", "F", "nan", "1", "1", "1", "1", "0", "1"))
    out = fleet.largest_vessels(fleet.vessel_fleet(spark.createDataFrame(rows, schema))).collect()
    assert len(out) == 10 and [r.imo for r in out] == sorted(r.imo for r in out)
    assert "1" not in {r.imo for r in out}  # null length excluded


def test_bands_partition_all_rows(spark):
    from tidewater.plans import movement
    from tidewater.queries import QUERIES
    from tidewater.sources import fixtures as fx
    from tidewater.streaming.ais import decode_ais

    from .conftest import SF_SMALL

    stats = fleet.port_statistics(fx.ports_raw(spark, SF_SMALL))
    regions = fleet.regional_ports(stats).agg({"port_count": "sum"}).collect()[0][0]
    assert regions == stats.count()
    pos = movement.positions(decode_ais(fx.ais_raw(spark, SF_SMALL)))
    classes = movement.movement_status(pos).agg({"position_reports": "sum"}).collect()[0][0]
    assert classes == pos.count() == QUERIES["ais_positions"](spark, SF_SMALL).count()


def test_circular_direction_mean_is_optional(spark, two_ports):
    data = [
        (f"P1-10-{i}", "P1", "50.0", "1.0", "10", str(i), "1.0", "0.5", "12.5", "1.0", "0.5", d, d)
        for i, d in enumerate(["350", "10"])
    ]
    cols = FORECAST_COLS + ["wind_wave_direction", "ocean_current_direction"]
    f = weather.prepare_forecast(spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols)))
    plain = weather.weather_port_summary(f, two_ports).collect()[0]
    assert plain.avg_wind_direction == 180.0 and "circ_wind_direction" not in plain.asDict()
    circ = weather.weather_port_summary(f, two_ports, circular=True).collect()[0]
    assert circ.circ_wind_direction == 0.0 and circ.circ_current_direction == 0.0
