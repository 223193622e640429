"""Hand-written edge cases for the column functions (FIXTURES.md part C)."""

import pytest
from pyspark.sql import functions as F

from tidewater.functions.clean import (
    REGISTRY_SENTINELS,
    WEATHER_SENTINELS,
    epoch_to_time,
    null_sentinels,
    parse_ais_time,
    parse_repr,
    round_half_up,
    to_number,
)
from tidewater.functions.geo import (
    latitude_region,
    movement_class,
    parse_bbox,
    within_bbox,
)
from tidewater.streaming.ais import POSITION_SCHEMA

SPELLINGS = ["nan", "NaN", "Nan", "NAN", "None", "null", "1.5"]


def test_one_value_list_clears_only_exact_nan(spark):
    df = spark.createDataFrame([(s,) for s in SPELLINGS], "v string")
    out = [r.v for r in null_sentinels(df, REGISTRY_SENTINELS).collect()]
    assert out == [None, "NaN", "Nan", "NAN", "None", "null", "1.5"]


def test_five_value_list_clears_five_spellings(spark):
    df = spark.createDataFrame([(s,) for s in SPELLINGS], "v string")
    out = [r.v for r in null_sentinels(df, WEATHER_SENTINELS).collect()]
    assert out == [None, None, None, None, None, "null", "1.5"]


def test_non_string_columns_untouched(spark):
    df = spark.createDataFrame([("nan", 1)], "a string, b int")
    row = null_sentinels(df, WEATHER_SENTINELS).collect()[0]
    assert row.a is None and row.b == 1


@pytest.mark.parametrize("text", ["None", "", "abc", None])
def test_uncastable_text_is_null_not_an_error(spark, text):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(to_number("v")).collect()[0][0] is None
    assert df.select(to_number("v", "bigint")).collect()[0][0] is None


def test_rounding_is_half_up_and_stable(spark):
    df = spark.createDataFrame([(1.005,), (11.175,), (-2.345,), (None,), (float("nan"),), (1e30,)], "x double")
    out = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert out[0] == 1.01 and out[1] == 11.18 and out[2] == -2.35
    assert out[3] is None
    assert out[4] != out[4]  # NaN passes through
    assert out[5] == 1e30  # out of decimal range: plain rounding


def test_epoch_to_time_text(spark):
    df = spark.createDataFrame([("1704067200",), ("x",)], "t string")
    assert [r[0] for r in df.select(epoch_to_time("t")).collect()] == ["2024-01-01 00:00:00", None]


def test_parse_ais_time_feed_format(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:07.179575 +0000 UTC",), ("2024-01-01 00:03:52.8",)], "t string")
    out = df.select(F.date_format(parse_ais_time("t"), "yyyy-MM-dd HH:mm:ss.SSS")).collect()
    assert [r[0] for r in out] == ["2024-01-01 00:00:07.179", "2024-01-01 00:03:52.800"]


def test_parse_repr_python_literals(spark):
    df = spark.createDataFrame(
        [("{'Sog': 12.3, 'Valid': True, 'X': None, 'Cog': 4}",), ("{'Sog': None, 'TrueHeading': 511}",)], "r string"
    )
    rows = df.select(parse_repr("r", POSITION_SCHEMA).alias("p")).select("p.*").collect()
    assert rows[0].Sog == 12.3 and rows[0].Cog == 4.0 and rows[0].TrueHeading is None
    assert rows[1].Sog is None and rows[1].TrueHeading == 511.0


def test_latitude_band_edges(spark):
    lats = [40.0, 40.01, 50.0, 50.01, 60.0, 60.01, None]
    df = spark.createDataFrame([(x,) for x in lats], "lat double")
    out = [r[0] for r in df.select(latitude_region("lat")).collect()]
    assert out == [
        "Other", "Mediterranean", "Mediterranean", "Central Europe", "Central Europe", "Northern Europe", "Other",
    ]


def test_speed_band_edges(spark):
    speeds = [0.49, 0.5, 5.0, 15.0, None, float("nan")]
    df = spark.createDataFrame([(x,) for x in speeds], "s double")
    out = [r[0] for r in df.select(movement_class("s")).collect()]
    assert out == [
        "Anchored/Stationary", "Slow Moving", "Normal Transit", "High Speed", "High Speed", "High Speed",
    ]


def test_bbox_parse_and_edges(spark):
    box = parse_bbox("[[[-10, 20], [40, 60]]]")
    assert (box.min_lon, box.max_lon, box.min_lat, box.max_lat) == (-10, 20, 40, 60)
    for text, said in (
        ("not a box", "not JSON"), ("[]", "one list"), ("[[[1, 2]]]", "one list"), ("{}", "one list"), ("[[[1, 2], [3, 4]], [[1, 2], [3, 4]]]", "one list"),
        ('[[["1", 2], [3, 4]]]', "finite"), ("[[[NaN, 2], [3, 4]]]", "finite"), ("[[[true, 2], [3, 4]]]", "finite"),
        ("[[[20, -10], [40, 60]]]", "backwards"), ("[[[-10, 20], [40, 91]]]", "leaves"), ("[[[-181, 20], [40, 60]]]", "leaves"),
    ):
        with pytest.raises(ValueError, match=said):
            parse_bbox(text)
    df = spark.createDataFrame(
        [(40.0, -10.0), (60.0, 20.0), (39.99, 0.0), (50.0, 20.01), (None, 0.0)], "latitude double, longitude double"
    )
    assert within_bbox(df, box).count() == 2


def test_registry_rows_get_fetch_time_and_snapshot_key(spark):
    from tidewater.sources.catalog import PORTS
    from tidewater.sources.payloads import explode_registry

    payloads = spark.createDataFrame(
        [('{"error": null, "data": [{"port_id": "P1", "name": "Harbor", "lat": 1.5}]}',), ('{"error": "quota"}',)],
        "payload string",
    )
    rows, errors = explode_registry(payloads, PORTS, fetched_at=1704067200)
    row = rows.collect()[0]
    assert (row.id, row.port_id, row.port_name, row.latitude, row.timestamp) == (
        "P1-1704067200000", "P1", "Harbor", "1.5", "1704067200",
    )
    assert [(r.reason, r.error) for r in errors.collect()] == [("api_error", "quota")]


def test_registry_errors_by_what_they_say(spark):
    from tidewater.sources.catalog import PORTS
    from tidewater.sources.payloads import explode_registry

    said = {"null": 0, "false": 0, '""': 0, "0": 0, "0.0": 0, "[]": 0, "{}": 0, '"x"': 1, "true": 1, "1": 1, '"false"': 1, '"0"': 1, '["a"]': 1, '{"a": 1}': 1}
    body = ', "data": [{"port_id": "P1"}]}'
    texts = ['{"error": ' + e + body for e in said] + ['{"data": []}', '{"data": [{"port_id"', "", None, "[1]", '{"error": null}']
    d = spark.createDataFrame([(t,) for t in texts], "payload string")
    rows, errors = explode_registry(d, PORTS)
    assert rows.count() == sum(not v for v in said.values())
    got = {r.payload: r.reason for r in errors.collect()}
    want = {'{"error": ' + e + body: "api_error" for e, v in said.items() if v}
    assert got == {**want, '{"data": [{"port_id"': "unparseable", "": "unparseable", None: "unparseable", "[1]": "unparseable", '{"error": null}': "no_data"}


def test_forecast_and_current_rejects(spark):
    from tidewater.sources.payloads import explode_current, explode_forecast, split_forecast

    good = '{"port_id": "P1", "latitude": "1.5", "longitude": "2", "hourly": {"start": 0, "interval": 3600, "end": 7200, "wave_height": [1.0, 2.0, 3.0]}}'
    bad = {good[:40]: "unparseable", '{"port_id": "P2"}': "incomplete", good.replace("3600", "0"): "incomplete", good.replace('"P1"', "null"): "incomplete", None: "unparseable"}
    d = spark.createDataFrame([(t,) for t in [good, *bad]], "payload string")
    documents, rejects = split_forecast(d)
    assert {r.payload: r.reason for r in rejects.collect()} == bad
    rows = explode_forecast(documents).collect()
    assert [(r.id, r.latitude, r.longitude, r.wave_height, r.sea_surface_temperature) for r in rows] == [
        ("P1-0-0", "1.5", "2", 1.0, None), ("P1-0-3600", "1.5", "2", 2.0, None),
    ]
    now = '{"port_id": "P1", "latitude": "1.5", "current": {"time": 5, "wave_height": 2.5}}'
    d = spark.createDataFrame([(now,), (now[:30],), ('{"port_id": "P2"}',)], "payload string")
    rows, rejects = explode_current(d)
    assert [(r.id, r.latitude, r.longitude, r.wave_height) for r in rows.collect()] == [("P1-5", "1.5", None, 2.5)]
    assert sorted(r.reason for r in rejects.collect()) == ["incomplete", "unparseable"]


def test_repr_literals_escapes_and_quotes(spark):
    from tidewater.functions.sql import register_sql_functions

    schema = "Sog double, Cog double, TrueHeading double, note string, ok boolean"
    gap = " " * 40
    texts = {
        "{'Sog': 1.5, 'Cog':" + gap + "None, 'ok': True}": (1.5, None, None, True),
        "{'Sog': 2.0, 'note': 'a, None, b: True'}": (2.0, None, "a, None, b: True", None),
        "{'Sog': 3.0, 'note': \"it's, None\", 'ok': False}": (3.0, None, "it's, None", False),
        "{'Sog': 4.0, 'note': 'a\\x1bb'}": (4.0, None, "a\x1bb", None),
        "{'Sog': 5.0, 'note': 'a\\'s, None', 'Cog': None}": (5.0, None, "a's, None", None),
        "{'Sog': None, 'Cog': 6.0, 'note': None}": (None, 6.0, None, None),
    }
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.p for r in d.select("t", parse_repr("t", schema).alias("p")).collect()}
    assert {t: (p.Sog, p.Cog, p.note, p.ok) for t, p in got.items()} == texts
    register_sql_functions(spark)
    got = {r.t: (r.s, r.c) for r in d.selectExpr("t", "extract_sog(t) s", "extract_cog(t) c").collect()}
    assert got == {t: v[:2] for t, v in texts.items()}


def test_catalog_reads_what_a_table_has(spark):
    from tidewater.plans import fleet, weather
    from tidewater.sources.catalog import PORTS

    d = spark.createDataFrame([("P1", None, "Harbor", "9"), ("P2", "Pier", "x", "9")], "port_id string, port_name string, name string, timestamp string")
    stats = {r.port_id: r for r in fleet.port_statistics(d).collect()}
    assert stats["P1"].port_name == "Harbor" and stats["P2"].port_name == "Pier" and stats["P1"].country is None
    assert weather.latest_ports(d.drop("port_name")).filter("port_name = 'x'").count() == 1
    assert fleet.vessel_fleet(spark.createDataFrame([("1", "9")], "mmsi string, timestamp string")).first().length is None
    assert PORTS.project(d, ["country", "port_id"]).columns == ["port_id", "country"]
    with pytest.raises(ValueError):
        PORTS.project(d, ["berth"])


from decimal import ROUND_HALF_UP, Decimal  # noqa: E402

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-10_000_000, 10_000_000), min_size=1, max_size=40))
def test_rounding_matches_decimal_half_up(spark, thousandths):
    """Values with three decimals (ties at .xx5 included) round like exact
    decimal half-up rounding of their shortest text."""
    values = [t / 1000 for t in thousandths]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    want = [float(Decimal(repr(v)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for v in values]
    assert got == want
