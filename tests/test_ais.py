"""AIS decode, reject routing, replay-safe keys and movement reports."""

import json

from tidewater.plans import movement
from tidewater.streaming.ais import decode_ais, dedupe_messages, route_invalid


def msg(mid=7, sog=12.3, cog=45.0, hdg=90, mmsi=200000001, mtype="PositionReport", t="2024-01-01 00:00:07.5"):
    body = {"Sog": sog, "Cog": cog, "TrueHeading": hdg}
    return json.dumps(
        {
            "MessageType": mtype,
            "Message": {"MessageID": mid, mtype: body},
            "MetaData": {"MMSI": mmsi, "ShipName": "V1", "latitude": 51.234, "longitude": 3.21, "time_utc": t},
        }
    )


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "event_id long, value string")


def test_decode_fields(spark):
    row = decode_ais(frame(spark, [msg()])).collect()[0]
    assert (row.message_type, row.message_id, row.mmsi, row.ship_name) == ("PositionReport", "7", "200000001", "V1")
    assert (row.latitude, row.longitude, row.speed_over_ground, row.course_over_ground, row.heading) == (
        51.234, 3.21, 12.3, 45.0, 90.0,
    )


def test_reject_reasons(spark):
    values = [
        None,
        "not json",
        '{"error":"overload"}',
        '{"MessageType":"PositionReport","Message":[],"MetaData":{}}',
        '{"MessageType":"PositionReport","Message":{"MessageID":1}}',
        msg(),
    ]
    good, rejects = route_invalid(frame(spark, values))
    reasons = {r.event_id: r.reason for r in rejects.collect()}
    assert reasons == {0: "no_value", 1: "bad_json", 2: "error_frame", 3: "bad_structure", 4: "bad_structure"}
    assert [r.event_id for r in good.collect()] == [5]


def test_replays_and_reencodings_collapse_to_one_row(spark):
    m = msg(mid=None)
    reencoded = json.dumps(json.loads(m), indent=1, sort_keys=True)
    out = dedupe_messages(frame(spark, [m, m, reencoded, msg(mid=None, sog=1.0)])).collect()
    assert len(out) == 2
    assert all(r.message_key.startswith("unknown-") for r in out)


def test_unavailable_codes_kept_by_default_and_droppable(spark):
    df = frame(spark, [msg(sog=102.3, cog=360.0, hdg=511)])
    kept = decode_ais(df).collect()[0]
    assert (kept.speed_over_ground, kept.course_over_ground, kept.heading) == (102.3, 360.0, 511.0)
    dropped = decode_ais(df, drop_unavailable=True).collect()[0]
    assert (dropped.speed_over_ground, dropped.course_over_ground, dropped.heading) == (None, None, None)
    # all three unavailable -> not a movement record
    assert movement.positions(decode_ais(df, drop_unavailable=True)).count() == 0


def test_empty_input_gives_empty_reports(spark):
    pos = movement.positions(decode_ais(frame(spark, [msg(mtype="ShipStaticData")])))
    assert pos.count() == 0
    assert movement.vessel_speed_patterns(pos).count() == 0
    assert movement.navigation_hotspots(pos).count() == 0
    assert movement.movement_status(pos).count() == 0
    assert [tuple(r) for r in movement.speed_stats(pos).collect()] == [(None, None, None)]


def test_null_speed_is_high_speed_class(spark):
    pos = movement.positions(decode_ais(frame(spark, [msg(sog=None), msg(sog=0.2, mmsi=2)])))
    out = {r.movement_class: (r.position_reports, r.unique_vessels) for r in movement.movement_status(pos).collect()}
    assert out == {"High Speed": (1, 1), "Anchored/Stationary": (1, 1)}
