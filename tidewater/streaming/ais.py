"""AIS messages: decode, reject routing, replay-safe keys, windowed type counts,
and the stream ingest (T-1 ... T-8, U-3).

Every function here is a plain ``DataFrame -> DataFrame`` that works the same
on a batch frame (the oracle checks it) and on a streaming frame from
``readStream`` (Kafka in production, files in tests).

Wire form: ``{"MessageType": str, "Message": {"MessageID": ..., "<type>": {...}},
"MetaData": {"MMSI", "ShipName", "latitude", "longitude", "time_utc"}}`` and
``{"error": str}`` frames from the feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidewater.functions.clean import parse_ais_time, sound_time
from tidewater.operators.once import with_column_once

POSITION_SCHEMA = StructType(
    [
        StructField("Sog", DoubleType()),
        StructField("Cog", DoubleType()),
        StructField("TrueHeading", DoubleType()),
    ]
)

# AIS "not available" codes for speed, course and heading.
SOG_UNAVAILABLE = 102.3
COG_UNAVAILABLE = 360.0
HEADING_UNAVAILABLE = 511.0

# Reject reasons, in the order they are tested.
REASONS = ("no_value", "bad_json", "error_frame", "bad_structure")
OK = "ok"


JSON_COL = "__json"


def _text(df: DataFrame, value_col: str) -> Column:
    return F.col(value_col).cast("string")


def with_json(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse the message text once into a VARIANT column; classification,
    decoding and keying all read that column. The parse is pinned to one
    evaluation per row (``with_column_once``): without that, the reject filter
    inlined the parse once per reference and parsed every message four times.
    """
    if JSON_COL in df.columns:
        return df
    return with_column_once(df, JSON_COL, F.try_parse_json(_text(df, value_col)))


def _get(path: str, dtype: str) -> Column:
    return F.try_variant_get(F.col(JSON_COL), path, dtype)


def decode_ais(
    df: DataFrame, value_col: str = "value", drop_unavailable: bool = False, keep_value: bool = False
) -> DataFrame:
    """T-1, P-9: message text -> typed columns, in the JVM, from one parse per
    row (the reference re-parses a repr text three times in Python UDFs).
    Other input columns (event id, Kafka metadata) pass through; a field of the
    wrong type comes back null instead of failing the batch."""
    parsed = with_json(df, value_col)
    sog = _get("$.Message.PositionReport.Sog", "double")
    cog = _get("$.Message.PositionReport.Cog", "double")
    hdg = _get("$.Message.PositionReport.TrueHeading", "double")
    if drop_unavailable:
        sog = F.when(sog != SOG_UNAVAILABLE, sog)
        cog = F.when(cog < COG_UNAVAILABLE, cog)
        hdg = F.when(hdg != HEADING_UNAVAILABLE, hdg)
    time_utc = _get("$.MetaData.time_utc", "string")
    passthrough = [c for c in parsed.columns if c != JSON_COL and (keep_value or c != value_col)]
    if keep_value:
        passthrough.append(JSON_COL)
    return parsed.select(
        *passthrough,
        _get("$.MessageType", "string").alias("message_type"),
        _get("$.Message.MessageID", "string").alias("message_id"),
        _get("$.MetaData.MMSI", "string").alias("mmsi"),
        _get("$.MetaData.ShipName", "string").alias("ship_name"),
        _get("$.MetaData.latitude", "double").alias("latitude"),
        _get("$.MetaData.longitude", "double").alias("longitude"),
        time_utc.alias("time_utc"),
        parse_ais_time(time_utc).alias("event_time"),
        sog.alias("speed_over_ground"),
        cog.alias("course_over_ground"),
        hdg.alias("heading"),
    )


def _is_object(path: str) -> Column:
    kind = F.schema_of_variant(F.variant_get(F.col(JSON_COL), path, "variant"))
    return F.coalesce(kind.startswith("OBJECT"), F.lit(False))


def _reason(value_col: str) -> Column:
    no_value, bad_json, error_frame, bad_structure = REASONS
    j = F.col(JSON_COL)
    return (
        F.when(F.col(value_col).isNull(), no_value)
        .when(j.isNull(), bad_json)
        .when(F.variant_get(j, "$.error", "variant").isNotNull(), error_frame)
        .when(~(_is_object("$.Message") & _is_object("$.MetaData")), bad_structure)
        .otherwise(OK)
    )


def classify(df: DataFrame, value_col: str = "value") -> DataFrame:
    """T-2 / P-15: add ``reason``: the reject reason of each record, or ``ok``.

    null value -> no_value; unparseable -> bad_json; an ``error`` key (a feed
    error frame) -> error_frame; ``Message`` or ``MetaData`` not a JSON object
    -> bad_structure. The parsed VARIANT column is kept for the next steps.
    """
    return with_json(df, value_col).withColumn("reason", _reason(value_col))


def route_invalid(df: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split into (good, rejects); rejects carry a ``reason`` column. Both come
    from one classified frame, so a caller that persists it reads the input once."""
    tagged = classify(df, value_col)
    good = tagged.filter(F.col("reason") == OK).drop("reason")
    rejects = tagged.filter(F.col("reason") != OK).drop(JSON_COL)
    return good, rejects


def message_key(df: DataFrame, value_col: str = "value", id_col: str = "message_id") -> Column:
    """T-3 / D15: ``{MessageID or 'unknown'}-{sha256 of the canonical JSON}``.

    Canonical JSON = the parsed document re-serialised with sorted keys, so a
    re-delivered message gets the same key however it was re-encoded, and no
    wall clock enters the key. MessageID alone is not unique in AIS."""
    parsed = F.col(JSON_COL) if JSON_COL in df.columns else F.try_parse_json(_text(df, value_col))
    return F.concat_ws("-", F.coalesce(F.col(id_col), F.lit("unknown")), F.sha2(F.to_json(parsed), 256))


def dedupe_messages(good: DataFrame, value_col: str = "value", watermark: str | None = None) -> DataFrame:
    """U-3: one row per message key. Batch: an aggregate with a partial step
    (replays collapse on the map side). Stream: with ``watermark`` on the time a
    message counts under, state for a key is dropped once the watermark passes, so
    state stays bounded."""
    decoded = decode_ais(good, value_col, keep_value=True)
    keyed = decoded.withColumn("message_key", message_key(decoded, value_col)).drop(JSON_COL)
    if watermark:
        return count_time(keyed).withWatermark(COUNT_TIME, watermark).dropDuplicatesWithinWatermark(["message_key"])
    return keyed.dropDuplicates(["message_key"])


#: The time that a message counts under.
COUNT_TIME = "count_time"


def count_time(decoded: DataFrame, arrival_col: str = "ts") -> DataFrame:
    """Add the time a message counts under: its own, its arrival (landing or Kafka
    timestamp) where its own is missing or a wrong clock's (``sound_time``), else the
    Unix epoch, so that every valid frame counts. A watermark on it follows arrivals:
    one frame from a far future counts under its arrival and closes no window."""
    own = F.col("event_time")
    if arrival_col in decoded.columns:
        own = sound_time(own, F.col(arrival_col).cast("timestamp"))
    return decoded.withColumn(COUNT_TIME, F.coalesce(own, F.timestamp_seconds(F.lit(0))))


def type_counts(
    decoded: DataFrame, window: str = "15 minutes", watermark: str | None = None, time_col: str = COUNT_TIME
) -> DataFrame:
    """T-5 / T-6: message count per message type per window of ``count_time``.

    With ``watermark`` (streaming), rows later than the watermark are dropped
    from these counts only; the ingest path keeps them. Output windows are
    flattened to naive (UTC wall-clock) ``window_start`` / ``window_end``."""
    if time_col == COUNT_TIME and COUNT_TIME not in decoded.columns:
        decoded = count_time(decoded)
    df = decoded.withColumn("message_type", F.coalesce(F.col("message_type"), F.lit("Unknown")))
    if watermark:
        df = df.withWatermark(time_col, watermark)
    counts = df.groupBy(F.window(time_col, window), "message_type").agg(F.count("*").alias("message_count"))
    return counts.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "message_type",
        "message_count",
    )
