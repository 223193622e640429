"""Landed API payloads -> store rows (S-8 ... S-11).

The fetchers receive JSON documents (registry pages, hourly forecast arrays,
current conditions). Here the landed documents are read with an explicit
schema and unnested with ``explode`` / ``posexplode``: one Spark task per input
split, no per-record Python, no driver loop. Each document is parsed once per
row (``operators.once``), though both the error split and the unnesting read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from tidewater.operators.once import with_column_once
from tidewater.sources.catalog import PORTS, WEATHER_FIELDS, Catalog

CORRUPT = "_corrupt_record"

REGISTRY_SCHEMA = StructType(
    [
        # items keep every key the service sends; the catalog picks the columns
        StructField("data", ArrayType(MapType(StringType(), StringType()))),
        StructField(CORRUPT, StringType()),
    ]
)

# Why a landed document is kept out of the rows.
UNPARSEABLE, API_ERROR, NO_DATA, INCOMPLETE = "unparseable", "api_error", "no_data", "incomplete"


def _parsed(payloads: DataFrame, payload_col: str, schema: StructType) -> DataFrame:
    """``payload`` and ``doc``, parsed once; ``doc.{CORRUPT}`` holds a text that
    is not a JSON document of the schema."""
    doc = F.from_json(F.col(payload_col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return with_column_once(payloads.select(F.col(payload_col).alias("payload")), "doc", doc)


def _unparseable() -> Column:
    return F.col("doc").isNull() | F.col(f"doc.{CORRUPT}").isNotNull()


def _with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def hourly_schema(fields=WEATHER_FIELDS) -> StructType:
    return StructType(
        [StructField("start", LongType()), StructField("interval", LongType()), StructField("end", LongType())]
        + [StructField(f, ArrayType(DoubleType())) for f in fields]
    )


def current_schema(fields=WEATHER_FIELDS) -> StructType:
    inner = StructType([StructField("time", LongType())] + [StructField(f, DoubleType()) for f in fields])
    return StructType(
        [
            StructField("port_id", StringType()),
            StructField("port_name", StringType()),
            StructField("latitude", StringType()),
            StructField("longitude", StringType()),
            StructField("current", inner),
        ]
    )


def read_json_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed documents, one JSON document per line, as a ``payload`` text column."""
    return spark.read.text(path).withColumnRenamed("value", "payload")


def _said_error(payload_col: str) -> Column:
    """Text of a response's ``error``, null where it says nothing."""
    error = F.variant_get(F.try_parse_json(F.col(payload_col)), "$.error", "variant")
    kind = F.schema_of_variant(error)
    text = F.to_json(error)
    number = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    nothing = (
        error.isNull()
        | kind.isin("VOID", "ARRAY<VOID>", "OBJECT<>")
        | ((kind == "BOOLEAN") & (text == "false"))
        | ((kind == "STRING") & (text == '""'))
        | (number & (text.try_cast("double") == 0))
    )
    return F.when(~F.coalesce(nothing, F.lit(True)), F.coalesce(F.get_json_object(payload_col, "$.error"), text))


def explode_registry(
    payloads: DataFrame,
    catalog: Catalog = PORTS,
    family: str = "info",
    payload_col: str = "payload",
    key_col: str | None = None,
    fetched_at: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """S-8 / S-9 / P-15: registry responses -> (rows, errors).

    Each item becomes one row; its keys are the ``info`` qualifiers, mapped to
    column names by the catalog. ``errors`` has one row (reason, error, payload)
    for each response that gives no rows: not a JSON document, without a ``data``
    list, or with an ``error`` that says something (null, ``false``, ``""``, 0 and
    empty containers say nothing). A batch load should fail if it is not empty.

    P-12: with ``fetched_at`` (epoch seconds of the load, a job-time literal,
    never a per-row clock) each row also gets ``timestamp`` and the snapshot row
    key ``{key}-{fetched_at in ms}`` in ``id``, as the registry store expects."""
    parsed = _parsed(payloads, payload_col, REGISTRY_SCHEMA)
    parsed = with_column_once(parsed, "error", _said_error("payload"))
    reason = (
        F.when(_unparseable(), UNPARSEABLE)
        .when(F.col("error").isNotNull(), API_ERROR)
        .when(F.col("doc.data").isNull(), NO_DATA)
    )
    tagged = parsed.withColumn("reason", reason)
    errors = tagged.filter(F.col("reason").isNotNull()).select("reason", "error", "payload")
    items = tagged.filter(F.col("reason").isNull()).select(F.explode("doc.data").alias("item"))
    cols = [
        F.col("item")[qual].alias(name)
        for name, (fam, qual) in catalog.columns.items()
        if fam == family
    ]
    rows = items.select(*cols)
    if fetched_at is not None:
        key = key_col or next(c for c, (fam, _) in catalog.columns.items() if fam == family)
        rows = rows.select(
            F.concat_ws("-", F.col(key), F.lit(str(int(fetched_at) * 1000))).alias(catalog.rowkey),
            *rows.columns,
            F.lit(str(int(fetched_at))).alias("timestamp"),
        )
    return rows, errors


def explode_forecast(payloads: DataFrame, hourly_col: str = "hourly") -> DataFrame:
    """S-10: hourly parallel arrays -> one row per step.

    ``steps = (end - start) div interval``; step ``i`` is valid at
    ``start + i * interval``; the run (``ref_time``) is ``start``. Row key
    ``{port_id}-{ref_time}-{forecast_timestamp}`` (P-11)."""
    h = F.col(hourly_col)
    fields = [
        f.name
        for f in payloads.schema[hourly_col].dataType.fields
        if isinstance(f.dataType, ArrayType)
    ]
    steps = F.try_divide(h["end"] - h["start"], h["interval"]).cast("bigint")
    # A variable the response lacks is a null array; arrays_zip would then be
    # null for the whole run. As an empty array it is padded with nulls instead.
    zipped = F.arrays_zip(*[F.coalesce(h[f], F.array().cast(ArrayType(DoubleType()))).alias(f) for f in fields])
    keep = [c for c in payloads.columns if c != hourly_col]
    stepped = payloads.select(
        *keep,
        h["start"].alias("ref_time"),
        h["interval"].alias("__interval"),
        steps.alias("__steps"),
        F.posexplode(zipped).alias("__i", "__v"),
    ).filter(F.col("__i") < F.col("__steps"))
    valid = F.col("ref_time") + F.col("__i") * F.col("__interval")
    return stepped.select(
        F.concat_ws("-", "port_id", F.col("ref_time").cast("string"), valid.cast("string")).alias("id"),
        *keep,
        "ref_time",
        valid.alias("forecast_timestamp"),
        *[F.col("__v")[f].alias(f) for f in fields],
    )


def explode_current(
    payloads: DataFrame, fields=WEATHER_FIELDS, payload_col: str = "payload"
) -> tuple[DataFrame, DataFrame]:
    """S-11: current-conditions responses -> (one row per port, rejects).

    A response that failed (unparseable, or without a ``current`` block, its time
    or a port) goes to ``rejects`` (reason, payload) and the rest load, as the
    reference skips a failed port and continues."""
    parsed = _parsed(payloads, payload_col, _with_corrupt(current_schema(fields)))
    complete = F.col("doc.current.time").isNotNull() & F.col("doc.port_id").isNotNull()
    tagged = parsed.withColumn("reason", F.when(_unparseable(), UNPARSEABLE).when(~complete, INCOMPLETE))
    rows = tagged.filter(F.col("reason").isNull()).select(
        F.concat_ws("-", F.col("doc.port_id"), F.col("doc.current.time").cast("string")).alias("id"),
        *[F.col(f"doc.{c}").alias(c) for c in ("port_id", "port_name", "latitude", "longitude")],
        F.col("doc.current.time").alias("timestamp"),
        *[F.col(f"doc.current.{f}").alias(f) for f in fields],
    )
    return rows, tagged.filter(F.col("reason").isNotNull()).select("reason", "payload")


def forecast_payload_schema(fields=WEATHER_FIELDS) -> StructType:
    """One landed hourly-forecast document per port."""
    return StructType(
        [
            StructField("port_id", StringType()),
            StructField("port_name", StringType()),
            StructField("latitude", StringType()),
            StructField("longitude", StringType()),
            StructField("hourly", hourly_schema(fields)),
        ]
    )


def split_forecast(
    payloads: DataFrame, fields=WEATHER_FIELDS, payload_col: str = "payload"
) -> tuple[DataFrame, DataFrame]:
    """Landed forecast texts -> (documents for ``explode_forecast``, rejects).

    Rejects (reason, payload) are texts that are not JSON documents, and documents
    without a port or without a usable time axis."""
    schema = forecast_payload_schema(fields)
    h = "doc.hourly"
    usable = (
        F.col("doc.port_id").isNotNull() & F.col(f"{h}.start").isNotNull() & F.col(f"{h}.end").isNotNull()
        & F.coalesce(F.col(f"{h}.interval") > 0, F.lit(False))
    )
    parsed = _parsed(payloads, payload_col, _with_corrupt(schema))
    tagged = parsed.withColumn("reason", F.when(_unparseable(), UNPARSEABLE).when(~usable, INCOMPLETE))
    documents = tagged.filter(F.col("reason").isNull()).select(*[F.col(f"doc.{f.name}").alias(f.name) for f in schema])
    return documents, tagged.filter(F.col("reason").isNotNull()).select("reason", "payload")
