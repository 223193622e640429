"""Cleaning and typing of text-typed store columns (sentinels, casts, rounding).

Every stored cell is text, and missing values reach the store as the text of a
Python ``None`` or a float NaN. Cleaning therefore happens on the text, before
any cast: once cast, ``'nan'`` is a NaN that compares greater than every number.
All casts are ``try_cast`` so that ANSI mode (on in Spark 4) never fails a job on
one bad cell; an uncastable cell becomes null.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The sentinel spellings each reference job clears.
# The registry reports (ports, fleet) clear only the exact text "nan";
# the weather reports clear these five spellings.
REGISTRY_SENTINELS = ("nan",)
WEATHER_SENTINELS = ("nan", "NaN", "Nan", "NAN", "None")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_sentinels(
    df: DataFrame, values: Iterable[str], cols: Sequence[str] | None = None
) -> DataFrame:
    """Replace exact sentinel texts with null in the string columns ``cols``
    (default: every string column). Other columns pass through untouched."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    targets = set(cols)
    # One SQL projection for all columns: the same CASE expressions as
    # F.when(...).isin(...), built with one call instead of several per column.
    in_list = ", ".join(_sql_string(v) for v in values)
    return df.selectExpr(
        *[
            f"CASE WHEN {_ident(c)} IN ({in_list}) THEN NULL ELSE {_ident(c)} END AS {_ident(c)}"
            if c in targets
            else _ident(c)
            for c in df.columns
        ]
    )


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def to_number(c: str | Column, dtype: str = "double") -> Column:
    """Text -> number; null when the text is not a number (never raises)."""
    column = _col(c).try_cast(dtype)
    return column.alias(c) if isinstance(c, str) else column


def round_half_up(c: str | Column, digits: int = 2) -> Column:
    """Round a double to ``digits`` places, half away from zero, repeatably.

    A double mean such as 11.175 may be stored as 11.17499999... or 11.17500...1
    depending on summation order, so rounding the double directly can land on
    either side. Going through decimal(24,8) first removes that noise (a decimal
    rounding at the 8th place), then the 2-place rounding is exact. Values out of
    decimal range, NaN and infinities do not convert (``try_cast`` gives null)
    and fall back to the plain double rounding; null stays null.
    """
    x = _col(c)
    return F.coalesce(F.round(x.try_cast("decimal(24,8)"), digits).cast("double"), F.round(x, digits))


def epoch_to_time(c: str | Column) -> Column:
    """Epoch seconds (text or number) -> UTC 'yyyy-MM-dd HH:mm:ss' text.

    Computed on a zone-less timestamp (epoch + n seconds), so the text does not
    depend on the session time zone (``from_unixtime`` would format in it)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.date_format(F.timestamp_add("SECOND", _col(c).try_cast("bigint"), epoch), "yyyy-MM-dd HH:mm:ss")


def parse_ais_time(c: str | Column) -> Column:
    """AIS ``time_utc`` text -> timestamp. Accepts the feed's
    '2024-01-01 00:00:07.179575 +0000 UTC' as well as plain ISO-like text."""
    text = F.regexp_replace(_col(c), r"\s*\+0000 UTC$", "")
    return F.try_to_timestamp(text)


#: A message's own time may be this far ahead of its arrival; beyond it the
#: sender's clock is wrong.
CLOCK_AHEAD = "5 minutes"


def sound_time(own: Column, arrival: Column) -> Column:
    """A message's own time, or its arrival where the own one is missing or further
    ahead of it than a clock may be. A time without a known arrival stands."""
    wrong = own > arrival + F.expr(f"interval {CLOCK_AHEAD}")
    return F.when(F.coalesce(wrong, F.lit(False)), arrival).otherwise(F.coalesce(own, arrival))


# Python literal -> JSON literal.
PY_LITERALS = (("True", "true"), ("False", "false"), ("None", "null"))

#: A quoted text, whole; an open one goes to the end.
_QUOTED = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+(?:'|$)|"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|$)"""

#: ``\\xNN`` after an even number of backslashes, and its JSON form.
HEX_ESCAPE = (r"(?<!\\)((?:\\\\)*+)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")


def literal_rewrite(literal: str, json_literal: str) -> tuple[str, str]:
    """Pattern and replacement that put ``json_literal`` for the literal as a word of
    its own outside quoted texts. Matches join without a gap, and each takes what
    stands before its word, quoted texts whole, so a text is read once."""
    other = rf"""[^'"{literal[0]}]++|{_QUOTED}|(?!\b{literal}\b){literal[0]}"""
    return rf"(?s)\G((?:{other})*+)\b{literal}\b", f"$1{json_literal}"


def parse_repr(c: str | Column, schema) -> Column:
    """Python-repr dict text (single quotes, True/False/None) -> struct.

    Old store rows hold nested messages as ``str(dict)``. The JSON reader already
    accepts single quotes and, asked to, any escaped character. The three Python
    literals are rewritten wherever they stand outside quoted texts, with any
    white space around; texts that contain them are left alone. ``\\xNN`` escapes
    become ``\\u00NN``. Each rewrite stands once in the plan.
    """
    text = _col(c)
    for literal, json_literal in PY_LITERALS:
        text = F.regexp_replace(text, *literal_rewrite(literal, json_literal))
    text = F.regexp_replace(text, *HEX_ESCAPE)
    return F.from_json(text, schema, {"allowBackslashEscapingAnyCharacter": "true"})
