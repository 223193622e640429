"""Filters defined against a data-dependent bound: latest run, recent window.

Both use a scalar subquery (``DataFrame.scalar()``): the bound is computed by a
pruned aggregate job inside the same plan, never collected to the driver and
substituted as a literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.clean import sound_time


def latest_run(df: DataFrame, run_col: str = "ref_time") -> DataFrame:
    """Rows of the newest run: ``run_col == max(run_col)`` over the whole frame
    (a global max, so ports missing from the last run drop out, as in the
    reference). ``run_col`` must already be numeric."""
    newest = df.agg(F.max(run_col)).scalar()
    return df.filter(F.col(run_col) == newest)


def recent(
    df: DataFrame, ts_col: str, seconds: int = 3600, date_col: str | None = None, arrival_col: str | None = None, not_after: Column | None = None
) -> DataFrame:
    """Rows within ``seconds`` of the newest timestamp, compared in whole epoch
    seconds: ``unix_seconds(ts) >= max(unix_seconds(ts)) - seconds``.

    One sender's wrong clock must not make all others old. With ``arrival_col`` a
    time too far ahead of its arrival counts as its arrival (``sound_time``). With
    ``not_after`` (say, ``F.current_timestamp()``) later times are neither newest
    nor recent; a store without arrivals needs it, as its newest partition may be
    a wrong clock's.

    ``date_col``: a date partition column of ``ts_col`` (e.g. the message
    store's ``event_date``). The newest date comes from partition values alone,
    the newest timestamp from that date's files, and the implied
    ``date_col >= date(newest - seconds)`` is added, which Spark evaluates as a
    runtime partition filter: only the last day or two of files are read."""
    time = F.col(ts_col).cast("timestamp")
    if arrival_col:
        time = sound_time(time, F.col(arrival_col).cast("timestamp"))
    secs = F.unix_seconds(time)
    if not_after is not None:
        df = df.filter(time <= not_after)
        if date_col:
            df = df.filter(F.col(date_col) <= F.to_date(not_after))
    last = df
    if date_col:
        last = df.filter(F.col(date_col) == df.select(date_col).agg(F.max(date_col)).scalar())
    newest = last.agg(F.max(secs)).scalar()
    out = df.filter(secs >= newest - F.lit(seconds))
    if date_col:
        cutoff = F.to_date(F.timestamp_seconds(newest - F.lit(seconds)))
        out = out.filter(F.col(date_col) >= cutoff)
    return out
