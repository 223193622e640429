"""As-of joins and last known values by time blocks with carried state.

A key's rows are cut into blocks of time, and every window runs within one (key,
block), so a key that holds a third of all rows is as many tasks as it has blocks.
What a block needs from before is one value, the last known one; it is carried in
by a window over block summaries, one row a block.

Times are timestamps or numbers (seconds). Null keys and times match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds in a block.
BLOCK_SECONDS = 86400


def seconds(time: Column, dtype: str) -> Column:
    """A time as seconds, with its fraction where it is a timestamp."""
    if dtype.startswith("timestamp"):
        return F.unix_micros(time.cast("timestamp")).cast("decimal(24,6)") / F.lit(1000000).cast("decimal(10,0)")
    return time


def _seconds(df: DataFrame, time: str) -> Column:
    return seconds(F.col(time), df.schema[time].dataType.simpleString())


def last_known(
    df: DataFrame, by: Sequence[str], order: Sequence[str], values: dict[str, tuple[Column, bool]], block_seconds: int = BLOCK_SECONDS
) -> DataFrame:
    """Add columns with the last non-null value of an expression among the rows of
    the same ``by`` in the order of ``order`` (a time, then tie-breaks that make it
    total): ``values`` maps a name to (expression, whether the row's own counts)."""
    block = F.floor(_seconds(df, order[0]) / block_seconds).cast("long")
    at = df.select("*", block.alias("__block"), *[e.alias(f"__of_{n}") for n, (e, _) in values.items()])
    place = F.struct(*order)
    last = [F.max_by(f"__of_{n}", F.when(F.col(f"__of_{n}").isNotNull(), place)).alias(f"__last_{n}") for n in values]
    summary = at.groupBy(*by, "__block").agg(*last)
    before = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(*by, "__block", *[F.last(f"__last_{n}", ignorenulls=True).over(before).alias(f"__in_{n}") for n in values])
    both = at.join(carried, [*by, "__block"])
    within = Window.partitionBy(*by, "__block").orderBy(*order)
    end = {True: Window.currentRow, False: -1}
    known = [
        F.coalesce(F.last(f"__of_{n}", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, end[own])), F.col(f"__in_{n}")).alias(n)
        for n, (_, own) in values.items()
    ]
    return both.select(*df.columns, *known)


def asof_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, direction: str = "backward",
    payload: Sequence[str] | None = None, tolerance: float | None = None, block_seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """Every row of ``left`` with the ``payload`` columns (default: all but the keys)
    of the row of ``right`` with equal keys whose time is the last at or before its
    own (``backward``), the first at or after it (``forward``), or the nearer of the
    two (``nearest``; of equally near ones the earlier). Of rows of one time the
    greatest payload counts. ``tolerance``: no match further away, in seconds."""
    payload = [c for c in right.columns if c not in by] if payload is None else list(payload)
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"unknown direction {direction!r}")
    if clash := set(payload) & set(left.columns):
        raise ValueError(f"both sides have {sorted(clash)}")
    r_time, l_time = _seconds(right, right_time), _seconds(left, left_time)
    found = F.struct(r_time.alias("at"), F.struct(*payload).alias("row"))
    right = right.filter(" and ".join(f"`{c}` is not null" for c in [*by, right_time])).groupBy(*by, r_time.alias("__time")).agg(F.max(found).alias("__found"))
    marked = left.select(F.struct("*").alias("__left"), *by, l_time.alias("__time"))
    usable = F.col("__time").isNotNull()
    for c in by:
        usable = usable & F.col(c).isNotNull()
    rows = marked.filter(usable).unionByName(right, allowMissingColumns=True)
    rest = marked.filter(~usable).select("__left", F.lit(None).cast(right.schema["__found"].dataType).alias("__best"))
    ways = {"backward": ["__back"], "forward": ["__ahead"], "nearest": ["__back", "__ahead"]}[direction]
    block = F.floor(F.col("__time") / block_seconds).cast("long")
    rows = rows.withColumn("__block", block)
    first, last = F.min("__found"), F.max("__found")
    summary = rows.groupBy(*by, "__block").agg(first.alias("__first"), last.alias("__last"))
    over = Window.partitionBy(*by).orderBy("__block")
    carried = summary.select(
        *by, "__block",
        F.last("__last", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("__before"),
        F.first("__first", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("__after"),
    )
    # Rows of one time are peers of a range window, so each sees a match at its own time.
    within = Window.partitionBy(*by, "__block").orderBy("__time")
    known = {
        "__back": F.coalesce(F.last("__found", ignorenulls=True).over(within.rangeBetween(Window.unboundedPreceding, Window.currentRow)), F.col("__before")),
        "__ahead": F.coalesce(F.first("__found", ignorenulls=True).over(within.rangeBetween(Window.currentRow, Window.unboundedFollowing)), F.col("__after")),
    }
    # Rows and summaries both grow with the input: never broadcast.
    out = rows.hint("merge").join(carried, [*by, "__block"]).select("__left", "__time", *[known[w].alias(w) for w in ways]).filter("__left is not null")
    best = F.col(ways[0])
    if direction == "nearest":
        ahead, back = F.col("__ahead.at") - F.col("__time"), F.col("__time") - F.col("__back.at")
        best = F.when(F.col("__ahead").isNull() | (back <= ahead), F.col("__back")).otherwise(F.col("__ahead"))
    if tolerance is not None:
        best = F.when(F.abs(best["at"] - F.col("__time")) <= tolerance, best)
    out = out.select("__left", best.alias("__best")).unionByName(rest)
    return out.select("__left.*", *[F.col(f"__best.row.{c}").alias(c) for c in payload])
