"""Running totals and peaks by two-level prefix sums.

A key's changes are cut into blocks of time. Blocks are summed first; a window
over these sums, one row a block, gives what each block starts from, and the
windows over rows run within one (key, block). A key with very many changes is as
many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.asof import BLOCK_SECONDS, _seconds


def running_total(
    df: DataFrame, by: Sequence[str], time: str, change: Column, name: str, block_seconds: int = BLOCK_SECONDS
) -> DataFrame:
    """Add ``name``: the sum of ``change`` over the rows of the same ``by`` up to and
    at this row's time. Rows of one time share it. Null changes count nothing."""
    block = F.floor(_seconds(df, time) / block_seconds).cast("long")
    at = df.select("*", block.alias("__block"), F.coalesce(change, F.lit(0)).cast("long").alias("__change"))
    before = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sums = at.groupBy(*by, "__block").agg(F.sum("__change").alias("__sum"))
    carried = sums.select(*by, "__block", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy(*by, "__block").orderBy(time).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = at.join(carried, [*by, "__block"])
    return both.select(*df.columns, (F.col("__before") + F.sum("__change").over(within)).alias(name))


def occupancy(stays: DataFrame, by: Sequence[str], start: str, end: str, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """(by, time, occupied) after every moment at which half-open stays [start, end)
    begin or end: one that ends as another begins never meets it. A null end is a
    stay that goes on; stays that end where they begin occupy nothing."""
    moment = F.explode(F.array(F.struct(F.col(start).alias("time"), F.lit(1).alias("change")), F.struct(F.col(end).alias("time"), F.lit(-1).alias("change"))))
    real = stays.filter(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
    moments = real.select(*by, moment.alias("m")).select(*by, "m.time", "m.change").filter("time is not null")
    net = moments.groupBy(*by, "time").agg(F.sum("change").alias("__net"))
    return running_total(net, by, "time", F.col("__net"), "occupied", block_seconds).select(*by, "time", "occupied")


def peak_by_hour(levels: DataFrame, by: Sequence[str], time: str = "time", level: str = "occupied") -> DataFrame:
    """(by, hour, peak) for every hour from a key's first change to its last: the
    greatest level in it, the one it starts with among them. The level holds from
    one change to the next; hours without a change repeat it."""
    hour = F.date_trunc("hour", F.col(time))
    per = levels.groupBy(*by, hour.alias("hour")).agg(
        F.max(level).alias("most"), F.max_by(level, time).alias("last"), F.min_by(level, time).alias("first"), F.min(time).alias("from")
    )
    # One row a key and hour with a change; windows over these.
    order = Window.partitionBy(*by).orderBy("hour")
    per = per.withColumns({"start": F.coalesce(F.lag("last").over(order), F.lit(0)), "next": F.lead("hour").over(order)})
    busy = per.select(*by, "hour", F.when(F.col("from") > F.col("hour"), F.greatest("most", "start")).otherwise(F.col("most")).cast("long").alias("peak"))
    gap = per.filter(F.col("next") > F.col("hour") + F.expr("interval 1 hour"))
    quiet = gap.select(*by, F.explode(F.sequence(F.col("hour") + F.expr("interval 1 hour"), F.col("next") - F.expr("interval 1 hour"), F.expr("interval 1 hour"))).alias("hour"), F.col("last").cast("long").alias("peak"))
    return busy.unionByName(quiet)
