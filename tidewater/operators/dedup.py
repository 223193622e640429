"""One row per key: the latest version wins (U-1, U-2, K-2).

Written as ``groupBy(key).agg(max(struct(order..., rest...)))`` rather than a
``row_number()`` window: the aggregate runs a partial step on the map side, so
a key holding a third of all rows is reduced to one row per input partition
before the shuffle, and no task ever has to hold a whole hot group. A struct
with text fields does not fit a hash aggregate's fixed-width buffer, so Spark
plans a ``SortAggregate``: rows are sorted by key on both sides of the exchange
(spilling, in memory-bounded runs). Struct
ordering compares fields left to right with null lowest, which is
``ORDER BY o1 DESC NULLS LAST, o2 DESC NULLS LAST, ...`` over the order columns
followed by every remaining column: a total, repeatable choice of survivor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WINNER = "__latest"


def latest_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """Keep, per ``keys``, the row with the greatest ``order_by`` tuple; the other
    columns (in frame order) break remaining ties. Column order is preserved."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]
    ranked = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest])
    winners = df.groupBy(*keys).agg(F.max(ranked).alias(_WINNER))
    return winners.select(*[F.col(c) if c in keys else F.col(f"{_WINNER}.{c}").alias(c) for c in df.columns])


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """Merge ``updates`` into ``target``: last write (greatest ``order_by``) wins
    per key. Idempotent: upserting the same updates again changes nothing."""
    merged = target.unionByName(updates, allowMissingColumns=True)
    return latest_by_key(merged, keys, order_by)
