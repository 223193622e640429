"""Evaluate an expensive per-row expression exactly once.

Catalyst pushes a filter below the projection that defines the columns it
tests and substitutes their definitions into the condition, cost-blind: a
filter on three fields of a parsed document parses the document three times in
the filter, then once more in the projection. A column produced by a generator
cannot be substituted that way (filters on a generator's output stay above
it), so producing the parsed value with a one-row ``inline`` pins it to one
evaluation per row while every other column still prunes and pushes down as
usual.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_column_once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``df.withColumn(name, expr)``, with ``expr`` evaluated once per row even
    when later filters test several fields derived from it."""
    keep = [F.col(c) for c in df.columns if c != name]
    # Only the expression goes through the generator; the other columns pass
    # through as plain child output, so unused ones still prune away.
    return df.select(*keep, F.inline(F.array(F.struct(expr.alias(name)))))
