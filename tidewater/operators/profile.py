"""Data profiles: null counts per column and row counts per stage (A-19, A-20).

Each profile is one aggregate pass per input (partial on the map side), then an
unpivot of the single result row. The reference runs one filtered count job per
column; here every column is counted in the same scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _unpivot_one_row(row: DataFrame, name_col: str, value_col: str) -> DataFrame:
    return row.unpivot([], row.columns, name_col, value_col)


def stage_counts(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """``(stage, row_count)`` for named count expressions evaluated in one pass,
    e.g. ``{"loaded": F.count("*"), "valid": F.count_if(cond)}``."""
    row = df.agg(*[expr.cast("bigint").alias(name) for name, expr in stages.items()])
    return _unpivot_one_row(row, "stage", "row_count")
