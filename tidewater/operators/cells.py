"""Row <-> cell conversion for a wide-column store layout (K-4, S-2).

A cell table is ``(row_key, family, qualifier, value, cell_ts)``. Writing a row
emits one cell per non-null column; reading assembles a row per key where the
newest cell of each qualifier wins and an absent cell is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.sources.catalog import Catalog


def rows_to_cells(df: DataFrame, catalog: Catalog, ts_col: str = "timestamp") -> DataFrame:
    """Flatten each row to its non-null cells. A narrow transform (no shuffle):
    ``inline`` over an array of (family, qualifier, value) structs."""
    cells = F.array(
        *[
            F.struct(F.lit(fam).alias("family"), F.lit(qual).alias("qualifier"), F.col(c).cast("string").alias("value"))
            for c, (fam, qual) in catalog.columns.items()
            if fam != "rowkey" and c in df.columns
        ]
    )
    return (
        df.select(
            F.col(catalog.rowkey).cast("string").alias("row_key"),
            F.col(ts_col).try_cast("bigint").alias("cell_ts"),
            F.inline(cells),
        )
        .filter(F.col("value").isNotNull())
        .select("row_key", "family", "qualifier", "value", "cell_ts")
    )


def cells_to_rows(cells: DataFrame, catalog: Catalog) -> DataFrame:
    """Assemble one row per row key from cells; per column the cell with the
    greatest ``cell_ts`` wins (value breaks ties). The column list comes from the
    catalog, so there is no pivot-discovery pass, and the aggregate is partial on
    the map side, so a row key with many versions is reduced before the shuffle."""
    pick = []
    for c, (fam, qual) in catalog.columns.items():
        if fam == "rowkey":
            continue
        newest = [
            F.max(F.when((F.col("family") == fam) & (F.col("qualifier") == q), F.struct("cell_ts", "value")))["value"]
            for q in dict.fromkeys((qual, *catalog.alternates.get(c, ())))
        ]
        pick.append(F.coalesce(*newest).alias(c))
    rows = cells.groupBy("row_key").agg(*pick)
    return rows.select(
        *[F.col("row_key").alias(c) if fam == "rowkey" else F.col(c) for c, (fam, _) in catalog.columns.items()]
    )
