"""Mixing sources to target weights, without replacement within an epoch.

Each row gets a hash-random key. Keys are uniform, so their leading hex digits
cut every source into ranges of about equal size, and the rows of a source are
sorted by key range after range. Prefix sums of sizes are computed in two
levels: sums per (source, range), a running sum over the ranges, and a running
sum inside each range. A source's budget is cut at its exact word: whole epochs
first, then the rows whose prefix lies under the rest, the last one in part.
No group is larger than one range of one source, so a source that holds a third
of all rows is spread like any other.

Defined results. Null text: size 0, nothing taken. Null source: a source of
its own, last in order. Null ids and repeated rows are rows like any other; rows
that agree in key are ordered by id, then size, and are interchangeable beyond
that. Empty table, or no word at all: targets 0, nothing taken. Extra columns,
whatever their names, are carried only where asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Leading hex digits of a key that name its range: 16 ** 3 ranges a source.
RANGE_DIGITS = 3
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of sources (``source``, ``source_size``; one row each): all sizes
    shared by weight, no target above ``max_epochs`` times its source.

    Sources in the order of cap to weight are capped one after another for as
    long as the level that the rest would get exceeds that ratio; this is the
    fixed point of resharing the excess. The windows run over the sources, one
    row each, never over documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(order)
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (rank - 1) % len(weights) + 1)
    s = sizes.select("source", "source_size", rank.alias("rank"), weight.alias("weight"))
    s = s.withColumn("cap", F.lit(max_epochs).cast("long") * F.col("source_size"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("rank")).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns(
        {
            "room": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_ratio), F.lit(0)),
            "left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0)),
        }
    )
    s = s.withColumn("capped", F.col("cap") * F.col("left") <= F.col("weight") * F.col("room"))
    # The first source that is not capped has the room and weight of all the others.
    free = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "rank", "room", "left"))).over(everything)
    share = free["room"].cast("double") * F.col("weight") / free["left"]
    return s.select("source", "source_size", "weight", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix(
    docs: DataFrame,
    carry: Sequence[str] = (),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 1,
    range_digits: int = RANGE_DIGITS,
) -> DataFrame:
    """Per row: id, source, size, source_size, target, taken; ``carry`` columns
    in a struct ``row``. ``taken`` counts words, repeats included: each whole
    epoch takes the row once, and the row at the cut gives its first words."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    d = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        key.alias("key"),
        F.substring(key, 1, range_digits).alias("range"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []),
    )
    ranges = d.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, max_epochs)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("range_start", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    t, r = targets.alias("t"), ranges.alias("r")
    ranges = r.join(t, F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        F.col("r.source").alias("r_source"), F.col("r.range").alias("r_range"), "range_start", "source_size", "target"
    )
    d = d.join(ranges, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("range") == F.col("r_range")))
    inside = Window.partitionBy("source", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("start", F.col("range_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return d.select(
        "id", "source", "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"),
        *(["row"] if carry else []),
    )


def mixed_rows(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", **options: object) -> DataFrame:
    """The mixed corpus itself, with the columns of ``docs``: a row for each time
    a document is taken. The copy at the cut holds its first words only (and a
    ``length_col`` that says so). Documents without a word are not taken."""
    d = mix(docs, carry=docs.columns, text_col=text_col, **options)
    full = F.floor(F.col("taken") / F.col("size")).cast("int")
    copies = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    d = d.filter(F.col("taken") > 0).select("row", "size", "taken", F.explode(F.sequence(F.lit(1), copies)).alias("copy"), full.alias("full"))
    partial = F.col("copy") > F.col("full")
    pieces = F.regexp_extract_all(F.col(f"row.{text_col}"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), (F.col("taken") % F.col("size")).cast("int")), "")
    d = d.withColumn("cut", F.when(partial, cut).otherwise(F.col(f"row.{text_col}")))
    out = []
    for c in docs.columns:
        col = F.col(f"row.`{c}`")
        if c == text_col:
            col = F.col("cut")
        elif c == length_col:
            col = F.when(partial, F.length("cut").cast(docs.schema[c].dataType)).otherwise(col)
        out.append(col.alias(c))
    return d.select(*out)
