"""Connected components of an edge table, by alternating star steps.

Every step is a grouped minimum and a join on the node. A node with very many
edges is reduced on the map side; the minima are a table of their own, so both
sides of the join come straight from a shuffle, which is what lets adaptive
execution split such a node's partition. Edges go to a table in the shared folder after each round; the driver
sees one row at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.storage import Scratch


def _star(edges: DataFrame, large: bool, scratch: Scratch) -> DataFrame:
    """One step on edges (u, v), v < u. Large star: every node sends its larger
    neighbours to the least of its neighbourhood; small star: its smaller ones."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("m", "u").alias("m"))
        least = scratch.write(least, "least")
        # Larger neighbours of c are those that name c as their smaller end.
        out = edges.join(least, edges.v == least.c).select(F.col("u"), F.col("m").alias("v"))
    else:
        least = scratch.write(edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c"), "least")
        out = edges.join(least, edges.u == least.c).select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.union(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return out.filter("u <> v")


def _is_stars(edges: DataFrame) -> bool:
    """Every node has one parent at most, and no parent has one: each star is a
    whole component, and its centre the least id."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 or up > 0 and down > 0").isEmpty()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of every node of ``edges`` (columns a, b): component is the
    least id reachable. Nodes without an edge are absent. Repeats and loops of
    edges do no harm; null ends are ignored."""
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = scratch.write(e, "edges")
    while True:
        large = scratch.write(_star(e, True, scratch), "large")
        after = scratch.write(_star(large, False, scratch).distinct(), "star")
        scratch.drop(e, large)
        e = after
        if _is_stars(e):
            break
    roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
