"""Embedding near-duplicates by an epsilon grid order join.

Vectors of one label link where their cosine reaches a threshold, that is, where
their unit vectors lie within ``eps = sqrt(2 - 2 * threshold)``. Unit vectors are
projected on the leading principal dimensions (from second moments summed over
the partitions) and sorted by label, then by grid cell of side eps, dimension
after dimension. The sequence is cut into blocks. A tree over the sequence, with
a bounding box of projections and residual norm at each interval, is joined with
itself from the root down: a pair of intervals goes on only while the boxes lie
within eps. Both projections and residual norms move by no more than the vectors
do, so a skipped pair of blocks holds no link. The vectors of a remaining pair of
blocks meet in one task, which compares them in double precision and returns, a
vector, its number of links, and edges that span its links: rows grow with
vectors and block pairs, not with links.

Equal vectors of a label are one class from the start, stood for by the least
id and weighted by their number, so a vector that a third of all rows share
costs nothing further.

Defined results. Vectors that are null, empty, zero or hold null or non-finite
components, and vectors with a null label or id, link with nothing; null ids
have a null component and are kept. Vectors of different length never link.
Rows that repeat an id are vectors of their own; their component is the id's.
Ties: the least id stands for its group. Empty table: no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tidewater.llm.components import components
from tidewater.llm.storage import Scratch

THRESHOLD = 0.98
#: Leading principal dimensions that order the sequence and bound its intervals.
DIMS = 6
BLOCK = 1024
FAN_BITS = 3


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list<double> column whose lists are equally long."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch, name: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each vector length in a batch."""
    column = batch.column(name)
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, dtype=int)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, _matrix(column.take(pa.array(rows)))


def usable(rows: DataFrame) -> DataFrame:
    """Rows that can link, from columns id, label, v (array<double>)."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    nonzero = F.exists("v", lambda x: x != 0)
    return rows.filter("id is not null and label is not null and v is not null").filter(F.coalesce(finite & nonzero, F.lit(False)))


def principal_axes(classes: DataFrame, dims: int) -> dict[int, np.ndarray]:
    """Leading principal dimensions of the unit vectors, for each vector length:
    second moments are summed in every partition, then over the partitions; the
    driver gets one length-by-length matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, m in _by_length(batch, "v"):
                u = _unit(m)
                total[m.shape[1]] = total.get(m.shape[1], 0) + u.T @ u
        for n, t in total.items():
            rows = [pa.array([n] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(list(t), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(rows, names=["n", "i", "x"])

    parts = classes.select("v").mapInArrow(run, "n int, i int, x array<double>")
    cells = parts.select("n", "i", F.posexplode("x").alias("j", "x")).groupBy("n", "i", "j").agg(F.sum("x").alias("x"))
    axes: dict[int, np.ndarray] = {}
    for r in cells.groupBy("n", "i").agg(F.sort_array(F.collect_list(F.struct("j", "x"))).alias("row")).collect():
        axes.setdefault(r["n"], np.zeros((r["n"], r["n"])))[r["i"]] = [c["x"] for c in r["row"]]
    return {n: np.linalg.eigh(m)[1][:, ::-1][:, : min(dims, n)] for n, m in axes.items()}


def _projected(classes: DataFrame, axes: dict[int, np.ndarray], eps: float, dims: int) -> DataFrame:
    """Add cells (array<int>) and box (projections, then residual norm)."""
    fields = ["label", "dim", "cid", "id", "copies", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            box = np.zeros((batch.num_rows, dims + 1))
            for rows, m in _by_length(batch, "v"):
                u = _unit(m)
                p = u @ axes[m.shape[1]]
                box[rows, : p.shape[1]] = p
                box[rows, dims] = np.sqrt(np.maximum(0.0, 1.0 - (p * p).sum(axis=1)))
            cells = np.floor(box[:, :dims] / eps).astype(np.int32)
            more = [pa.array(list(cells), pa.list_(pa.int32())), pa.array(list(box), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f) for f in fields), *more], names=[*fields, "cells", "box"])

    kind = {f: classes.schema[f].dataType.simpleString() for f in ("label", "id")}
    return classes.select(*fields).mapInArrow(
        run, f"label {kind['label']}, dim int, cid long, id {kind['id']}, copies long, v array<double>, cells array<int>, box array<double>"
    )


def _blocks(ordered: DataFrame, size: int, dims: int, stored: str = "<f8") -> DataFrame:
    """Blocks of the sequence: label, dim, p (partition), s (number in it and
    label), lo and hi of each box dimension, ids, copies, vectors (binary)."""
    label = ordered.schema["label"].dataType.simpleString()
    id_kind = ordered.schema["id"].dataType.simpleString()
    bounds = [f"{e}{k}" for e in ("lo", "hi") for k in range(dims + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        number = 0

        def block() -> pa.RecordBatch:
            box = np.array([h[5] for h in held])
            row = {
                "label": pa.array([held[0][0]], _ARROW[label]), "dim": pa.array([held[0][1]], pa.int32()),
                "p": pa.array([part], pa.int32()), "s": pa.array([number], pa.int32()),
                "cids": pa.array([[h[2] for h in held]], pa.list_(pa.int64())),
                "ids": pa.array([[h[3] for h in held]], pa.list_(_ARROW[id_kind])),
                "copies": pa.array([[h[4] for h in held]], pa.list_(pa.int64())),
                "vectors": pa.array([np.array([h[6] for h in held], dtype=stored).tobytes()], pa.binary()),
            }
            row |= {n: pa.array([float(x)]) for n, x in zip(bounds, [*box.min(axis=0), *box.max(axis=0)], strict=True)}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            columns = [batch.column(c) for c in ("label", "dim", "cid", "id", "copies", "box", "v")]
            for i in range(batch.num_rows):
                row = (*(c[i].as_py() for c in columns[:5]), *(c[i].values.to_numpy() for c in columns[5:]))
                if held and (row[0] != held[0][0] or row[1] != held[0][1]):
                    yield block()
                    held, number = [], 0
                elif len(held) == size:
                    yield block()
                    held, number = [], number + 1
                held.append(row)
        if held:
            yield block()

    schema = f"label {label}, dim int, p int, s int, cids array<long>, ids array<{id_kind}>, copies array<long>, vectors binary, " + ", ".join(f"{b} double" for b in bounds)
    return ordered.mapInArrow(run, schema)


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "smallint": pa.int16(), "tinyint": pa.int8()}


def _block_pairs(blocks: DataFrame, eps: float, dims: int) -> DataFrame:
    """Pairs of blocks (label, dim, ap, as, bp, bs) that may hold a link, by a
    join of the sequence's interval tree with itself from the root down."""
    ks = range(dims + 1)
    fan = 1 << FAN_BITS
    top = blocks.agg(F.max("p").alias("p"), F.max("s").alias("s")).first()
    if top["p"] is None:
        top = {"p": 0, "s": 0}
    levels = [blocks.select("label", "dim", "p", "s", *[f"{e}{k}" for e in ("lo", "hi") for k in ks])]
    shrink = []  # which of p and s each level divides
    s, p = top["s"], top["p"]
    while s or p:
        by = "s" if s else "p"
        shrink.append(by)
        s, p = (s // fan, p) if by == "s" else (s, p // fan)
        up = levels[-1].withColumn(by, F.floor(F.col(by) / fan).cast("int"))
        boxes = [F.min(f"lo{k}").alias(f"lo{k}") for k in ks] + [F.max(f"hi{k}").alias(f"hi{k}") for k in ks]
        levels.append(up.groupBy("label", "dim", "p", "s").agg(*boxes))
    pairs = levels[-1].select("label", "dim", F.col("p").alias("ap"), F.col("s").alias("as"), F.col("p").alias("bp"), F.col("s").alias("bs"))

    def children(level: DataFrame, by: str, side: str) -> DataFrame:
        parent = {c: F.floor(F.col(c) / fan).cast("int") if c == by else F.col(c) for c in ("p", "s")}
        return level.select(
            "label", "dim", *[parent[c].alias(f"{side}{c}") for c in ("p", "s")], *[F.col(c).alias(f"{side}{c}2") for c in ("p", "s")],
            *[F.col(f"{e}{k}").alias(f"{side}{e}{k}") for e in ("lo", "hi") for k in ks],
        )

    for level, by in zip(levels[-2::-1], shrink[::-1], strict=True):
        pairs = pairs.join(children(level, by, "a"), ["label", "dim", "ap", "as"]).join(children(level, by, "b"), ["label", "dim", "bp", "bs"])
        gap = [F.greatest(F.lit(0.0), F.col(f"alo{k}") - F.col(f"bhi{k}"), F.col(f"blo{k}") - F.col(f"ahi{k}")) for k in ks]
        near = sum((g * g for g in gap), F.lit(0.0)) <= F.lit(eps * eps)
        ordered = (F.col("ap2") < F.col("bp2")) | ((F.col("ap2") == F.col("bp2")) & (F.col("as2") <= F.col("bs2")))
        pairs = pairs.filter(near & ordered).select(
            "label", "dim", F.col("ap2").alias("ap"), F.col("as2").alias("as"), F.col("bp2").alias("bp"), F.col("bs2").alias("bs")
        )
    return pairs


def _linked(hit: np.ndarray) -> list[tuple[int, int]]:
    """Edges (row, column) that span the links of a boolean block."""
    n, m = hit.shape
    label = np.arange(n + m)
    edges = []
    for i in np.flatnonzero(hit.any(axis=1)):
        js = np.flatnonzero(hit[i])
        comps, first = np.unique(label[n + js], return_index=True)
        other = comps != label[i]
        edges += [(int(i), int(j)) for j in js[first[other]]]
        label[np.isin(label, comps)] = label[i]
    return edges


def _compare(pairs: DataFrame, id_kind: str, threshold: float, stored: str = "<f8") -> DataFrame:
    """From pairs with both blocks' vectors: rows (cid, links, a, b): the number
    of links of a class's vectors, or an edge (a, b) of those that span the pair's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                same = (r["ap"], r["as"]) == (r["bp"], r["bs"])
                x = _unit(np.frombuffer(r["avectors"], dtype=stored).reshape(len(r["aids"]), -1).astype(np.float64))
                y = x if same else _unit(np.frombuffer(r["bvectors"], dtype=stored).reshape(len(r["bids"]), -1).astype(np.float64))
                hit = x @ y.T >= threshold
                if same:
                    np.fill_diagonal(hit, False)
                left = (r["acids"], r["aids"], np.array(r["acopies"]))
                right = left if same else (r["bcids"], r["bids"], np.array(r["bcopies"]))
                out += [(left[0][i], int(right[2][hit[i]].sum()), None, None) for i in np.flatnonzero(hit.any(axis=1))]
                if not same:
                    out += [(right[0][j], int(left[2][hit[:, j]].sum()), None, None) for j in np.flatnonzero(hit.any(axis=0))]
                out += [(None, None, left[1][i], right[1][j]) for i, j in _linked(hit)]
            columns = zip(*out, strict=True) if out else ((), (), (), ())
            kinds = (pa.int64(), pa.int64(), _ARROW[id_kind], _ARROW[id_kind])
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["cid", "links", "a", "b"])

    return pairs.mapInArrow(run, f"cid long, links long, a {id_kind}, b {id_kind}")


def near_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD,
    dims: int = DIMS, block: int = BLOCK,
) -> DataFrame:
    """Per row: id, n_links, component_id (least id reachable), kept."""
    scratch = Scratch(rows.sparkSession, "grid-join")
    # Slack for rounding; the comparison itself is exact.
    eps = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    everything = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    real = usable(everything)
    classes = real.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    # Numbers are fixed by the write.
    classes = scratch.write(classes.withColumns({"dim": F.size("v"), "cid": F.monotonically_increasing_id()}), "classes")
    axes = principal_axes(classes, dims)
    ordered = _projected(classes, axes, eps, dims)
    ordered = ordered.repartitionByRange("label", "dim", "cells", "id").sortWithinPartitions("label", "dim", "cells", "id")
    kind = rows.schema[vector_col].dataType
    stored = "<f4" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "<f8"
    blocks = scratch.write(_blocks(ordered, block, dims, stored), "blocks")
    pairs = scratch.write(_block_pairs(blocks, eps, dims), "pairs")
    payload = ["cids", "ids", "copies", "vectors"]
    side = lambda x: blocks.select("label", "dim", F.col("p").alias(f"{x}p"), F.col("s").alias(f"{x}s"), *[F.col(c).alias(x + c) for c in payload])
    both = pairs.join(side("a"), ["label", "dim", "ap", "as"]).join(side("b"), ["label", "dim", "bp", "bs"])
    found = scratch.write(_compare(both, rows.schema[id_col].dataType.simpleString(), threshold, stored), "found")

    links = found.filter("cid is not null").groupBy("cid").agg(F.sum("links").alias("links"))
    info = classes.join(links, "cid", "left").select(
        F.col("label").alias("c_label"), F.col("v").alias("c_v"), F.col("id").alias("rep"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    same = F.col("id").isNotNull() & (F.col("label") == F.col("c_label")) & (F.col("v") == F.col("c_v"))
    d = scratch.write(everything.join(info, same, "left").select("id", "rep", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "rows")
    edges = found.filter("a is not null").select("a", "b").union(d.filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    labels = components(edges, scratch).select(F.col("id").alias("c_id"), "component")
    d = d.join(labels, F.col("id") == F.col("c_id"), "left")
    component = F.coalesce("component", "id")
    return d.select("id", "n_links", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
