"""Conversation prefix trie by adaptive radix trees.

A turn's id is the first 16 bytes of the SHA-256 of its role and text; a
conversation's key is the concatenation of its turns' ids, fixed-width and in
byte order. Equal sequences are folded first (count, least conversation, digest of
their ids), so a conversation that very many share is one key. Distinct keys are
range-sorted; every task cuts its run of keys into chunks of bounded size and
builds one adaptive radix tree for each. A chunk's tree has all ancestors of its
keys, and only byte depths that are whole turns make rows, also inside a
compressed prefix.

Chunks share the nodes on their borders (the root, a first turn that a third of
all conversations have), so rows are partial: sums over a node's id give its
members, its least conversation, whether it has children, and one owner among its
chunks. With these the chunks are streamed once more in tree order, with a stack
as deep as a conversation, for sums over subtrees in which every node counts at
its owner alone; a last sum over the node's id completes them. A task never holds
more than a chunk, and a node's rows are as many as its chunks.

Defined results. Null role or text: empty. Null turn: before all others. Turns of
one number: by their ids. Null conversation id: no conversation, left out.
``c % 100`` is the SQL remainder (sign of c). Repeated conversations and turns
count each time. Empty table: no rows (no root). Extra columns are ignored. A
conversation is one record, so its turns' ids (16 bytes each) sit in one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.art import Tree
from tidewater.llm.storage import Scratch
from tidewater.llm.streams import runs

#: Bytes of a turn's id.
WIDTH = 16
#: Bytes of keys in one chunk's tree.
CHUNK_BYTES = 1 << 22
#: Conversation ids that are joined to one text before the digest.
ID_BLOCK = 4096
GROUP, HEADS = 100, 6


def _turn_id(role: Column, text: Column) -> Column:
    """128 bits (as hex) that stand for a turn; the role's length keeps the two apart."""
    told = F.concat_ws(":", F.length(role).cast("string"), role, text)
    return F.substring(F.sha2(told, 256), 1, 2 * WIDTH)


def sequences(turns: DataFrame) -> DataFrame:
    """One row per conversation (columns conv_id, turn, role, text): ``turns`` in
    order, each with its id and the code points of its text. Texts stay behind."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    t = turns.filter("conv_id is not null").select(
        "conv_id", F.struct("turn", _turn_id(role, text).alias("u"), F.length(text).cast("long").alias("len")).alias("one")
    )
    ordered = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("rows"))
    return ordered.select("conv_id", F.transform("rows", lambda r: F.struct(r.u.alias("u"), r.len.alias("len"))).alias("turns"))


def rebuild(convs: DataFrame) -> DataFrame:
    """Conversations that begin with the first turns of their group's first one."""
    h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    c = convs.select("conv_id", "turns", h.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    heads = convs.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, HEADS - 1).alias("head"))
    both = c.join(heads, F.col("base") == F.col("head_id"), "left")
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return both.select("conv_id", F.concat(head, own).alias("turns"))


def _digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the ids under each key, from (key, conv_id).

    Ids are first joined to texts of at most ID_BLOCK ids; a digest reads its
    texts as a stream, so a key that very many share needs no memory."""
    block = F.floor(F.col("conv_id") / ID_BLOCK)
    texts = ends.groupBy("key", block.alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, h, done = None, None, []
        for batch in batches:
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k != key or h is None:
                    if h is not None:
                        done.append((key, h.hexdigest()))
                    key, h = k, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done])], names=["key", "ends_sha256"])
                done = []
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()])], names=["key", "ends_sha256"])

    return texts.repartition("key").sortWithinPartitions("key", "block").mapInArrow(run, "key binary, ends_sha256 string")


_PARTIAL = "chunk long, pos long, depth long, node binary, n long, low long, len long, own_ends boolean, kids long"


def _rows(tree: Tree, chunk: int) -> list[list]:
    """Rows of the tree's turn-aligned depths in tree order, parents first; a value
    is (conversations, least of them, code points of each turn's text)."""
    rows: list[list] = []
    path: list[int] = []  # rows of the current path, by depth
    known = 0  # depths of the path whose texts' lengths are known
    digests = [hashlib.sha256()]
    trail = bytearray()

    def close(depth: int) -> None:
        while len(path) > depth:
            at = rows[path.pop()]
            if path:
                up = rows[path[-1]]
                up[4] += at[4]
                up[5] = min(up[5], at[5])
                up[7] += 1

    for begin, label, node in tree.walk():
        close(begin // WIDTH + 1)
        known = min(known, len(path))
        del trail[begin:], digests[begin // WIDTH + 1 :]
        trail += label
        for depth in range(len(path), len(trail) // WIDTH + 1):
            if depth:
                h = digests[depth - 1].copy()
                h.update(trail[(depth - 1) * WIDTH : depth * WIDTH])
                digests.append(h)
            path.append(len(rows))
            rows.append([chunk, len(rows), depth, digests[depth].digest()[:WIDTH], 0, 1 << 62, 0, 0])
        if node.value is not None:
            n, low, lens = node.value
            at = rows[path[-1]]
            at[4] += n
            at[5] = min(at[5], low)
            for depth in range(max(known, 1), len(path)):
                rows[path[depth]][6] = lens[depth - 1]
            known = len(path)
    close(0)
    return rows


_PARTIAL = pa.schema(
    [("chunk", pa.int64()), ("pos", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("n", pa.int64()), ("low", pa.int64()), ("len", pa.int64()), ("kids", pa.int64())]
)


def _trees(keys: DataFrame) -> DataFrame:
    """Partial rows of every chunk's tree, from sorted (key, n, low, lens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        tree, held = Tree(), 0

        def out() -> Iterator[pa.RecordBatch]:
            rows = _rows(tree, chunk)
            for a in range(0, len(rows), 50_000):
                columns = zip(*rows[a : a + 50_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARTIAL, strict=True)], schema=_PARTIAL)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "n", "low", "lens")]
            for key, n, low, lens in zip(*columns, strict=True):
                if held >= CHUNK_BYTES:
                    yield from out()
                    chunk, tree, held = chunk + 1, Tree(), 0
                tree.insert(key, (n, low, lens))
                held += len(key) + WIDTH
        if held:
            yield from out()

    return keys.mapInArrow(run, "chunk long, pos long, depth long, node binary, n long, low long, len long, kids long")


def _subtrees(rows: DataFrame) -> DataFrame:
    """Per partial row: what the chunk adds to its node's subtree sums, from rows
    sorted by chunk and tree order. ``weight`` and ``leaf`` are zero but at a
    node's owner, so each node enters its ancestors' sums once."""
    schema = pa.schema(
        [("node", pa.binary()), ("parent_low", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()), ("saved", pa.decimal128(38, 0))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []  # open rows: node, parent_low, kids, leaves, saved; and own low
        done: list[list] = []
        now = None

        def close(depth: int) -> None:
            while len(stack) > depth:
                at = stack.pop()
                if stack:
                    up = stack[-1]
                    up[3] += at[3]
                    up[4] += at[4]
                done.append(at[:5])

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            names = ("chunk", "depth", "node", "low", "owned", "leaf", "weight")
            for chunk, depth, node, low, owned, leaf, weight in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                if chunk != now:
                    close(0)
                    now = chunk
                close(depth)
                up = stack[-1] if stack else None
                if up is not None and owned:
                    up[2] += 1
                stack.append([node, up[5] if up is not None else None, 0, leaf, weight, low])
            if len(done) >= 20_000:
                yield out()
        close(0)
        if done:
            yield out()

    return rows.mapInArrow(run, "node binary, parent_low long, kids long, leaves long, saved decimal(38,0)")


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row per trie node, from (conv_id, turns); see the module."""
    scratch = Scratch(convs.sparkSession, "prefix-trie")
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t.u), ""))
    flat = convs.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t.len).alias("lens"))
    flat = scratch.write(flat, "sequences")
    keys = flat.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"), F.first("lens").alias("lens"))
    partial = scratch.write(_trees(keys.repartitionByRange("key").sortWithinPartitions("key")), "partial")

    whole = partial.groupBy("node").agg(
        F.sum("n").alias("members"), F.min("low").alias("least"), F.min("chunk").alias("owner"), F.max("kids").alias("most_kids")
    )
    owned = F.col("chunk") == F.col("owner")
    rows = partial.join(whole, "node").select(
        "chunk", "pos", "depth", "node", F.col("least").alias("low"), owned.alias("owned"),
        F.when(owned & (F.col("most_kids") == 0), 1).otherwise(0).cast("long").alias("leaf"),
        F.when(owned, (F.col("members") - 1) * F.col("len")).otherwise(0).cast("long").alias("weight"),
    )
    sums = _subtrees(rows.repartition("chunk").sortWithinPartitions("chunk", "pos")).groupBy("node").agg(
        F.min("parent_low").alias("parent_conv_id"), F.sum("kids").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").cast("long").alias("saved_tokens")
    )
    nodes = partial.groupBy("node").agg(F.min("low").alias("conv_id"), F.min("depth").alias("depth"), F.sum("n").alias("n_convs"))
    ends = _digests(flat.select(F.unhex(F.substring(F.sha2("key", 256), 1, 2 * WIDTH)).alias("key"), "conv_id"))
    nothing = F.lit(hashlib.sha256().hexdigest())
    return nodes.join(sums, "node").join(ends.withColumnRenamed("key", "node"), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256")
    )
