"""Vector best-fit packing of documents into fixed-length sequences.

Tokens are counted where Spark puts the texts; only (id, piece, length) rows go
on. A bin has three residual capacities: tokens, documents and attention cost
(the sum of squared lengths). Pieces of equal length are interchangeable, so the
packer needs no more than how many pieces there are of each length, a histogram
with at most one row per possible length, and works on groups of equal bins. It
takes lengths in descending order and puts each into the feasible group with the
best score, by weighted dot product of demand and residual or by residual norm,
under every constraint. The result is a table of runs (length, ranks from to,
first bin, pieces a bin, offset); each piece finds its place by its rank among
the pieces of its length. Ranks come from counts per (length, hash bucket) and a
numbering inside each, so a length that a third of all pieces share is spread.

The size of the histogram and of the runs depends on the sequence length, not on
the data: every run ends a length or a group of bins, and bins of a group stay
together.

Defined results. Null or empty text: one piece that holds the end token alone.
Null ids and repeated rows are packed one by one; pieces equal in id, number,
length and checksum may swap places. Empty table: no rows. Only documents longer
than a sequence are cut; the first piece takes the remainder. Extra columns are
ignored.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.storage import Scratch

END_TOKEN = 0
#: Letters on whose classes every Unicode version agrees: the fast encoder is used for them alone.
COMMON_TEXT = r"[^\t\n\r\x20-\x7EÀ-ÖØ-öø-ÿ]"


@dataclass(frozen=True)
class Capacity:
    """Of one sequence. The defaults for documents and cost never bind beyond
    what the token limit implies; smaller ones do."""

    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048
    #: Weights of the three dimensions in the score.
    weights: tuple[float, float, float] = (1.0, 0.05, 0.2)
    #: "norm" (smallest weighted residual left) or "dot" (largest weighted dot product).
    select: str = "norm"


_ENCODERS: dict[str, tuple] = {}


def _encoder(name: str) -> tuple:
    """(tokenizer, fast encoder with the same vocabulary or None, test for texts beyond the fast one)."""
    if name not in _ENCODERS:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(public_tokenizers.path(name))
        # The fast encoder knows no added tokens: texts that hold one's string go to the tokenizer.
        added = [re.escape(t.content) for t in whole.get_added_tokens_decoder().values()]
        fast = None
        if name == "byte_bpe_50k.json":
            with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _ENCODERS[name] = (whole, fast, re.compile("|".join([COMMON_TEXT, *added])))
    return _ENCODERS[name]


def encode(text: str, name: str) -> np.ndarray:
    """Ids of a text, then the end token."""
    whole, fast, rare = _encoder(name)
    if fast is not None and not rare.search(text):
        ids = fast.encode_to_numpy(text, disallowed_special=())
    else:
        ids = np.array(whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    return np.append(ids.astype("<u4"), np.uint32(END_TOKEN))


def cut(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first takes the remainder."""
    first = n % limit or limit
    return [(0, first), *((s, limit) for s in range(first, n, limit))]


def pieces(
    docs: DataFrame, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 (and ids)."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, rows, ids_of = [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "", tokenizer)
                for p, (start, length) in enumerate(cut(len(ids), limit)):
                    part = ids[start : start + length]
                    which.append(i)
                    rows.append((p, start, length, zlib.crc32(part.tobytes())))
                    if with_ids:
                        ids_of.append(part.astype(np.int32))
            p, s, n, c = zip(*rows, strict=True) if rows else ((), (), (), ())
            arrays = [batch.column(0).take(pa.array(which, pa.int32())), pa.array(p, pa.int32()), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array(c, pa.int64())]
            if with_ids:
                arrays.append(pa.array(ids_of, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _score(length: int, left: tuple[int, int, int], cap: Capacity) -> float:
    """Smaller is better, for a bin with ``left`` residual capacities."""
    size = (cap.tokens, cap.documents, cap.cost)
    need = (length, 1, length * length)
    if cap.select == "dot":
        return -sum(w * (n / s) * (1 - r / s) for w, n, r, s in zip(cap.weights, need, left, size, strict=True))
    return sum(w * ((r - n) / s) ** 2 for w, n, r, s in zip(cap.weights, need, left, size, strict=True))


def plan(histogram: dict[int, int], cap: Capacity) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, end rank, first bin, pieces a bin, offset)."""
    runs: list[tuple[int, int, int, int, int, int]] = []
    groups: dict[tuple[int, int, int], list[tuple[int, int]]] = {}  # residuals -> (first bin, bins)
    bins = 0
    for length in sorted(histogram, reverse=True):
        rank, todo = 0, histogram[length]
        if length > cap.tokens or length * length > cap.cost or cap.documents < 1:
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        fresh = (cap.tokens, cap.documents, cap.cost)
        order = [(_score(length, left, cap), left) for left in groups if left[0] >= length and left[1] >= 1 and left[2] >= length * length]
        heapq.heapify(order)
        while todo:
            left = heapq.heappop(order)[1] if order else fresh
            per_bin = min(left[0] // length, left[1], left[2] // (length * length))
            if left in groups:
                first, count = groups[left].pop()
                if groups[left]:
                    heapq.heappush(order, (_score(length, left, cap), left))
                else:
                    del groups[left]
            else:
                first, count = bins, -(-todo // per_bin)
                bins += count
            full = min(count, todo // per_bin)
            partial = todo - full * per_bin if full < count else 0
            offset = cap.tokens - left[0]
            for at, n, k in ((first, full, per_bin), (first + full, int(partial > 0), partial)):
                if n:
                    runs.append((length, rank, rank + n * k, at, k, offset))
                    rank, todo = rank + n * k, todo - n * k
                    after = (left[0] - k * length, left[1] - k, left[2] - k * length * length)
                    groups.setdefault(after, []).append((at, n))
            used = full + (partial > 0)
            if used < count:
                groups.setdefault(left, []).append((first + used, count - used))
    return runs


def place(table: DataFrame, cap: Capacity, bucket_bits: int = 10) -> DataFrame:
    """Add sequence_id and offset to written ``pieces``."""
    histogram = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row a length
    runs = np.array(plan(histogram, cap), dtype=np.int64).reshape(-1, 6)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    # One sorted key for (length, rank): ranks are below 2 ** 50.
    keys = [(int(a) << 50) + int(b) for a, b in runs[:, :2]]

    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(1 << bucket_bits)).alias("bucket")
    d = table.select("*", bucket)
    counts = d.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    d = d.join(counts, ["length", "bucket"]).withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
    kind = table.schema["doc_id"].dataType.simpleString()
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = np.array(keys, dtype=np.int64)
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            k = np.searchsorted(starts, (length << 50) + rank, side="right") - 1
            _, first, _, at, per_bin, offset = runs[k].T
            j = rank - first
            more = [pa.array(at + j // per_bin), pa.array(offset + (j % per_bin) * length)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *more], names=[*kept, "sequence_id", "offset"])

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return d.select(*kept, "rank").mapInArrow(run, schema)


def pack(
    docs: DataFrame, cap: Capacity = Capacity(), id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json"
) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    scratch = Scratch(docs.sparkSession, "packing")
    table = scratch.write(pieces(docs, cap.tokens, id_col, text_col, tokenizer), "pieces")
    return place(table, cap)
