"""Long repeats by run-length indexes over the repetitive parts of a corpus.

Every 100-byte window of a text has an anchor, the 48-byte string in it with the
least hash (the leftmost of equal ones); neighbouring windows mostly share one.
Two equal windows have equal anchors, so a window whose anchor occurs once in the
corpus is no repeat. What is left are runs of windows with anchors that occur
again, each with the bytes it spans, its part:

1. Tasks hash the windows of their texts. An anchor that a block of texts holds
   more than once is settled there and leaves as one entry a text, the others
   meet by hash. Texts learn which of their anchors occur again, each once.
2. Texts that have any cut their parts. Parts that agree in a block of texts are
   folded: the first stays, the others' windows are repeats. The rest are dealt
   out by their anchor, so all places of a window meet.
3. Each task builds run-length indexes (``rindex``) over bounded chunks of parts,
   in the order of the documents, and streams the parts through them: every
   window that also begins at an earlier place is a repeat. Equal parts are one
   part of the index, at the place of the first; the others repeat it whole. A
   part whose anchor has no other one is left out, as nothing could match it.

An anchor with more parts than HOT (the edge of a passage that a third of all
texts hold) has its parts cut into single windows dealt out by the window's own
hash, so no anchor's parts need to fit a task; a window of very many places is
folded as it is read. What a worker holds at a time is a block, a place of anchors
or a chunk, whatever the size of the corpus. Texts are moved once; documents
without a repeated anchor are finished from their row alone.

Defined results. Null or empty text, or less than a window: nothing removed.
Documents are in the order of their ids, null after all others, those of one id
by the hash of their text. Rows that share id and text are one document, each with
its result. Empty table: no rows. Extra columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import rindex
from tidewater.llm.storage import Scratch
from tidewater.llm.wordhash import constants, mix

LENGTH = 100
#: Bytes hashed at a time; longer texts are cut into overlapping slices.
SLICE = 1 << 18
#: Runs of windows that a task settles or folds at a time.
BLOCK_RUNS = 1 << 18
#: Bytes of text whose anchors meet in one place.
PLACE_BYTES = 1 << 26
#: Pairs of texts and settled anchors that a place holds before it folds equal ones.
FOLD_PAIRS = 1 << 20
#: Rows that a worker hands over at a time.
OUT_ROWS = 1 << 14
#: Bytes of parts in one index.
CHUNK_BYTES = 1 << 21
#: Parts of one anchor that are dealt out together.
HOT = 1 << 14

_NO_ID = (1 << 63) - 1


def anchor_size(length: int) -> int:
    return 8 * max(1, length // 16)


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes (a multiple of 8) at every place."""
    m = len(data) - size + 1
    eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    out = np.zeros(m, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k, c in enumerate(constants(505, size // 8)):
            part = eight[8 * k : 8 * k + m] * c
            part ^= part >> np.uint64(32)
            out += part * (c ^ np.uint64(0x5851F42D4C957F2C))
    return mix(out)


def _anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all anchor-sized strings, and of each window its anchor's place."""
    h = _hashes(data, anchor_size(length))
    place = np.uint64(2 * SLICE - 1)
    least = h & ~place | np.arange(len(h), dtype=np.uint64)
    wide, width = length - anchor_size(length) + 1, 1
    while 2 * width <= wide:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wide:
        least = np.minimum(least[: len(least) - (wide - width)], least[wide - width :])
    return h, (least & place).astype(np.int64)


def window_runs(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, first window, windows, anchor's hash) of the runs of windows that
    share an anchor, some texts at a time."""
    slices, size = [], 0

    def out() -> tuple[np.ndarray, ...]:
        data = np.frombuffer(b"".join(s for _, _, s in slices), dtype=np.uint8)
        ends = np.cumsum([len(s) for _, _, s in slices])
        h, place = _anchors(data, length)
        valid = np.zeros(len(place), dtype=bool)
        for end, (_, _, s) in zip(ends, slices, strict=True):
            valid[end - len(s) : end - length + 1] = True
        at = np.flatnonzero(valid)
        p = place[at]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (p[1:] != p[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        of = np.searchsorted(ends, at[first], side="right")
        texts_of, offsets = np.array([t for t, _, _ in slices]), np.array([o for _, o, _ in slices])
        begin = at[first] - (ends[of] - np.array([len(s) for _, _, s in slices])[of]) + offsets[of]
        return texts_of[of], begin, np.diff(np.append(first, len(at))), h[p[first]]

    for i, text in enumerate(texts):
        for o in range(0, max(len(text) - length + 1, 0), SLICE):
            piece = text[o : o + SLICE + length - 1]
            if slices and size + len(piece) > SLICE + length - 1:
                yield out()
                slices, size = [], 0
            slices.append((i, o, piece))
            size += len(piece)
    if slices:
        yield out()


def _blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple]:
    """(batch's rows of a block, their texts, runs) of about BLOCK_RUNS runs; a run's
    text is its place among the block's rows."""
    for batch in batches:
        a, size, per = 0, 0, BLOCK_RUNS * (length // 3)
        sizes = pc.binary_length(batch.column("text")).to_pylist()
        for b, n in enumerate(sizes):
            size += n
            if size >= per or b + 1 == len(sizes):
                rows = batch.slice(a, b + 1 - a)
                some = rows.column("text").cast(pa.binary()).to_pylist()
                found = [np.concatenate(x) for x in zip(*window_runs(some, length), strict=True)]
                if found:
                    yield rows, some, found
                a, size = b + 1, 0


def _by_key(keys: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """Rows (key, hashes) from sorted pairs."""
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    ends = (8 * np.append(first, len(keys))).astype(np.int32)
    told = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(hashes)])
    return pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), told], names=["key", "hashes"])


def _pairs(keys: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in the order of the keys."""
    order = np.lexsort((hashes, keys))
    keys, hashes = keys[order], hashes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (hashes[1:] != hashes[:-1])
    return keys[new], hashes[new]


def _repeated_anchors(texts: DataFrame, places: int, length: int) -> DataFrame:
    """(key, hashes): the anchors of each text that occur again, from (key, text)."""
    schema = pa.schema([("place", pa.int64()), ("settled", pa.bool_()), ("keys", pa.binary()), ("hashes", pa.binary())])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, (of, _, _, h) in _blocks(batches, length):
            keys = rows.column("key").to_numpy().view(np.uint64)[of]
            order = np.argsort(h, kind="stable")
            keys, h = keys[order], h[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = h[1:] != h[:-1]
            many = ~(new & np.append(new[1:], True))
            out = []
            # Those that occur again in this very block go by their text, so a text
            # of many copies hears of each anchor once; the others go by the anchor.
            settled = _pairs(keys[many], h[many])
            for done, (k, x), deal in ((True, settled, settled[0]), (False, (keys[new], h[new]), h[new])):
                to = (deal % np.uint64(places)).astype(np.int64)
                by = np.argsort(to, kind="stable")
                cuts = np.flatnonzero(np.diff(to[by], prepend=-1))
                for a, b in zip(cuts, [*cuts[1:], len(by)], strict=False):
                    out.append((int(to[by[a]]), done, k[by[a:b]].tobytes(), x[by[a:b]].tobytes()))
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list[tuple]] = {False: [], True: []}  # (keys, hashes) as buffers
        now, pairs, most = None, 0, FOLD_PAIRS

        def taken(done: bool) -> tuple[np.ndarray, ...]:
            both = tuple(np.frombuffer(b"".join(x), dtype=np.uint64) for x in zip(*held[done], strict=True))
            held[done].clear()
            return both

        def out() -> Iterator[pa.RecordBatch]:
            if held[True]:
                yield _by_key(*_pairs(*taken(True)))
            if held[False]:
                keys, h = taken(False)
                order = np.argsort(h, kind="stable")
                h = h[order]
                keys = keys[order]
                same = h[1:] == h[:-1]
                again = np.append(same, False) | np.append(False, same)
                keys, h = keys[again], h[again]
                del order, same, again
                yield _by_key(*_pairs(keys, h))

        for batch in batches:
            rows = (batch.column(c) for c in schema.names)
            for place, settled, keys, hashes in zip(*rows, strict=True):
                if place.as_py() != now:
                    yield from out()
                    now, pairs, most = place.as_py(), 0, FOLD_PAIRS
                held[settled.as_py()].append((keys.as_buffer(), hashes.as_buffer()))
                if not settled.as_py():
                    continue
                pairs += keys.as_buffer().size // 8
                if pairs > most:  # the same texts, block after block
                    k, x = _pairs(*taken(True))
                    held[True].append((k, x))
                    pairs, most = len(k), max(FOLD_PAIRS, 2 * len(k))
        yield from out()

    met = texts.mapInArrow(meet, "place long, settled boolean, keys binary, hashes binary")
    met = met.repartition("place").sortWithinPartitions("place")
    told = met.mapInArrow(settle, "key long, hashes binary")
    return told.groupBy("key").agg(F.collect_list("hashes").alias("hashes"))


_PART = "dest long, ord long, key long, start long, windows long, body binary"
_PARTS = pa.schema(
    [("dest", pa.int64()), ("ord", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("windows", pa.int64()), ("body", pa.binary())]
)


def _parts(texts: DataFrame, length: int) -> DataFrame:
    """Parts of (ord, key, text, hashes); those with a null body are known repeats."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, some, (of, begin, windows, h) in _blocks(batches, length):
            known = [np.frombuffer(b"".join(x), dtype=np.uint64) for x in rows.column("hashes").to_pylist()]
            salt = mix(np.arange(1, len(some) + 1, dtype=np.uint64))
            code = np.concatenate([mix(x ^ s) for x, s in zip(known, salt, strict=True)])
            keep = np.flatnonzero(np.isin(mix(h ^ salt[of]), code))
            if not len(keep):
                continue
            ord_, key = rows.column("ord").to_numpy()[of[keep]], rows.column("key").to_numpy()[of[keep]]
            order = np.lexsort((begin[keep], key, ord_, windows[keep], h[keep]))
            ord_, key, keep = ord_[order], key[order], keep[order]
            of, begin, windows, h = of[keep], begin[keep], windows[keep], h[keep]
            # Parts that agree have one anchor and as many windows; those that share
            # them are told apart by their bytes, one such group at a time.
            bounds = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (windows[1:] != windows[:-1])))
            sizes = np.diff(np.append(bounds, len(h)))
            first, fresh = np.ones(len(h), dtype=bool), np.ones(len(h), dtype=bool)
            for a, n in zip(bounds[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
                seen: dict[bytes, int] = {}
                w = int(windows[a]) + length - 1
                for i, (t, at) in enumerate(zip(of[a : a + n].tolist(), begin[a : a + n].tolist(), strict=True), a):
                    j = seen.setdefault(some[t][at : at + w], i)
                    if j != i:
                        first[i] = False
                        fresh[i] = ord_[i] != ord_[j] or key[i] != key[j] or begin[i] != begin[j]
            told = np.flatnonzero(fresh)
            told = told[np.lexsort((begin[told], key[told], ord_[told]))]  # neighbours overlap, so they compress
            for a in range(0, len(told), OUT_ROWS):
                i = told[a : a + OUT_ROWS]
                cuts = zip(of[i].tolist(), begin[i].tolist(), windows[i].tolist(), first[i].tolist(), strict=True)
                bodies = [some[t][at : at + w + length - 1] if body else None for t, at, w, body in cuts]
                columns = [h[i].view(np.int64), ord_[i], key[i], begin[i], windows[i]]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(bodies, pa.binary())], schema=_PARTS)

    return texts.mapInArrow(cut, _PART)


def _single_windows(parts: DataFrame, length: int) -> DataFrame:
    """Every window of ``parts`` as a part of its own, dealt out by its own hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                rows = batch.slice(a, 1000)
                w = rows.column("windows").to_numpy()
                of = np.repeat(np.arange(len(w)), w)
                at = np.arange(len(of)) - np.repeat(np.cumsum(w) - w, w)
                bodies = rows.column("body").to_pylist()
                told = [bodies[i][j : j + length] for i, j in zip(of.tolist(), at.tolist(), strict=True)]
                dest = [int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "big", signed=True) for x in told]
                ids = [rows.column(c).to_numpy()[of] for c in ("ord", "key", "start")]
                columns = [dest, ids[0], ids[1], ids[2] + at, np.ones(len(of), dtype=np.int64)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(told, pa.binary())], schema=_PARTS)

    return parts.mapInArrow(cut, _PART)


def _marked(parts: DataFrame, length: int) -> DataFrame:
    """(ord, key, start, windows) of the repeats in ``parts``, from rows sorted by
    dest: chunks of whole dests, one index each."""
    schema = pa.schema(list(_PARTS)[1:5])

    def folded(chunk: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, pa.RecordBatch]:
        """(the first of equal parts in the order of places, repeats that are the others)"""
        rows = pa.Table.from_batches(chunk).combine_chunks().to_batches()[0]
        _, ord_, key, start, windows = (rows.column(c).to_numpy() for c in _PARTS.names[:5])
        order = np.lexsort((start, key, ord_))
        o, k, s = ord_[order], key[order], start[order]
        order = order[np.append(True, (o[1:] != o[:-1]) | (k[1:] != k[:-1]) | (s[1:] != s[:-1]))]  # the same place once
        seen: set[bytes] = set()
        fresh = np.zeros(len(order), dtype=bool)
        bodies = rows.column("body")
        for a in range(0, len(order), OUT_ROWS):
            for i, body in enumerate(bodies.take(pa.array(order[a : a + OUT_ROWS])).to_pylist(), a):
                fresh[i] = body not in seen
                seen.add(body)
        copies = order[~fresh]
        columns = [ord_[copies], key[copies], start[copies], windows[copies]]
        return rows.take(pa.array(order[fresh])), pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    def repeats(chunk: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, copies = folded(chunk)
        yield copies
        _, group, size = np.unique(rows.column("dest").to_numpy(), return_inverse=True, return_counts=True)
        rows = rows.filter(pa.array(size[group] > 1))
        if not rows.num_rows:
            return
        ord_, key, start = (rows.column(c).to_numpy() for c in ("ord", "key", "start"))
        index = rindex.build(rows.column("body").to_pylist(), length)
        at = rindex.earlier(index)
        begins = index.ends - index.sizes
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1] + 1)) if len(at) else np.zeros(0, dtype=np.int64)
        of = np.searchsorted(begins, at[first], side="right") - 1
        found = [ord_[of], key[of], start[of] + at[first] - begins[of], np.diff(np.append(first, len(at)))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: list[pa.RecordBatch] = []  # rows of dests that are complete
        tail: list[pa.RecordBatch] = []  # and of the one that is being read
        n_whole, n_tail, most, last = 0, 0, 2 * CHUNK_BYTES, None
        for batch in batches:
            if not batch.num_rows:
                continue
            dest = batch.column("dest").to_numpy()
            grown = np.append(0, np.cumsum(pc.binary_length(batch.column("body")).to_numpy()))
            # Where a chunk may end: before a row of another dest.
            ends = np.flatnonzero(dest[1:] != dest[:-1]) + 1
            if tail and dest[0] != last:
                ends = np.append(0, ends)
            a = 0
            while len(ends):
                size = n_whole + n_tail + grown[ends] - grown[a]
                fit = int(np.searchsorted(size, CHUNK_BYTES, side="right"))
                take = max(fit, 0 if whole else 1)  # one dest at least
                if take:
                    b = int(ends[take - 1])
                    whole, n_whole, tail, n_tail, most = [*whole, *tail, batch.slice(a, b - a)], int(size[take - 1]), [], 0, 2 * CHUNK_BYTES
                    a, ends = b, ends[take:]
                if take > fit or len(ends):
                    yield from repeats(whole)
                    whole, n_whole = [], 0
            tail.append(batch.slice(a))
            n_tail += int(grown[-1] - grown[a])
            if n_tail > most:  # one window at very many places
                rows, copies = folded(tail)
                yield copies
                tail, n_tail = [rows], int(pc.sum(pc.binary_length(rows.column("body"))).as_py())
                most = max(2 * CHUNK_BYTES, 2 * n_tail)
            if whole and n_whole + n_tail > CHUNK_BYTES:
                yield from repeats(whole)
                whole, n_whole = [], 0
            last = dest[-1]
        if whole or tail:
            yield from repeats([*whole, *tail])

    return parts.repartition("dest").sortWithinPartitions("dest").mapInArrow(run, "ord long, key long, start long, windows long")


def _cleaned(texts: DataFrame, length: int) -> DataFrame:
    """(ord, key, n_removed, n_spans, kept_sha256) of (ord, key, text, marks)."""
    schema = pa.schema([("ord", pa.int64()), ("key", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, marks in zip(batch.column("text"), batch.column("marks"), strict=True):
                data = np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), dtype=np.uint8)
                spans = marks.values
                begin, windows = (spans.field(c).to_numpy() for c in ("start", "windows"))
                edge = np.zeros(len(data) + 1, dtype=np.int64)
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + windows + length - 1, -1)
                gone = np.cumsum(edge)[:-1] > 0
                starts = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                out.append((int(gone.sum()), starts, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            removed, n, sha = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("ord"), batch.column("key"), pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(sha, pa.string())], schema=schema
            )

    return texts.mapInArrow(run, "ord long, key long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256."""
    scratch = Scratch(docs.sparkSession, "repeats")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ord_ = F.coalesce(F.col("id").cast("long"), F.lit(_NO_ID))
    docs = docs.select("id", "text", ord_.alias("ord"), F.xxhash64("text").alias("key"))
    long = docs.filter(F.octet_length("text") >= length)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    again = _repeated_anchors(long.select("key", "text"), 1 + size // PLACE_BYTES, length)
    some = scratch.write(long.select("ord", "key", "text").join(again, "key"), "texts")

    parts = scratch.write(_parts(some, length), "parts")
    known = parts.filter("body is null").select("ord", "key", "start", "windows")
    open_ = parts.filter("body is not null")
    hot = scratch.write(open_.groupBy("dest").count().filter(F.col("count") > HOT).select("dest"), "hot")
    if not hot.isEmpty():
        single = _single_windows(open_.join(hot, "dest", "left_semi"), length)
        open_ = open_.join(hot, "dest", "left_anti").select(*_PARTS.names).unionByName(single)
    marks = scratch.write(_marked(open_, length).unionByName(known), "marks")

    spans = marks.groupBy("ord", "key").agg(F.collect_list(F.struct("start", "windows")).alias("marks"))
    cleaned = _cleaned(some.select("ord", "key", "text").join(spans, ["ord", "key"]), length)
    cleaned = cleaned.groupBy("ord", "key").agg(*[F.first(c).alias(c) for c in ("n_removed", "n_spans", "kept_sha256")])
    body = F.coalesce("text", F.lit(""))
    base = docs.select("id", "ord", "key", F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("whole"))
    return base.join(cleaned, ["ord", "key"], "left").select(
        "id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )
