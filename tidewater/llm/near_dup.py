"""Near-duplicates by one-permutation MinHash with optimal densification.

A document's set holds its distinct five-word shingles. One hash of each shingle
is cut into equal bins by its leading bits; the least hash in a bin is the bin's
value, and an empty bin takes the value of the first non-empty bin on its own
fixed random probe sequence. Bins form bands; documents that agree on a band
share a bucket.

Documents with equal sets are one class from the start, stood for by its least
id, so copies cost nothing further. In a bucket, candidate edges form a star: one
centre against all others, so pairs are as many as members. Each candidate is
confirmed on the full sets.

A member whose edge to the centre fails might still match another member. Members
of buckets that are not one component after the stars are dealt anew by their
rarest shingles: a pair that can link shares one of these (the prefix filter of
exact set joins), and members of a large group that differ too much no longer
meet. In a bucket of several components, tasks compare tiles of its members by
fixed-width bitmaps of their sets: bits that only one of two sets has bound what
they share, so hardly any pair that cannot link gets out, and of the pairs with one
other component a member's most promising come first (one, then four times as
many in each further round, which only a bitmap's false promise asks for). So every
pair that shares a bucket is compared, ruled out by a bound, or known to be
connected, while the pairs that leave a bucket stay in proportion to its members.

With 25 bands of 5 bins, a pair at the threshold of 0.85 shares no bucket with
probability 5e-7; a lower threshold asks for more bands (40 for 0.80: 1.3e-7).

Defined results. Null or empty text, or no word: an empty set, linked with
nothing. Fewer words than a shingle: the whole sequence is the one element. Null
id: linked with nothing, component null, kept. Rows that share an id are one
document with several texts: a link of any of them is a link of the id. Ties:
the least id stands for its group. Empty table: no rows. Extra columns, whatever
their names, are ignored or, in ``keep_one``, returned as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.components import components
from tidewater.llm.storage import Scratch
from tidewater.llm.streams import runs
from tidewater.llm.wordhash import blocks, constants, mix, words

SHINGLE = 5
BANDS, ROWS = 25, 5
PROBES = 1024
#: A link: PERCENT * union <= 100 * intersection.
PERCENT = 85
#: Bits of the map that stands for a set in a tile.
BITS = 4096
#: Members of a bucket that one tile compares with each other.
TILE = 4096


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    w = words(texts)
    h = w.hashes()
    n = len(h)
    c = constants(101, size)
    runs = np.zeros(max(n - size + 1, 0), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            runs += h[k : k + len(runs)] * c[k]
        runs = mix(runs)
        out = []
        for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True):
            if b - a >= size:
                out.append(np.unique(runs[a : b - size + 1]))
            elif b > a:
                whole = np.sum(h[a:b] * c[: b - a], dtype=np.uint64) + np.uint64(b - a) * c[-1]
                out.append(mix(np.array([whole], dtype=np.uint64)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return out


def layout(bands: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ``bands`` bands: where each bin begins (bin i holds hashes h with
    h * bins >> 64 == i), a fixed random probe sequence for each bin, band seeds."""
    bins = bands * ROWS
    edges = np.array([-(-(i << 64) // bins) for i in range(bins)], dtype=np.uint64)
    probe = (mix(np.arange(bins * PROBES, dtype=np.uint64) + np.uint64(1 << 40)) % np.uint64(bins)).astype(np.int64)
    return edges, probe.reshape(bins, PROBES), constants(303, bands)


_LAYOUT = layout(BANDS)


def sketch(s: np.ndarray, bins: tuple[np.ndarray, np.ndarray, np.ndarray] = _LAYOUT) -> np.ndarray:
    """Densified bin values of a non-empty sorted set."""
    edges, probe, _ = bins
    first = np.searchsorted(s, edges)
    filled = np.append(first[1:], len(s)) > first
    value = s[np.minimum(first, len(s) - 1)]
    empty = np.flatnonzero(~filled)
    for width in (32, PROBES):
        if not len(empty):
            break
        hit = filled[probe[empty, :width]]
        at = hit.argmax(axis=1)
        ok = hit[np.arange(len(empty)), at]
        value[empty[ok]] = value[probe[empty[ok], at[ok]]]
        empty = empty[~ok]
    if len(empty):  # a sequence that met no filled bin goes on in a circle
        full = np.flatnonzero(filled)
        value[empty] = value[full[np.searchsorted(full, empty) % len(full)]]
    return value


_BAND_C = constants(202, ROWS)


def band_keys(s: np.ndarray, bins: tuple[np.ndarray, np.ndarray, np.ndarray] = _LAYOUT) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((sketch(s, bins).reshape(-1, ROWS) * _BAND_C).sum(axis=1, dtype=np.uint64) + bins[2])


def _signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a whole set."""
    with np.errstate(over="ignore"):
        a = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        b = mix(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _sketches(docs: DataFrame, bands: int) -> DataFrame:
    """id, n_shingles, signature (s1, s2) and band keys, from columns id and text."""
    bins = layout(bands)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at, block in blocks(texts):
                sets = shingle_sets(block)
                sig = [_signature(s) for s in sets]
                keys = [band_keys(s, bins).view(np.int64) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(block)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([a for a, _ in sig], pa.int64()),
                        pa.array([b for _, b in sig], pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=["id", "n_shingles", "s1", "s2", "bands"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n_shingles long, s1 long, s2 long, bands array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """id and full set, from columns id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block in blocks(batch.column(1).to_pylist()):
                sets = [s.view(np.int64) for s in shingle_sets(block)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(block)), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"]
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Those ``pairs`` (a, b) whose full sets are similar enough, as a table."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    links = pairs.join(left, "a").join(right, "b").filter(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b")
    return scratch.write(links, "links")


def _can_link(n: Column, room: Column, other_n: Column, other_room: Column, percent: int) -> Column:
    """Sets of ``n`` and ``other_n`` shingles can be similar enough if they share
    no more than ``room`` of one and ``other_room`` of the other."""
    both = F.least(room, other_room)
    return 100 * both >= percent * (n + other_n - both)


def _stars(members: DataFrame, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Pairs of each bucket's centre with its other members, and these members."""
    m = members.withColumn("h", F.xxhash64("key", "id"))
    centre = m.groupBy("key").agg(F.min(F.struct("h", "id", "n")).alias("c")).select("key", F.col("c.id").alias("c"), F.col("c.n").alias("c_n"))
    m = members.join(centre, "key").filter(F.col("id") != F.col("c"))
    pairs = m.filter(_can_link(F.col("n"), F.col("n"), F.col("c_n"), F.col("c_n"), percent))
    pairs = scratch.write(pairs.select(F.greatest("id", "c").alias("a"), F.least("id", "c").alias("b")).distinct(), "pairs")
    return pairs, m.select("key", "id", "n")


def _by_rare_shingles(rest: DataFrame, sets: DataFrame, labels: DataFrame | None, percent: int, scratch: Scratch) -> DataFrame:
    """Members of open buckets in new buckets, one for each shingle of a prefix:
    key, set, id, n, room and the set's bitmap.

    In any fixed order of all shingles, two sets that share enough of them share
    one among the first ``n - needed + 1`` of each, where ``needed`` is the least
    intersection that a partner of the bucket's least size asks for. In ascending
    order of frequency these are the rarest, so the new buckets are small: what
    members of a group have in common is no key. A pair that meets under
    its first common shingle shares no more than what follows there, ``room``; a
    pair that this rules out elsewhere is compared under its first."""
    m = _relabelled(rest, labels)
    open_keys = m.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("n").alias("least")).filter("low < high")
    asked = m.join(open_keys.select("key", "least"), "key").groupBy("id").agg(F.min("least").alias("least"))
    one = sets.join(asked, "id").select("set", "id", "least", F.size("shingles").alias("n"), F.explode("shingles").alias("key"))
    one = scratch.write(one, "shingles")
    counted = one.join(one.groupBy("key").agg(F.count("*").alias("df")), "key")
    partner = F.greatest(F.col("least"), F.ceil(F.lit(percent) * F.col("n") / 100))
    needed = F.ceil(F.lit(percent) * (F.col("n") + partner) / (100 + percent))
    place = F.row_number().over(Window.partitionBy("set").orderBy("df", "key"))
    prefix = counted.withColumn("place", place).filter((F.col("place") <= F.col("n") - needed + 1) & (F.col("df") > 1))
    rows = prefix.select("key", "set", "id", "n", (F.col("n") - F.col("place") + 1).alias("room"))
    rows = scratch.write(_open(rows, labels), "rare")
    maps = _bitmaps(sets.join(rows.select("set").distinct(), "set", "left_semi"))
    return scratch.write(rows.drop("comp").join(maps, "set"), "mapped")


def _relabelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with ``comp``, the component so far of their id."""
    if labels is None:
        return rows.withColumn("comp", F.col("id"))
    label = labels.select(F.col("id").alias("l_id"), "component")
    return rows.join(label, rows.id == F.col("l_id"), "left").withColumn("comp", F.coalesce("component", "id")).drop("l_id", "component")


def _open(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows, with their component, of the buckets that hold several."""
    m = _relabelled(rows, labels)
    several = m.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("key")
    return m.join(several, "key")


def _bitmaps(sets: DataFrame) -> DataFrame:
    """(set, bits): a bit for each shingle's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for shingles in batch.column("shingles"):
                one = np.zeros(BITS, dtype=bool)
                one[mix(shingles.values.to_numpy().view(np.uint64)) % np.uint64(BITS)] = True
                bits.append(np.packbits(one).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("set"), pa.array(bits, pa.binary())], names=["set", "bits"])

    return sets.select("set", "shingles").mapInArrow(run, "set long, bits binary")


def _tiles(rows: DataFrame) -> DataFrame:
    """Rows dealt out to the tiles of their bucket: one where it has up to TILE
    members, else one for every two of its blocks."""
    blocks_ = rows.groupBy("key").agg(F.ceil(F.count("*") / (TILE // 2)).cast("int").alias("blocks"))
    blocks_ = blocks_.withColumn("blocks", F.when(F.col("blocks") <= 2, 1).otherwise(F.col("blocks")))
    block = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    m = rows.join(blocks_, "key").withColumn("block", block)
    m = m.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    tile = F.concat_ws(":", "key", F.least("block", "other"), F.greatest("block", "other"))
    return m.select(tile.alias("tile"), "block", F.col("blocks").alias("of"), "set", "id", "comp", "n", "room", "bits")


def _promising(rows: DataFrame, percent: int, most: int) -> DataFrame:
    """(a, b, more) of the pairs of different components in a tile that their bounds
    allow: of those of a member with one other component the ``most`` best, ``more``
    if there were others."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, "tile"):
            n, room, block = (tile.column(c).to_numpy().astype(np.int64) for c in ("n", "room", "block"))
            ids = tile.column("id").combine_chunks()
            of = tile.column("id").combine_chunks().dictionary_encode().indices.to_numpy()
            comp = tile.column("comp").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
            bits = np.frombuffer(b"".join(tile.column("bits").to_pylist()), dtype=np.uint64).reshape(len(n), -1)
            ones = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
            crossed = len(np.unique(block)) > 1  # a tile of two blocks compares one with the other
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

            def out(found=found, ids=ids) -> pa.RecordBatch:
                i, j, more = (np.concatenate(x) for x in zip(*found, strict=True))
                found.clear()
                return pa.RecordBatch.from_arrays([ids.take(pa.array(i)), ids.take(pa.array(j)), pa.array(more)], names=["a", "b", "more"])

            for i in range(len(n)):
                j = np.arange(i + 1, len(n))
                j = j[(comp[j] != comp[i]) & (of[j] != of[i])]
                if crossed:
                    j = j[block[j] != block[i]]
                both = np.minimum(np.minimum(n[j], room[j]), min(n[i], room[i]))
                j, both = (x[100 * both >= percent * (n[j] + n[i] - both)] for x in (j, both))
                if not len(j):
                    continue
                same = np.bitwise_count(bits[j] & bits[i]).sum(axis=1, dtype=np.int64)
                both = np.minimum(both, np.minimum(n[i] - (ones[i] - same), n[j] - (ones[j] - same)))
                j, both = (x[100 * both >= percent * (n[j] + n[i] - both)] for x in (j, both))
                if not len(j):
                    continue
                j = j[np.lexsort((-both, comp[j]))]
                first = np.flatnonzero(np.append(True, comp[j[1:]] != comp[j[:-1]]))
                size = np.diff(np.append(first, len(j)))
                keep = np.arange(len(j)) - np.repeat(first, size) < most
                found.append((np.full(keep.sum(), i), j[keep], np.repeat(size > most, size)[keep]))
                if len(found) >= 1000:
                    yield out()
            if found:
                yield out()

    rows = rows.repartition("tile").sortWithinPartitions("tile")
    return rows.mapInArrow(run, f"a {kind}, b {kind}, more boolean")


def _joined(links: DataFrame, labels: DataFrame | None, scratch: Scratch) -> DataFrame | None:
    """Components by ``links`` and all links before, for which ``labels`` stand."""
    if links.isEmpty():
        return labels
    if labels is not None:
        links = links.union(labels.select(F.col("id").alias("a"), F.col("component").alias("b")))
    return components(links, scratch)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, bands: int = BANDS
) -> DataFrame:
    """Per row: id, n_shingles, component_id (least id reachable), kept."""
    scratch = Scratch(docs.sparkSession, "near-dup")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    table = scratch.write(_sketches(docs, bands), "sketches")
    real = table.filter("n_shingles > 0 and id is not null")

    # Equal sets: one class, stood for by its least id.
    classes = real.groupBy("n_shingles", "s1", "s2").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    classes = scratch.write(classes, "classes")
    shared = classes.filter("n > 1")
    of_class = (
        real.select("id", "n_shingles", "s1", "s2").join(shared.drop("n"), ["n_shingles", "s1", "s2"]).select("id", "rep").distinct()
    )
    alone = real.join(classes.select("n_shingles", "s1", "s2", F.col("rep").alias("id")), ["n_shingles", "s1", "s2", "id"], "left_semi")
    members = alone.select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("key")).distinct()
    crowded = members.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1").select("key")
    members = scratch.write(members.join(crowded, "key"), "members")
    # Full sets of the documents that share a bucket, read by every round.
    sets = _sets(docs.join(members.select("id").distinct(), "id", "left_semi")).distinct()
    sets = scratch.write(sets.withColumn("set", F.monotonically_increasing_id()), "sets")

    pairs, rest = _stars(members, percent, scratch)
    labels = _joined(_confirmed(pairs, sets, percent, scratch), None, scratch)
    rest = _by_rare_shingles(rest, sets, labels, percent, scratch)
    tested, most = pairs, 1
    while True:
        found = scratch.write(_promising(_tiles(_open(rest, labels)), percent, most), "promising")
        pairs = found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        pairs = scratch.write(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        labels = _joined(_confirmed(pairs, sets, percent, scratch), labels, scratch)
        if found.filter("more").isEmpty():
            break
        tested, most = tested.union(pairs), 4 * most

    scratch.drop(sets, members)
    edges = of_class.select(F.col("id").alias("a"), F.col("rep").alias("b"))
    if labels is not None:
        edges = edges.union(labels.select(F.col("id").alias("a"), F.col("component").alias("b")))
    labels = scratch.write(components(edges, scratch), "components").select(F.col("id").alias("l_id"), "component")
    out = table.select("id", "n_shingles").join(labels, F.col("id") == F.col("l_id"), "left")
    component = F.coalesce("component", "id")
    return out.select(
        "id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, bands: int = BANDS
) -> DataFrame:
    """The rows of ``docs`` that stand for their group, with their own columns only.

    Every row with a text of its own under its (integer) id, null ids too, is a
    document; documents are in the order of id, null after all others, and text's
    hash, and the first of a group stays. Of rows that share id and text one stays,
    the least by a hash of the whole row. Rows without a word all stay."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"))
    worded = F.coalesce(F.col(f"row.{text_col}").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    blank, rows = rows.filter(~worded), rows.filter(worded)
    number = F.col(f"row.{id_col}").cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    place = F.coalesce(F.lpad(F.hex(number), 16, "0"), F.lit("null"))
    rows = rows.withColumn("at", F.concat_ws(":", place, F.hex(F.xxhash64(f"row.{text_col}"))))
    marks = near_duplicates(rows.select("at", F.col(f"row.{text_col}").alias("text")), "at", "text", percent, bands)
    out = marks.filter("not kept").select(F.col("id").alias("at")).distinct()
    kept = rows.join(out, "at", "left_anti")
    kept = kept.groupBy("at").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return kept.select("row").union(blank).select("row.*")
