"""Phrase collocations by vertical partitioning of a depth-truncated suffix tree.

Every place of a text starts a suffix of at most four words that ends with its
piece. The suffixes of a prefix form a subtree of the corpus's suffix tree; a
group of subtrees is what one task builds, so prefixes are shared out by a memory
budget: a word that starts more than BUDGET suffixes is extended by its next
word, such a pair by a third, and so on, level by level, each level counted over
the whole corpus. What is within the budget is grouped by a hash of its prefix
into as many groups as the budget asks for. The list of prefixes over the budget
has at most words / BUDGET entries a level and travels with the job.

Map tasks fold equal suffixes of a block of text before they are dealt out, so a
passage that very many documents repeat is one entry a block. A group's task
sorts its suffixes, which lays out its subtree's leaves in order, and reads the
count of every node of two to four words off the leaves' totals. Words travel as
64-bit hashes; the texts of words are kept for those frequent enough to occur in a
phrase.

Scores, the drop of phrases inside longer ones and the ranking are joins and a
window with a limit over the frequent phrases, in exact arithmetic.

Defined results. Null or empty text: no words. Null language: ``und``. Texts of
one language count together, repeated rows and ids each time. A language without
candidates has no rows; an empty table has none at all. Texts are read whole.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.storage import Scratch
from tidewater.llm.streams import runs
from tidewater.llm.wordhash import Words, blocks, flags, mix, words

DEPTH = 4
LEAST = 30
TOP = 2000
#: A phrase goes if a longer one around it has this percentage of its count.
COVERED = 80
UNKNOWN = "und"
#: Suffixes in a group's subtrees.
BUDGET = 1 << 20
#: Words that a map task folds at a time.
BLOCK_WORDS = 1 << 19

#: Bytes of text that are hashed at a time.
HASHED_BYTES = 1 << 19

#: ASCII bytes that end a piece; a space or a tab ends a word.
ENDS = b".,;:!?" + bytes(range(0x0A, 0x0E))
GAPS = b" \t" + ENDS


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, Words]:
    """Hashes of all words, the words from each to its piece's end (at most DEPTH),
    and the block they lie in."""
    w = words(texts, GAPS)
    h = w.hashes()
    h[h == 0] = 1  # 0 stands for no word
    n = len(h)
    ended = np.cumsum(flags(ENDS)[w.data], dtype=np.int32)
    new = np.ones(n + 1, dtype=bool)
    new[1:n] = ended[w.start[1:]] != ended[w.end[:-1] - 1]
    new[w.bounds] = True
    last = np.flatnonzero(new)  # first words of pieces, and the end
    reach = np.repeat(last[1:], np.diff(last)) - np.arange(n)
    return h, np.minimum(reach, DEPTH), w


class _Block:
    """Words of one language, gathered until they are folded."""

    def __init__(self):
        self.hashes: list[np.ndarray] = []
        self.reach: list[np.ndarray] = []
        self.texts: dict[int, bytes] = {}
        self.size = 0


def _next_keys(keys: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Key of a prefix from that of its first words and its last word."""
    with np.errstate(over="ignore"):
        return mix(keys * np.uint64(0x9E3779B97F4A7C15) + h + np.uint64(depth))


def _columns(h: np.ndarray, reach: np.ndarray) -> list[np.ndarray]:
    """The suffix of every word as DEPTH columns, 0 beyond its end."""
    n = len(h)
    out = [h]
    for k in range(1, DEPTH):
        nxt = np.zeros(n, dtype=np.uint64)
        nxt[: n - k] = h[k:]
        nxt[reach <= k] = 0
        out.append(nxt)
    return out


def _group_keys(columns: list[np.ndarray], heavy: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of each suffix, the key of its shortest prefix that is within the budget,
    and that prefix's depth (past the suffix's own words if none is)."""
    key = columns[0].copy()
    depth = np.ones(len(key), dtype=np.int64)
    over = np.isin(key, heavy[0]) if heavy and len(heavy[0]) else np.zeros(len(key), dtype=bool)
    for k in range(1, DEPTH):
        at = np.flatnonzero(over)
        if not len(at):
            break
        key[at] = _next_keys(key[at], columns[k][at], k)
        depth[at] = k + 1
        inside = columns[k][at] != 0
        known = heavy[k] if k < len(heavy) else np.zeros(0, dtype=np.uint64)
        over = np.zeros(len(key), dtype=bool)
        over[at[inside & np.isin(key[at], known)]] = True
    return key, depth


def _blocks(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[tuple[str, np.ndarray, np.ndarray, dict[int, bytes]]]:
    """(language, hashes, reach, words' texts) of blocks of about BLOCK_WORDS."""
    held: dict[str, _Block] = {}
    size = 0

    def out() -> Iterator[tuple]:
        for lang, b in held.items():
            yield lang, np.concatenate(b.hashes), np.concatenate(b.reach), b.texts

    for batch in batches:
        langs = np.array([x if x is not None else UNKNOWN for x in batch.column("lang").to_pylist()], dtype=object)
        column = batch.column("text")
        for lang in sorted(set(langs)):
            mine = column.take(pa.array(np.flatnonzero(langs == lang))).to_pylist()
            for _, some in blocks(mine, HASHED_BYTES):
                h, reach, w = _tokens(some)
                if not len(h):
                    continue
                b = held.setdefault(lang, _Block())
                b.hashes.append(h)
                b.reach.append(reach)
                if texts:
                    data = w.data.tobytes()
                    first = np.unique(h, return_index=True)[1]
                    for at in first:
                        b.texts.setdefault(int(h[at]), data[w.start[at] : w.end[at]])
                size += len(h)
                if size >= BLOCK_WORDS:
                    yield from out()
                    held, size = {}, 0
    yield from out()


def _dealt(keys: np.ndarray, groups: int) -> Iterator[tuple[int, np.ndarray]]:
    """(group, places) of keys shared out over groups."""
    if not len(keys):
        return
    group = (mix(keys) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order], prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        yield int(group[order[a]]), order[a:b]


def _place(rows: DataFrame, groups: int) -> DataFrame:
    """Rows of each language's groups together, one group after another, few a task."""
    rows = rows.withColumn("place", F.concat_ws(":", "group", "lang"))
    return rows.repartition(2 * groups, "place").sortWithinPartitions("place")


def _joined(run: pa.Table, column: str, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(run.column(column).to_pylist()), dtype=dtype)


def _packed(x: np.ndarray) -> bytes:
    """Compressed bytes, with their size: what goes through the JVM, and a shuffle of
    sorted columns, is a fraction of the plain array."""
    data = x.tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(x: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(x[8:], int.from_bytes(x[:8], "little"), codec="zstd", asbytes=True), dtype=dtype)


def _counts(docs: DataFrame, heavy: list[np.ndarray], groups: int, least: int) -> DataFrame:
    """(lang, key, f, word) of prefixes that occur at least ``least`` times: single
    words where ``heavy`` is empty (with a row of null key for the sum over all of a
    language's words), else one-word extensions of the last level's prefixes."""
    level = len(heavy)
    schema = pa.schema([("lang", pa.string()), ("group", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("texts", pa.list_(pa.binary()))])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, h, reach, texts in _blocks(batches, texts=not level):
            if level:
                key, depth = _group_keys(_columns(h, reach), heavy)
                h = key[(depth == level + 1) & (reach > level)]
            keys, n = np.unique(h, return_counts=True)
            rows = [
                (lang, g, keys[at].tobytes(), n[at].astype(np.int64).tobytes(), [] if level else [texts[int(k)] for k in keys[at]])
                for g, at in _dealt(keys, groups)
            ]
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "place"):
            keys, counts = _joined(run, "keys", np.uint64), _joined(run, "counts", np.int64)
            distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
            total = np.zeros(len(distinct), dtype=np.int64)
            np.add.at(total, inverse, counts)
            keep = np.flatnonzero(total >= least)
            ids, fs = distinct[keep].view(np.int64).tolist(), total[keep].tolist()
            said: list[str | None] = [None] * len(ids)
            if not level:
                texts = run.column("texts").combine_chunks().flatten().take(pa.array(first[keep]))
                ids, fs, said = [*ids, None], [*fs, int(total.sum())], [*(t.decode() for t in texts.to_pylist()), None]
            lang = run.column("lang")[0].as_py()
            columns = [pa.array([lang] * len(ids), pa.string()), pa.array(ids, pa.int64()), pa.array(fs, pa.int64()), pa.array(said, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "key", "f", "word"])

    rows = docs.mapInArrow(fold, "lang string, group long, keys binary, counts binary, texts array<binary>")
    return _place(rows, groups).mapInArrow(merge, "lang string, key long, f long, word string")


def _suffixes(docs: DataFrame, heavy: list[np.ndarray], groups: int) -> DataFrame:
    """Suffixes of two words and more, folded by block, in their groups: a list of
    words, columns of places in it and counts."""
    schema = pa.schema([("lang", pa.string()), ("group", pa.int64()), ("words", pa.binary()), ("codes", pa.binary()), ("counts", pa.binary())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, h, reach, _ in _blocks(batches, texts=False):
            columns = [c[reach > 1] for c in _columns(h, reach)]
            whole = columns[0]
            for k in range(1, DEPTH):
                whole = _next_keys(whole, columns[k], k)
            _, first, n = np.unique(whole, return_index=True, return_counts=True)
            columns = [c[first] for c in columns]
            for g, at in _dealt(_group_keys(columns, heavy)[0], groups):
                mine = [c[at] for c in columns]
                known, codes = np.unique(np.concatenate([*mine, np.zeros(1, dtype=np.uint64)]), return_inverse=True)
                codes = codes[:-1].reshape(DEPTH, -1).astype(np.uint32)
                order = np.lexsort(codes[::-1])  # neighbours alike: less to shuffle
                told = [known.tobytes(), _packed(codes[:, order]), _packed(n[at][order].astype(np.uint32))]
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip([lang, g, *told], schema, strict=True)], schema=schema)

    return _place(docs.mapInArrow(fold, "lang string, group long, words binary, codes binary, counts binary"), groups)


def _subtrees(suffixes: DataFrame, heavy: list[np.ndarray], least: int) -> DataFrame:
    """(lang, ws, f, part) of every group's nodes of two words and more: those with
    enough occurrences, and, as parts to be summed over groups, those above its
    prefixes."""
    schema = pa.schema([("lang", pa.string()), ("ws", pa.list_(pa.int64())), ("f", pa.int64()), ("part", pa.bool_())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "place"):
            lists = [np.frombuffer(x, dtype=np.uint64) for x in run.column("words").to_pylist()]
            known = np.unique(np.concatenate(lists))
            codes = np.concatenate(
                [
                    np.searchsorted(known, one).astype(np.uint32)[_unpacked(x, np.uint32).reshape(DEPTH, -1)]
                    for one, x in zip(lists, run.column("codes").to_pylist(), strict=True)
                ],
                axis=1,
            )
            counts = np.concatenate([_unpacked(x, np.uint32) for x in run.column("counts").to_pylist()]).astype(np.int64)
            # The leaves in order; equal ones of several blocks stand side by side.
            pairs = [codes[k].astype(np.uint64) << np.uint64(32) | codes[k + 1] for k in (0, 2)]
            order = np.lexsort(pairs[::-1])
            del pairs, lists
            codes, counts = codes[:, order], counts[order]
            new = np.ones(len(counts), dtype=bool)
            new[1:] = codes[0, 1:] != codes[0, :-1]
            for k in range(1, DEPTH):
                new[1:] |= codes[k, 1:] != codes[k, :-1]
                at = np.flatnonzero(new)
                total = np.add.reduceat(counts, at)
                at, total = at[codes[k, at] != 0], total[codes[k, at] != 0]
                columns = [known[codes[j, at]] for j in range(DEPTH)]
                part = _group_keys(columns, heavy)[1] > k + 1
                keep = part | (total >= least)
                if not keep.any():
                    continue
                ws = np.stack([c[keep] for c in columns[: k + 1]], axis=1).view(np.int64)
                m = len(ws)
                ends = pa.array(np.arange(m + 1) * (k + 1), pa.int32())
                lang = pa.array([run.column("lang")[0].as_py()] * m, pa.string())
                nodes = pa.ListArray.from_arrays(ends, pa.array(ws.ravel()))
                yield pa.RecordBatch.from_arrays([lang, nodes, pa.array(total[keep]), pa.array(part[keep])], schema=schema)

    return suffixes.mapInArrow(build, "lang string, ws array<long>, f long, part boolean")


def phrase_counts(docs: DataFrame, scratch: Scratch, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Words (lang, key, f, word; null key: all words of the language) and phrases
    (lang, ws, f) that occur at least ``least`` times, as tables."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    few = 1 + size // (1 << 25)
    known = scratch.write(_counts(docs, [], few, least), "words")
    total = known.filter("key is null").agg(F.sum("f")).first()[0] or 0
    groups = 1 + 5 * total // (4 * BUDGET)

    def over(counts: DataFrame) -> np.ndarray:
        rows = counts.filter((F.col("f") > BUDGET) & F.col("key").isNotNull()).select("key").distinct().collect()
        return np.sort(np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64))

    heavy: list[np.ndarray] = []
    found = over(known)
    while len(found):
        heavy.append(found)
        if len(heavy) == DEPTH - 1:
            break
        found = over(_counts(docs, heavy, few, BUDGET))
    nodes = scratch.write(_subtrees(_suffixes(docs, heavy, groups), heavy, least), "nodes")
    parts = nodes.filter("part").groupBy("lang", "ws").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return known, nodes.filter("not part").select("lang", "ws", "f").unionByName(parts)


def _scored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """``phrases`` (lang, ws, f) with l, r and score of their lowest-scoring cut."""
    size = F.size("ws")
    cuts = phrases.select("lang", "ws", "f", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "ws", "f", "k", F.slice("ws", F.lit(1), F.col("k")).alias("left"), F.slice("ws", F.col("k") + 1, size - F.col("k")).alias("right"))
    left = counts.select("lang", F.col("ws").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("ws").alias("right"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    score = F.expr("cast(2000000 as decimal(38, 0)) * f div (cast(l as decimal(20, 0)) + r)")
    low = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low")
    return both.groupBy("lang", "ws", "f").agg(low).select("lang", "ws", "f", "low.l", "low.r", "low.score")


def _uncovered(phrases: DataFrame) -> DataFrame:
    """``phrases`` but those inside a longer one with most of their count."""
    parts = [
        F.struct(F.slice("ws", at, size).alias("ws"), F.lit(longer).alias("of"))
        for longer in range(3, DEPTH + 1)
        for size in range(2, longer)
        for at in range(1, longer - size + 2)
    ]
    inside = phrases.filter(F.size("ws") > 2).select("lang", "f", F.explode(F.filter(F.array(*parts), lambda p: p.of == F.size("ws"))).alias("p"))
    most = inside.groupBy("lang", F.col("p.ws").alias("ws")).agg(F.max("f").alias("most"))
    joined = phrases.join(most, ["lang", "ws"], "left")
    covered = F.coalesce(100 * F.col("most") >= COVERED * F.col("f"), F.lit(False))
    return joined.filter(~covered).select("lang", "ws", "f")


def _spelled(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` with ``phrase``, the words of ``ws`` (of at most DEPTH) joined by spaces."""
    one = rows.select("lang", "ws", F.posexplode("ws").alias("at", "key"))
    said = one.join(known.select("lang", "key", "word"), ["lang", "key"])
    phrase = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x.word), " ")
    return rows.join(said.groupBy("lang", "ws").agg(phrase.alias("phrase")), ["lang", "ws"])


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    scratch = Scratch(docs.sparkSession, "phrases")
    docs = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known, phrases = phrase_counts(docs, scratch, least)
    words_only = known.filter("key is not null").select("lang", F.array("key").alias("ws"), "f")
    scored = _scored(_uncovered(phrases), phrases.unionByName(words_only))
    # Ties at the limit stay until their words are known.
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"))
    rows = scored.withColumn("place", F.rank().over(best)).filter(F.col("place") <= top).drop("place")
    rows = _spelled(scratch.write(rows, "best"), known)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    sizes = known.filter("key is null").groupBy("lang").agg(F.sum("f").alias("n"))
    return rows.join(sizes, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", F.col("score").cast("long").alias("score"))
