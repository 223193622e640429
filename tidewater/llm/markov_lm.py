"""Language-model scoring with a hidden Markov model over word classes.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, then one end.
The most frequent words are classes of their own, the end is one, and all other
words fall into classes by their last letters. Latent states move from token to
token and emit classes; inside a class a word has the probability
``(count + 1) / mass``, where the mass of a class adds up its words' counts plus
one each, and one more for unseen words where the class can hold any. With one
state this is nearly the unigram base.

Counts cover all training documents and are summed over the partitions in a
shuffle on the word's hash. Training starts from fixed random shares of the
classes. ``START_ROUNDS`` rounds fit a mixture of unigrams, one a state, then
Baum-Welch makes ``PASSES`` passes; both over all training documents: every
partition adds up expected counts (of a document's state, then by the scaled
forward and backward recursions), and their sums give the next parameters. No
document is drawn, so the model does not depend on the layout of the input.
The scaled forward recursion over a whole text gives its exact probability.

The counts of the most frequent words travel with the job, a table of fixed
size; every other token meets its count in a join, so no count is left out.

Words are told apart by 64-bit hashes.

Defined results. Null or empty text: the end token alone. Null ids are not held
out. Repeated rows are scored, and learned from, one by one. Without training
documents N and V are 0, every base probability is 1, and the model's parameters
are uniform over classes. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.storage import Scratch
from tidewater.llm.wordhash import Words, blocks, mix, words

STATES = 8
#: Words that are classes of their own, and classes by last letters.
OWN_CLASSES = 1500
ENDING_CLASSES = 512
ENDING_BYTES = 3
#: Words whose counts travel with the job; all others are joined.
CARRIED = 60_000
START_ROUNDS = 5
PASSES = 3
#: Words from which on a document weighs no more in the mixture.
FULL_WEIGHT = 300
#: Tokens that the recursions hold at a time (a longer text makes a longer group).
GROUP_TOKENS = 400_000
SUMS = 64

END = np.uint64(0xE0D0E0D0E0D0E0D1)


def _endings(w: Words) -> np.ndarray:
    """Class of each word by its last bytes, from 0."""
    h = np.zeros(len(w.end), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(1, ENDING_BYTES + 1):
            at = w.end - k
            h = h * np.uint64(257) + np.where(at >= w.start, w.data[at] + np.uint64(1), np.uint64(0))
    return (mix(h) % np.uint64(ENDING_CLASSES)).astype(np.int64)


def held_out(id_col: Column, modulus: int = 7, remainder: int = 2) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % modulus == remainder


def word_counts(training: DataFrame) -> DataFrame:
    """h, ending, c of every token of ``training`` (column text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hs, es = [np.full(batch.num_rows, END)], [np.full(batch.num_rows, -1)]
            for _, block in blocks(batch.column(0).to_pylist()):
                w = words(block)
                hs.append(w.hashes())
                es.append(_endings(w))
            h, first, c = np.unique(np.concatenate(hs), return_index=True, return_counts=True)
            e = np.concatenate(es)[first]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(e.astype(np.int32)), pa.array(c)], names=["h", "ending", "c"])

    parts = training.select("text").mapInArrow(run, "h long, ending int, c long")
    return parts.groupBy("h").agg(F.min("ending").alias("ending"), F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What scoring needs of the counts; its size is fixed by the constants."""

    hashes: np.ndarray  # sorted, of the carried words
    counts: np.ndarray
    own: np.ndarray  # class of the carried words that are classes, else -1
    mass: np.ndarray  # of each class
    tokens: int
    distinct: int

    @property
    def classes(self) -> int:
        return len(self.mass)


def _most_frequent(counts: DataFrame, k: int) -> list:
    """The ``k`` words with the greatest counts (ties: least hash). A histogram of
    counts on a fine logarithmic scale first bounds what any task sends."""
    level = F.floor(F.log2("c") * 16).cast("int")
    steps = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()  # some hundred rows
    least, seen = 1, 0
    for r in sorted(steps, key=lambda r: -r["level"]):
        least, seen = r["least"], seen + r["n"]
        if seen >= k:
            break
    return counts.filter(F.col("c") >= least).orderBy(F.desc("c"), "h").limit(k).collect()


def vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    top = _most_frequent(counts, CARRIED)
    by_ending = {r["ending"]: r["m"] for r in counts.groupBy("ending").agg(F.sum(F.col("c") + 1).alias("m")).collect()}
    # Classes: 0 the end, then own classes, then endings (with a share for unseen words).
    end = int(END.astype(np.int64))
    owners = [r for r in top if r["h"] != end][:OWN_CLASSES]
    mass = np.ones(1 + len(owners) + ENDING_CLASSES)
    mass[0] = by_ending.get(-1, 1)
    for e, m in by_ending.items():
        if e >= 0:
            mass[1 + len(owners) + e] += m
    for k, r in enumerate(owners, start=1):
        mass[k] = r["c"] + 1
        mass[1 + len(owners) + r["ending"]] -= r["c"] + 1
    own = {r["h"]: k for k, r in enumerate(owners, start=1)} | {end: 0}
    carried = {r["h"]: r["c"] for r in top}
    if -1 in by_ending:  # the end is carried whatever its place: no join looks for it
        carried[end] = by_ending[-1] - 1
    h = np.array(list(carried), dtype=np.int64).view(np.uint64)
    order = np.argsort(h)
    return Vocabulary(
        h[order], np.array(list(carried.values()), dtype=np.int64)[order],
        np.array([own.get(x, -1) for x in carried], dtype=np.int64)[order], mass, int(total["n"] or 0), int(total["v"]),
    )


def encoded(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Per row: id, held_out, n_tokens, classes (binary, 16 bits each), known and
    carried (of carried words: how many, and the sum of log10(c + 1)), inside (the
    part of the score inside classes that needs no join), rare (hashes of the
    tokens whose counts must be joined)."""
    v = docs.sparkSession.sparkContext.broadcast(vars(vocab))  # plain values; CARRIED words at most
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = Vocabulary(**v.value)
        first_ending = voc.classes - ENDING_CLASSES
        log_mass = np.log10(voc.mass)
        end_count = float(voc.counts[voc.hashes == END].sum())
        for batch in batches:
            for at, block in blocks(batch.column(2).to_pylist()):
                w = words(block)
                h = w.hashes()
                k = np.minimum(np.searchsorted(voc.hashes, h), max(len(voc.hashes) - 1, 0))
                carried = voc.hashes[k] == h if len(voc.hashes) else np.zeros(len(h), dtype=bool)
                c = np.where(carried, voc.counts[k], 0) if len(voc.hashes) else np.zeros(len(h))
                own = np.where(carried, voc.own[k], -1) if len(voc.hashes) else np.full(len(h), -1)
                cls = np.where(own >= 0, own, first_ending + _endings(w))
                log_c = np.log10(c + 1.0)
                inside = np.where(own >= 0, 0.0, log_c - log_mass[cls])
                rows = []
                for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True):
                    some = carried[a:b]
                    rows.append((
                        b - a + 1, np.append(cls[a:b], 0).astype("<u2").tobytes(), int(some.sum()) + (end_count > 0),
                        float(log_c[a:b].sum()) + float(np.log10(end_count + 1)), float(inside[a:b].sum()), h[a:b][~some].view(np.int64),
                    ))
                n, seq, known, total, within, rare = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(block)), batch.column(1).slice(at, len(block)), pa.array(n, pa.int64()),
                        pa.array(seq, pa.binary()), pa.array(known, pa.int64()), pa.array(total, pa.float64()),
                        pa.array(within, pa.float64()), pa.array(rare, pa.list_(pa.int64())),
                    ],
                    names=["id", "held_out", "n_tokens", "classes", "known", "carried", "inside", "rare"],
                )

    return docs.select("id", "held_out", "text").mapInArrow(
        run, f"id {kind}, held_out boolean, n_tokens long, classes binary, known long, carried double, inside double, rare array<long>"
    )


@dataclass
class Hmm:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # classes x states


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Rows with class sequences of similar length, about GROUP_TOKENS at a time."""
    rows, seqs, size = [], [], 0

    def out() -> Iterator[tuple[list, list[np.ndarray]]]:
        order = sorted(range(len(seqs)), key=lambda i: -len(seqs[i]))
        group, n = [], 0
        for i in order:
            if group and n + len(seqs[i]) > GROUP_TOKENS:
                yield [rows[j] for j in group], [seqs[j] for j in group]
                group, n = [], 0
            group.append(i)
            n += len(seqs[i])
        if group:
            yield [rows[j] for j in group], [seqs[j] for j in group]

    for batch in batches:
        keys = batch.column(0).to_pylist()
        for key, value in zip(keys, batch.column(column), strict=True):
            rows.append(key)
            seqs.append(np.frombuffer(value.as_py(), dtype="<u2"))
            size += len(seqs[-1])
            if size >= 4 * GROUP_TOKENS:
                yield from out()
                rows, seqs, size = [], [], 0
    yield from out()


def _laid_out(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes step by step over sequences of falling length: all, where each
    step begins, and how many sequences it has."""
    n = np.array([len(s) for s in seqs])
    alive = np.searchsorted(-n, -np.arange(n[0]), side="left")
    begin = np.append(0, np.cumsum(alive))
    flat = np.empty(begin[-1], dtype=np.int64)
    for i, s in enumerate(seqs):
        flat[begin[: len(s)] + i] = s
    return flat, begin, alive


def _forward(seqs: list[np.ndarray], m: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Scaled forward recursion: alphas and scales of every place, log10
    probability of each sequence; classes and step bounds."""
    flat, begin, alive = _laid_out(seqs)
    emit = m.emit[flat]
    alpha = np.empty_like(emit)
    scale = np.empty(len(flat))
    for t in range(len(alive)):
        a, b = begin[t], begin[t + 1]
        before = m.start if t == 0 else alpha[begin[t - 1] : begin[t - 1] + alive[t]] @ m.move
        x = before * emit[a:b]
        s = x.sum(axis=1)
        alpha[a:b] = x / s[:, None]
        scale[a:b] = s
    logs = np.log10(scale)
    total = np.zeros(len(seqs))
    for t in range(len(alive)):
        total[: alive[t]] += logs[begin[t] : begin[t + 1]]
    return alpha, scale, total, flat, begin


def expected(seqs: list[np.ndarray], m: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts (start, move, emit) of sequences of falling length."""
    alpha, scale, _, flat, begin = _forward(seqs, m)
    alive = np.diff(begin)
    emit = m.emit[flat] / scale[:, None]
    beta = np.ones_like(alpha)
    move = np.zeros_like(m.move)
    for t in range(len(alive) - 2, -1, -1):
        n = alive[t + 1]
        a, b = begin[t], begin[t + 1]
        ahead = emit[b : b + n] * beta[b : b + n]
        beta[a : a + n] = ahead @ m.move.T
        move += alpha[a : a + n].T @ ahead
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    counts = np.stack([np.bincount(flat, weights=gamma[:, s], minlength=len(m.emit)) for s in range(m.emit.shape[1])], axis=1)
    return gamma[: alive[0]].sum(axis=0), move * m.move, counts


def _update(start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Hmm:
    """Parameters from expected counts, with one pseudo-count a row and one
    spread over the classes by their share."""
    start, move, emit = start + 1, move + 1, emit + share[:, None]
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0, keepdims=True))


def _belongs(seqs: list[np.ndarray], emit: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected counts of a mixture of unigrams: classes by states, and a last row
    of documents by states."""
    flat, n = np.concatenate(seqs), np.array([len(s) for s in seqs])
    full = np.minimum(1.0, FULL_WEIGHT / n)
    z = np.add.reduceat(np.log(emit)[flat], np.append(0, np.cumsum(n)[:-1]), axis=0) * full[:, None] + np.log(weight)
    r = np.exp(z - z.max(axis=1, keepdims=True))
    r /= r.sum(axis=1, keepdims=True)
    each = np.repeat(r * full[:, None], n, axis=0)
    counts = [np.bincount(flat, weights=each[:, s], minlength=len(emit)) for s in range(emit.shape[1])]
    return np.vstack([np.stack(counts, axis=1), r.sum(axis=0)[None]])


def _expected_sums(seqs: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    first, moves, counts = expected(seqs, Hmm(start, move, emit))
    return np.vstack([counts, moves, first[None]])


def _summed(training: DataFrame, counts: Callable[..., np.ndarray], shape: tuple[int, int], parameters: dict[str, np.ndarray]) -> np.ndarray:
    """``counts`` of all sequences under ``parameters``, added up by partitions, then
    by SUMS tasks, then here."""
    now = training.sparkSession.sparkContext.broadcast(parameters)  # a few numbers a class and state

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for _, seqs in _groups(batches, "classes"):
            total += counts(seqs, **now.value)
        yield pa.RecordBatch.from_pydict({"x": pa.array([total.tobytes()], pa.binary())})

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for x in batch.column(0):
                total += np.frombuffer(x.as_py()).reshape(shape)
        yield pa.RecordBatch.from_pydict({"x": pa.array([total.tobytes()], pa.binary())})

    sums = training.mapInArrow(add, "x binary").repartition(SUMS).mapInArrow(combine, "x binary").collect()  # SUMS matrices
    now.unpersist()
    return sum((np.frombuffer(r["x"]).reshape(shape) for r in sums), np.zeros(shape))


def baum_welch(table: DataFrame, vocab: Vocabulary, states: int = STATES, passes: int = PASSES, seed: int = 1) -> Hmm:
    """Train on the ``encoded`` rows that are not held out."""
    share = vocab.mass / vocab.mass.sum()
    training = table.filter("not held_out").select("row", "classes")
    rng = np.random.default_rng(seed)
    emit = share[:, None] * np.exp(rng.normal(size=(vocab.classes, states)))
    emit, weight = emit / emit.sum(axis=0), np.full(states, 1 / states)
    for _ in range(START_ROUNDS):
        total = _summed(training, _belongs, (vocab.classes + 1, states), {"emit": emit, "weight": weight})
        emit, weight = total[:-1] + share[:, None], total[-1] + 1
        emit, weight = emit / emit.sum(axis=0), weight / weight.sum()
    move = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(move, 0.95)
    m = Hmm(weight, move / move.sum(axis=1, keepdims=True), emit)
    for _ in range(passes):
        total = _summed(training, _expected_sums, (vocab.classes + states + 1, states), vars(m))
        m = _update(total[-1], total[-states - 1 : -1], total[: -states - 1], share)
    return m


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    scratch = Scratch(docs.sparkSession, "markov-lm")
    d = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    counts = scratch.write(word_counts(d.filter("not held_out")), "counts")
    vocab = vocabulary(counts)
    table = scratch.write(encoded(d, vocab).withColumn("row", F.monotonically_increasing_id()), "encoded")
    model = docs.sparkSession.sparkContext.broadcast(vars(baum_welch(table, vocab)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, seqs in _groups(batches, "classes"):
            total = _forward(seqs, Hmm(**model.value))[2]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(total)], names=["row", "log_classes"])

    chain = table.select("row", "classes").mapInArrow(run, "row long, log_classes double")
    # Tokens beyond the carried words meet their counts here.
    rare = table.select("row", F.explode("rare").alias("h")).join(counts.select("h", "c"), "h")
    rare = rare.groupBy("row").agg(F.count("*").alias("rare_known"), F.sum(F.log10(F.col("c") + 1)).alias("rare_log"))
    out = table.drop("classes", "rare").join(chain, "row").join(rare, "row", "left")
    more = F.coalesce("rare_log", F.lit(0.0))
    base = F.col("carried") + more - F.col("n_tokens") * float(np.log10(vocab.tokens + vocab.distinct + 1))
    return out.select(
        "id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("log_classes") + F.col("inside") + more).alias("score"),
    )
