"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of the rows that its first four bytes, its first
six and the whole word hash to. Filters of several widths slide over the words,
each keeps its maximum over the whole text, and a logistic layer gives the score.
Training starts from embeddings whose first dimension holds each bucket's log
odds in all training rows, then runs Adagrad on all parameters; only the words at
maxima carry gradients.

It learns from all labelled documents that are not held out, whole texts. A quarter
of them, by a hash of the id, is kept for thresholds; the others are dealt by
another into lots of bounded size. In each round every lot is gone over by a task
of its own, from the same model, and the changes are averaged: of an embedding's
row over the lots that changed it, of all else over all lots. What tasks send and
get is bounded by the model's size. Thresholds by language are the score that gives
the best F1 among all rows kept for them, counted by Spark. Language, source, label
and id are no inputs of a score.

Defined results. Null or empty texts have a score like any other: that of a text
whose filters see padding alone. Null labels are no labels; of several labels of
a document the greatest counts. Null ids are scored, and are never held out.
Where the rows trained on lack a class, every score is the share of toxic labels (0
without labels). A language without a threshold takes that of all languages.
Repeated rows are scored one by one. Empty table: no rows. Extra columns are
ignored. Whole texts, however long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.wordhash import Words, blocks, words
from tidewater.operators.cut import cut

#: Documents and bytes of text in a lot, on average.
LOT_ROWS = 1000
LOT_BYTES = 1 << 23
#: Tasks that add up what the lots' tasks have gathered.
SUMS = 8
#: Pieces that a language's scores are counted in.
PIECES = 64
BUCKETS = 1 << 17
EMBEDDING = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 6
#: A small lot is gone over more often, until so many batches were seen.
LEAST_STEPS = 150
BATCH = 32
RATE = 0.05
#: Documents kept for thresholds: those whose hash is 0 modulo this.
CALIBRATE = 4
THRESHOLD = 0.3
_PARTS = (4, 6, None)


def _buckets(w: Words) -> np.ndarray:
    """Rows of the embedding table for each word, one column a part."""
    return np.stack([(w.hashes(n) + np.uint64(k * 0x9E37) >> np.uint64(17)) % np.uint64(BUCKETS) for k, n in enumerate(_PARTS)], axis=1).astype(np.int64)


@dataclass
class Model:
    table: np.ndarray
    filters: list[np.ndarray]  # of width w: (w, EMBEDDING, FILTERS)
    bias: list[np.ndarray]
    out: np.ndarray
    intercept: float
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    overall: float = THRESHOLD


def _padded(buckets: np.ndarray, counts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings with a window's width of padding after each text; starts and ends
    of the places where windows begin (one, of padding, in an empty text)."""
    pad = max(WIDTHS)
    starts = np.cumsum(np.append(0, counts + pad))[:-1]
    x = np.zeros((int(counts.sum()) + pad * len(counts) + pad + 1, table.shape[1]), dtype=np.float32)
    x[np.arange(len(buckets)) + pad * np.repeat(np.arange(len(counts)), counts)] = sum(table[buckets[:, k]] for k in range(buckets.shape[1]))
    return x, starts, starts + np.maximum(counts, 1)


def _conv(x: np.ndarray, model: Model) -> Iterator[np.ndarray]:
    n = len(x) - max(WIDTHS) + 1
    for f, b in zip(model.filters, model.bias, strict=True):
        yield sum(x[k : k + n] @ f[k] for k in range(len(f))) + b


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def logits(texts: list[str | None], model: Model) -> np.ndarray:
    w = words(texts)
    x, a, b = _padded(_buckets(w), np.diff(w.bounds), model.table)
    edges = np.stack([a, b], axis=1).ravel()
    pooled = np.hstack([np.maximum.reduceat(c, edges, axis=0)[::2] for c in _conv(x, model)])
    return np.maximum(pooled, 0) @ model.out + model.intercept


def score(texts: list[str | None], model: Model) -> np.ndarray:
    """Scores of all texts, a block of them at a time."""
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    parts = [logits(block, model) for _, block in blocks(texts)]
    return _sigmoid(np.concatenate(parts).astype(np.float64)) if parts else np.zeros(0)


def _present(texts: list[str], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each class that have a bucket, and all of each class."""
    present = np.zeros((BUCKETS, 2))
    for at, block in blocks(texts):
        w = words(block)
        rows = _buckets(w)
        for i, (a, b) in enumerate(zip(w.bounds[:-1], w.bounds[1:], strict=True)):
            present[np.unique(rows[a:b]), int(y[at + i])] += 1
    return present, np.array([(y == 0).sum(), (y == 1).sum()], dtype=np.float64)


def _init(present: np.ndarray, total: np.ndarray, seed: int) -> Model:
    rng = np.random.default_rng(seed)
    odds = np.log((present[:, 1] + 2) / (total[1] + 4)) - np.log((present[:, 0] + 2) / (total[0] + 4))
    table = rng.normal(0, 0.05, (BUCKETS, EMBEDDING)).astype(np.float32)
    table[:, 0] = 0.3 * odds
    filters = [rng.normal(0, 0.15, (n, EMBEDDING, FILTERS)).astype(np.float32) for n in WIDTHS]
    for f in filters:
        f[:, 0, :2] = 1.0 / len(f)
    out = np.full(FILTERS * len(WIDTHS), 0.3, dtype=np.float32)
    return Model(table, filters, [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS], out, -1.0)


@dataclass
class Squares:
    """Adagrad's sums of squares."""

    table: np.ndarray
    squares: list[np.ndarray]
    intercept: float = 1e-2


def _squares(model: Model) -> Squares:
    return Squares(np.full(model.table.shape, 1e-2, dtype=np.float32), [np.full(p.shape, 1e-2, dtype=np.float32) for p in [*model.filters, *model.bias, model.out]])


def _go_over(model: Model, state: Squares, texts: list[str], y: np.ndarray, rng: np.random.Generator) -> None:
    """Change ``model`` and ``state`` by one pass over the texts, in batches."""
    for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH)):
        w = words([texts[i] for i in part])
        rows, counts = _buckets(w), np.diff(w.bounds)
        x, a, b = _padded(rows, counts, model.table)
        # Word at each padded place, or -1.
        word_at = np.full(len(x), -1)
        word_at[np.arange(len(rows)) + max(WIDTHS) * np.repeat(np.arange(len(counts)), counts)] = np.arange(len(rows))
        pooled, best = [], []
        for c in _conv(x, model):
            at = np.array([s + c[s:e].argmax(axis=0) for s, e in zip(a, b, strict=True)])
            best.append(at)
            pooled.append(np.take_along_axis(c, at, axis=0))
        h = np.maximum(np.hstack(pooled), 0)
        error = (_sigmoid(h @ model.out + model.intercept) - y[part]) / len(part)
        grads: list[np.ndarray] = []
        back = error[:, None] * model.out * (h > 0)
        x_grad: list[tuple[np.ndarray, np.ndarray]] = []
        bias_grads = []
        for k, (f, at) in enumerate(zip(model.filters, best, strict=True)):
            g = back[:, k * FILTERS : (k + 1) * FILTERS]
            grads.append(np.stack([np.einsum("df,dfe->ef", g, x[at + j]) for j in range(len(f))]))
            bias_grads.append(g.sum(axis=0))
            for j in range(len(f)):
                x_grad.append(((at + j).ravel(), (g[:, :, None] * f[j].T[None]).reshape(-1, EMBEDDING)))
        grads += [*bias_grads, h.T @ error]
        for p, q, g in zip([*model.filters, *model.bias, model.out], state.squares, grads, strict=True):
            q += g * g
            p -= RATE * g / np.sqrt(q)
        state.intercept += float(error.sum()) ** 2
        model.intercept -= RATE * float(error.sum()) / np.sqrt(state.intercept)
        place, grad = (np.concatenate(v) for v in zip(*x_grad, strict=True))
        ok = word_at[place] >= 0
        hit = rows[word_at[place[ok]]].ravel()
        unique, inverse = np.unique(hit, return_inverse=True)
        total = np.zeros((len(unique), EMBEDDING), dtype=np.float32)
        np.add.at(total, inverse, np.repeat(grad[ok], len(_PARTS), axis=0))
        state.table[unique] += total * total
        model.table[unique] -= RATE * total / np.sqrt(state.table[unique])


def _passes(n: int) -> int:
    return max(EPOCHS, -(-LEAST_STEPS // max(1, n // BATCH)))


def train(texts: list[str], y: np.ndarray, seed: int = 1) -> Model:
    """Fit on texts of one lot with labels of both classes."""
    model = _init(*_present(texts, y), seed)
    state, rng = _squares(model), np.random.default_rng(seed)
    for _ in range(_passes(len(texts))):
        _go_over(model, state, texts, y, rng)
    return model


def _dense(model: Model, state: Squares) -> np.ndarray:
    """All parameters and sums of squares but those of embeddings."""
    parts = [*model.filters, *model.bias, model.out, *state.squares]
    return np.concatenate([*(p.ravel() for p in parts), [model.intercept, state.intercept]]).astype(np.float64)


def _put_dense(values: np.ndarray, model: Model, state: Squares) -> None:
    at = 0
    for p in [*model.filters, *model.bias, model.out, *state.squares]:
        p[...] = values[at : at + p.size].reshape(p.shape)
        at += p.size
    model.intercept, state.intercept = float(values[at]), float(values[at + 1])


def _copy(model: Model, state: Squares) -> tuple[Model, Squares]:
    own = Model(model.table.copy(), [f.copy() for f in model.filters], [b.copy() for b in model.bias], model.out.copy(), model.intercept)
    return own, Squares(state.table.copy(), [q.copy() for q in state.squares], state.intercept)


def _changes(model: Model, state: Squares, texts: list[str], y: np.ndarray, passes: int, seed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """What a lot changes: by embedding row whether it did, its change and that of
    its squares; then one, and the change of all else."""
    own, squares = _copy(model, state)
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        _go_over(own, squares, texts, y, rng)
    moved, grown = own.table - model.table, squares.table - state.table
    changed = (grown != 0).any(axis=1) | (moved != 0).any(axis=1)
    return np.hstack([changed[:, None], moved, grown]).astype(np.float32), np.append(1.0, _dense(own, squares) - _dense(model, state))


def _summed(lots: DataFrame, of: Callable[..., tuple[np.ndarray, np.ndarray]], **shared: object) -> tuple[np.ndarray, np.ndarray]:
    """Both arrays of ``of`` (a row a bucket; the rest) summed over all lots: by
    partitions, then by SUMS tasks, then here. Rows of zeros are not sent."""
    given = lots.sparkSession.sparkContext.broadcast(shared)  # at most the model and its squares

    def packed(by_row: np.ndarray, rest: np.ndarray) -> pa.RecordBatch:
        rows = np.flatnonzero(by_row.any(axis=1)).astype(np.int32)
        values = [rows.tobytes(), by_row[rows].astype(np.float32).tobytes(), rest.tobytes()]
        return pa.RecordBatch.from_pydict({c: pa.array([v], pa.binary()) for c, v in zip(("rows", "by_row", "rest"), values, strict=True)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for lot, docs in zip(batch.column(0), batch.column(1), strict=True):
                d = docs.as_py()
                got = of([x["text"] for x in d], np.array([x["y"] for x in d], dtype=np.float32), lot.as_py(), **given.value)
                total = got if total is None else tuple(a + b for a, b in zip(total, got, strict=True))
        if total is not None:
            yield packed(*total)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = unpacked((r for batch in batches for r in batch.to_pylist()))
        if total is not None:
            yield packed(*total)

    def unpacked(parts: Iterator) -> tuple[np.ndarray, np.ndarray] | None:
        total = None
        for r in parts:
            rows = np.frombuffer(r["rows"], dtype=np.int32)
            values, rest = np.frombuffer(r["by_row"], dtype=np.float32), np.frombuffer(r["rest"])
            if len(rows):
                values = values.reshape(len(rows), -1)
                if total is None or total[0] is None:
                    total = np.zeros((BUCKETS, values.shape[1])), 0.0 if total is None else total[1]
                total[0][rows] += values
            total = (None, rest) if total is None else (total[0], total[1] + rest)
        return None if total is None else (np.zeros((BUCKETS, 1)) if total[0] is None else total[0], total[1])

    kind = "rows binary, by_row binary, rest binary"
    out = unpacked(iter(lots.mapInArrow(add, kind).repartition(SUMS).mapInArrow(combine, kind).collect()))  # SUMS models at most
    given.unpersist()
    return out


def train_lots(lots: DataFrame, passes: int, seed: int = 1) -> Model:
    """Fit on ``lots`` (lot, docs: an array of text and y) with labels of both classes."""
    present, total = _summed(lots, lambda texts, y, lot: _present(texts, y))
    model = _init(present if present.shape[1] == 2 else np.zeros((BUCKETS, 2)), total, seed)
    state = _squares(model)
    each = -(-passes // EPOCHS)
    for k in range(EPOCHS):
        by_row, rest = _summed(lots, lambda texts, y, lot, m, q, k: _changes(Model(**m), Squares(**q), texts, y, each, [seed, k, lot]), m=vars(model), q=vars(state), k=k)
        if by_row.shape[1] > 1:
            mean = by_row[:, 1:] / np.maximum(by_row[:, :1], 1)
            model.table += mean[:, :EMBEDDING].astype(np.float32)
            state.table += mean[:, EMBEDDING:].astype(np.float32)
        _put_dense(_dense(model, state) + rest[1:] / rest[0], model, state)
    return model


def best_thresholds(scored: DataFrame) -> DataFrame:
    """Of ``scored`` (lang, y, score), by language and (lang null) over all rows: the
    score that gives the best F1 as a threshold, the middle between the least such
    score and the next below. Languages without both labels have none. Scores are
    counted piecewise, so a language with most rows is many tasks."""
    rows = scored.select("y", "score", F.explode(F.array(F.concat(F.lit("of "), F.coalesce("lang", F.lit(""))), F.lit("all"))).alias("of"))
    counts = cut(rows.groupBy("of", "score").agg(F.count("*").alias("n"), F.sum("y").alias("hits")), "toxicity-counts")
    edges = counts.groupBy("of").agg(
        F.percentile_approx("score", [i / PIECES for i in range(1, PIECES)], 10000).alias("edges"), F.sum("hits").alias("positive"), F.sum("n").alias("rows")
    )
    pieces = counts.join(F.broadcast(edges), "of").withColumn("piece", F.size(F.filter("edges", lambda e: e > F.col("score"))))
    sums = pieces.groupBy("of", "piece").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    before = Window.partitionBy("of").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("of", "piece", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "hits")])
    within = Window.partitionBy("of", "piece").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = [(F.sum(c).over(within) + F.col(f"{c}_before")).alias(f"upto_{c}") for c in ("n", "hits")]
    f1 = pieces.join(carried, ["of", "piece"]).select("of", "score", "positive", "rows", *upto)
    f1 = f1.withColumn("f1", 2 * F.col("upto_hits") / (F.col("upto_n") + F.col("positive")))
    best = f1.filter("positive > 0 and (positive < rows or of = 'all')").groupBy("of").agg(F.max(F.struct("f1", (-F.col("score")).alias("low")))["low"].alias("low"))
    best = best.select("of", (-F.col("low")).alias("low"))
    after = counts.join(best, "of").filter("score < low").groupBy("of").agg(F.max("score").alias("after"))
    out = best.join(after, "of", "left").select("of", ((F.col("low") + F.coalesce("after", "low")) / 2).alias("threshold"))
    return out.filter("of <> 'of '").select(F.when(F.col("of") != "all", F.substring("of", 4, 1 << 30)).alias("lang"), "threshold")


def held_out(id_col: Column, modulus: int = 4, remainder: int = 2) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % modulus == remainder


def fit(docs: DataFrame, labels: DataFrame, seed: int = 1) -> Model:
    """Train on ``docs`` (doc_id, text, lang) and ``labels`` (doc_id, toxic),
    without held-out ids."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))
    known = known.filter(~held_out(F.col("doc_id")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang").join(known, "doc_id").dropDuplicates(["doc_id"])
    rows = cut(rows.withColumn("kept", F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATE)) == 0), "toxicity-rows")
    counts = {(r["kept"], r["y"]): r for r in rows.groupBy("kept", "y").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()}
    fitted = [counts.get((False, y)) for y in (0, 1)]
    if None in fitted:
        labelled = {y: sum(r["n"] for (_, of), r in counts.items() if of == y) for y in (0, 1)}
        empty = np.zeros((1, EMBEDDING), dtype=np.float32)
        return Model(empty, [], [], np.zeros(0), 0.0, constant=labelled[1] / max(1, sum(labelled.values())))
    n = sum(r["n"] for r in fitted)
    parts = max(1, -(-n // LOT_ROWS), -(-sum(r["bytes"] for r in fitted) // LOT_BYTES))
    lot = F.pmod(F.xxhash64("doc_id", F.lit("lot")), F.lit(parts)).cast("int")
    lots = rows.filter("not kept").groupBy(lot.alias("lot")).agg(F.array_sort(F.collect_list(F.struct("doc_id", "text", "y"))).alias("docs"))
    model = train_lots(cut(lots, "toxicity-lots"), _passes(n // parts), seed)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = score(batch.column(2).to_pylist(), Model(**shared.value))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.float64())], names=["lang", "y", "score"])

    scored = rows.filter("kept").select("lang", "y", "text").mapInArrow(run, "lang string, y int, score double")
    for r in best_thresholds(scored).collect():  # a row a language
        if r["lang"] is None:
            model.overall = r["threshold"]
        else:
            model.thresholds[r["lang"]] = r["threshold"]
    return model


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: id, lang, score; threshold of its language; flagged by it."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values; a few MB, fixed by BUCKETS and EMBEDDING

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(**shared.value)
        for batch in batches:
            values = score(batch.column(2).to_pylist(), fitted)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.float64())], names=["id", "lang", "score"])

    d = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    out = d.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, lang string, score double")
    threshold = F.lit(model.overall)
    for name, value in sorted(model.thresholds.items()):
        threshold = F.when(F.col("lang") == name, F.lit(value)).otherwise(threshold)
    return out.withColumn("threshold", threshold).withColumn("flagged", F.col("score") >= F.col("threshold"))
