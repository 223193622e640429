"""Long repeats against brute force, and the run-length index by itself."""

import hashlib
import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import repeats as rp
from tidewater.llm import rindex

SCHEMA = "doc_id long, text string"


def brute(rows, length=rp.LENGTH):
    """Rows (doc_id, text, key), in the operator's order of documents."""
    seen, out = set(), {}
    for i, text, key in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[2])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[i, text] = (i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(str(out[i, t]) for i, t, _ in rows)


def both(spark, rows, length=rp.LENGTH, extra=(), parts=4):
    d = spark.createDataFrame(rows, SCHEMA)
    keyed = [tuple(r) for r in d.select("doc_id", "text", F.xxhash64("text")).collect()]
    if extra:
        d = d.selectExpr("*", *extra)
    got = sorted(str(tuple(r)) for r in rp.remove_repeats(d.repartition(parts), length=length).collect())
    return got, brute(keyed, length)


def prose(rng, n):
    return " ".join(rng.choice("the of and reön ting éa st nd in on er").strip() + rng.choice(["", "x", "ly"]) + str(rng.randrange(50)) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    passage, other = prose(rng, 90), prose(rng, 60)
    rows = [(i, prose(rng, rng.choice([3, 20, 60, 200]))) for i in range(60)]
    rows += [(100 + i, prose(rng, 10) + passage + prose(rng, 5)) for i in range(12)]
    rows += [(200 + i, prose(rng, 30) + other[i:] + " " + passage[: 200 + i]) for i in range(6)]
    rows += [(300 + i, rows[i][1]) for i in range(20)]  # copies
    rows += [(400 + i, rows[i][1][: 40 + 11 * i] + "Z" + rows[i][1][40 + 11 * i :]) for i in range(30)]  # near copies
    rows += [(500, "ab" * 500), (501, "a" * 700), (502, passage * 3), (503, "\0" * 150 + "x" + "\0" * 120)]
    rows += [(504, None), (505, ""), (None, rows[0][1]), (None, rows[1][1]), (7, rows[2][1]), (7, rows[2][1] + " "), (7, rows[2][1])]
    return rows


@pytest.mark.parametrize("length", [100, 24])
def test_repeats_equal_brute_force(spark, length):
    got, want = both(spark, corpus(1), length)
    assert got == want


def test_small_blocks_chunks_and_slices(spark, monkeypatch):
    """Texts cut into slices, indexes of few parts, hot anchors cut into windows."""
    for name, value in (("SLICE", 512), ("BLOCK_RUNS", 40), ("CHUNK_BYTES", 3000), ("HOT", 3)):
        monkeypatch.setattr(rp, name, value)
    got, want = both(spark, corpus(2), parts=7)
    assert got == want


def test_a_passage_in_very_many_texts(spark, monkeypatch):
    """Edges of a passage: its anchors' parts pass HOT and go by window."""
    monkeypatch.setattr(rp, "HOT", 100)
    rng = random.Random(3)
    passage = prose(rng, 40)
    got, want = both(spark, [(i, prose(rng, 12) + passage + prose(rng, 12)) for i in range(300)])
    assert got == want


def test_empty_table_and_clashing_columns(spark):
    assert rp.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = ["1 as id", "2 as key", "'s' as ord", "3 as dest", "4 as body", "5 as marks", "6 as start", "7 as whole", "8 as n_bytes", "9 as hashes"]
    got, want = both(spark, corpus(4)[:90], extra=clash)
    assert got == want


def test_no_pass_over_the_order_of_rows(spark):
    rows = corpus(5)
    d = spark.createDataFrame(rows, SCHEMA)
    runs = [sorted(str(tuple(r)) for r in rp.remove_repeats(x).collect()) for x in (d.coalesce(1), d.orderBy(F.desc("text")).repartition(9))]
    assert runs[0] == runs[1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab\0", min_size=1, max_size=40), min_size=1, max_size=12), st.integers(7, 20))
def test_index_streams_every_earlier_window(parts, length):
    parts = [p.encode() for p in parts]
    index = rindex.build(parts, length)
    seen, want, at = set(), [], 0
    for p in parts:
        for s in range(len(p) - length + 1):
            if p[s : s + length] in seen:
                want.append(at + s)
            seen.add(p[s : s + length])
        at += len(p) + 1
    assert rindex.earlier(index).tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=30), min_size=1, max_size=8))
def test_runs_are_those_of_the_transform(parts):
    parts = [p.encode() for p in parts]
    index = rindex.build(parts, 7)
    suffixes = []
    at = 0
    for k, p in enumerate(parts):
        suffixes += [([c + 1 for c in p[s:]], k, at + s) for s in range(len(p) + 1)]
        at += len(p) + 1
    suffixes = sorted(suffixes, key=lambda x: (x[0], x[1]))
    text = [c for p in parts for c in [*(b + 1 for b in p), 0]]
    last = [text[s - 1] for _, _, s in suffixes]
    starts = [i for i in range(len(last)) if i == 0 or last[i] != last[i - 1]]
    assert index.start.tolist() == starts
    ends = [*(s - 1 for s in starts[1:]), len(last) - 1]
    assert index.sample.tolist() == [suffixes[e][2] for e in ends]


def test_copies_cost_few_runs():
    rng = np.random.default_rng(1)
    one = rng.integers(97, 123, 300).astype(np.uint8).tobytes()
    assert len(rindex.build([one] * 50, 100).start) < 1.3 * len(rindex.build([one], 100).start)


def test_copies_hear_of_an_anchor_once(spark, monkeypatch):
    """Not once a block: what a text of very many copies carries along stays as large as the text."""
    monkeypatch.setattr(rp, "BLOCK_RUNS", 60)
    monkeypatch.setattr(rp, "FOLD_PAIRS", 100, raising=False)
    text = prose(random.Random(6), 150)
    anchors = {int(x) for _, _, _, h in rp.window_runs([text.encode()]) for x in h}
    rows = spark.createDataFrame([(1, text)] * 120, "key long, text string").coalesce(1)
    told = {r["key"]: b"".join(r["hashes"]) for r in rp._repeated_anchors(rows, 3, 100).collect()}
    assert set(told) == {1}
    assert set(np.frombuffer(told[1], dtype=np.uint64).tolist()) == anchors
    assert len(told[1]) // 8 <= 2 * len(anchors)


def test_an_index_takes_little_memory():
    rng = np.random.default_rng(2)
    parts = [rng.integers(97, 123, 140).astype(np.uint8).tobytes() for _ in range(3000)]
    tracemalloc.start()
    try:
        rindex.build(parts, 100)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 100 * 141 * len(parts)


def test_a_window_at_very_many_places_is_folded(spark, monkeypatch):
    """One window's places pass what a task holds: folded as they are read, batch by batch."""
    for name, value in (("CHUNK_BYTES", 2000), ("HOT", 3)):
        monkeypatch.setattr(rp, name, value)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(7)
        passage = prose(rng, 30)
        got, want = both(spark, [(i, prose(rng, 3) + passage + prose(rng, 3)) for i in range(90)])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == want
