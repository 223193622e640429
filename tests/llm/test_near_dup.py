"""MinHash near-dedup and the grid join against brute force."""

import importlib
import random
import re

import numpy as np
import pytest

from tidewater.llm import grid_join, near_dup
from tidewater.llm.components import components
from tidewater.llm.storage import Scratch


def _set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def _closure(ids, linked):
    comp = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(comp[a], comp[b])
            if comp[a] != low or comp[b] != low:
                comp[a] = comp[b] = low
                changed = True
    return comp


def _brute(rows):
    sets = [(i, _set(t)) for i, t, _ in rows if i is not None and _set(t)]
    linked = [
        (a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if 100 * len(x & y) >= 85 * len(x | y)
    ]
    return _closure({i for i, _, _ in rows if i is not None}, linked)


def _prose(rng, n, words=400):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def _corpus(seed=5):
    rng = random.Random(seed)
    rows, i = [], 0
    for g in range(12):
        base = _prose(rng, rng.choice([6, 7, 30, 120, 400]))
        for _ in range(rng.choice([1, 2, 9, 40])):
            w = list(base)
            for _ in range(rng.randrange(0, max(1, len(w) // 40) + 1)):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(50)}"
            rows.append((i, " ".join(w).title() if rng.random() < 0.3 else "\n".join(w), f"s{g}"))
            i += 1
    common = " ".join(_prose(rng, 60))
    rows += [(i + k, common + " " + " ".join(_prose(rng, 20 + k % 30)), "shared") for k in range(80)]
    return rows


def test_near_duplicates_match_brute_force(docs):
    rows = _corpus()
    got = {r["id"]: r for r in near_dup.near_duplicates(docs(rows, clash=True)).collect()}
    want = _brute(rows)
    assert {i: r["component_id"] for i, r in got.items()} == want
    for i, text, _ in rows:
        assert got[i]["n_shingles"] == len(_set(text)) and got[i]["kept"] == (want[i] == i)


def test_members_that_miss_the_centre_are_still_linked(docs):
    """A chain: ends of it are too far apart for one star to hold the group."""
    rng = random.Random(2)
    w = _prose(rng, 300)
    rows = []
    for i in range(12):
        for _ in range(3):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10_000)}"
        rows.append((i, " ".join(w), "a"))
    got = {r["id"]: r["component_id"] for r in near_dup.near_duplicates(docs(rows)).collect()}
    assert got == _brute(rows) and set(got.values()) == {0}


def test_near_duplicate_edges(docs):
    five = "a b c d e"
    rows = [(9, None, "a"), (8, "", "a"), (7, " \t\n", "a"), (6, five, "a"), (5, "A B C D E", "b"), (None, five, None), (None, five, None), (4, "a b", "c")]
    rows += [(3, "a\nB", "c"), (2, "b a", "c"), (1, "x " * 20_000, "d"), (1, "x " * 20_000, "d"), (0, "X " * 9, "d")]
    out = near_dup.near_duplicates(docs(rows, clash=True)).collect()
    assert len(out) == len(rows)
    got = {r["id"]: r for r in out if r["id"] is not None}
    assert {i: r["component_id"] for i, r in got.items()} == {9: 9, 8: 8, 7: 7, 6: 5, 5: 5, 4: 3, 3: 3, 2: 2, 1: 0, 0: 0}
    assert all(r["kept"] and r["component_id"] is None for r in out if r["id"] is None)
    assert [got[i]["n_shingles"] for i in (9, 8, 7, 6, 4, 1)] == [0, 0, 0, 1, 1, 1]
    kept = near_dup.keep_one(docs(rows, clash=True))
    assert kept.columns == docs(rows, clash=True).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["9", "8", "7", "5", "3", "2", "0"])
    assert near_dup.near_duplicates(docs([])).count() == 0 and near_dup.keep_one(docs([])).count() == 0


def test_rows_of_one_id_are_one_document(docs):
    rows = [(1, "a b c d e f", "x"), (1, "p q r s t u", "x"), (2, "p q r s t u", "x"), (3, "a b c d e f", "x")]
    got = near_dup.near_duplicates(docs(rows)).collect()
    assert {r["component_id"] for r in got} == {1}


def test_different_texts_of_one_id_both_stay(docs):
    """Rows go for a link of their texts only; a map column does no harm."""
    rows = [(1, "a b c d e f", "x"), (1, "p q r s t u", "x"), (2, "p q r s t u", "x"), (3, "a b c d e f", "x"), (3, "a b c d e f", "y"), (None, "p q r s t u", "z")]
    rows += [(None, "", "x"), (None, "", "x"), (None, "n u l l i d", "x"), (-5, "k l m n o", "x"), (4, "k l m n o", "x")]
    d = docs(rows, clash=True).selectExpr("*", "map('k', source) AS m")
    kept = near_dup.keep_one(d)
    assert kept.columns == d.columns
    want = [(-5, "k l m n o"), (1, "a b c d e f"), (1, "p q r s t u"), (None, ""), (None, ""), (None, "n u l l i d")]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, want))


def _near_copies(n, seed=4):
    """Copies of one text of 60 words with three edits each, from a few alternatives."""
    rng = random.Random(seed)
    base, rows = _prose(rng, 60, 2000), []
    for i in range(n):
        w = list(base)
        for at in rng.sample(range(60), 3):
            w[at] = f"edit{at % 20}-{rng.randrange(3)}"
        rows.append((i, " ".join(w), "a"))
    return rows


def test_candidate_pairs_grow_with_the_members(docs, monkeypatch):
    made = {}
    write = Scratch.write

    def counted(self, df, name):
        out = write(self, df, name)
        if name in ("pairs", "promising"):
            made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(Scratch, "write", counted)
    totals = []
    for n in (300, 600):
        rows = _near_copies(n)
        made.clear()
        got = {r["id"]: r["component_id"] for r in near_dup.near_duplicates(docs(rows)).collect()}
        assert got == _brute(rows)
        totals.append(dict(made))
        assert made["pairs"] + made["promising"] <= near_dup.BANDS * n
    assert totals[1]["promising"] <= 2.2 * totals[0]["promising"] + 20, totals


def test_tiles_of_a_large_bucket_and_false_promises(docs, monkeypatch):
    """Small tiles, and bitmaps of eight words that promise far too much."""
    monkeypatch.setattr(near_dup, "TILE", 8)
    monkeypatch.setattr(near_dup, "BITS", 512)
    rng = random.Random(6)
    base, rows = _prose(rng, 300, 3000), []
    for i in range(90):
        w = list(base)
        for _ in range(rng.choice([1, 3, 5, 7])):
            at = rng.randrange(300)
            w[at] = f"edit{at // 10}"
        rows.append((i, " ".join(w), "a"))
    got = {r["id"]: r["component_id"] for r in near_dup.near_duplicates(docs(rows)).collect()}
    assert got == _brute(rows) and len(set(got.values())) > 3


def test_large_buckets_lose_no_link(docs):
    """Copies of one text with up to a quarter of it edited, second copies of edited
    ones, and an id that holds two texts: bounds must not part what belongs together."""
    rng = random.Random(9)
    base = _prose(rng, 200, 2000)
    rows = []
    for i in range(120):
        w = list(base if i < 90 else rows[rng.randrange(90)][1].split())
        for _ in range(rng.choice([0, 1, 2, 4, 8, 12]) if i < 90 else 1):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(100_000)}"
        rows.append((i, " ".join(w), "a"))
    rows.append((200, rows[5][1] + " tail", "a"))
    rows.append((200, " ".join(_prose(rng, 300)), "a"))
    got = {r["id"]: r["component_id"] for r in near_dup.near_duplicates(docs(rows)).collect()}
    assert got == _brute(rows) and len(set(got.values())) > 3


def test_pipeline_stage_drops_near_copies_from_80_percent(spark, docs):
    """The stage against brute force of its own threshold, with pairs on both sides of 0.80 and of 0.85."""
    rng = random.Random(80)
    rows, shares = [], []
    for i in range(0, 160, 2):
        w = _prose(rng, 200, 5000)
        edited = list(w)
        for k in range(2 + i % 10 // 2):
            edited[20 + 25 * k] = f"edit{rng.randrange(100_000)}"
        rows += [(i, " ".join(w), "a"), (i + 1, " ".join(edited), "a")]
        x, y = _set(rows[-2][1]), _set(rows[-1][1])
        shares.append(len(x & y) / len(x | y))
    assert any(0.80 <= s < 0.85 for s in shares) and any(s < 0.80 for s in shares) and any(s >= 0.85 for s in shares)
    sets = [_set(t) for _, t, _ in rows]
    near = [(a, b) for a, x in enumerate(sets) for b, y in enumerate(sets[:a]) if 100 * len(x & y) >= 80 * len(x | y)]
    component = _closure(range(len(rows)), near)
    got = importlib.import_module("corpus_pipeline").near_dedup(spark, docs(rows), "")
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(i for i, c in component.items() if i == c)


def test_a_sketch_agrees_as_often_as_the_sets_overlap():
    rng = np.random.default_rng(1)
    for n, share in ((40, 0.9), (400, 0.85), (400, 0.5)):
        same = []
        for _ in range(60):
            both = rng.integers(0, 2**64, n, dtype=np.uint64)
            k = int(n * (1 - share) / (1 + share))
            a, b = (np.unique(np.append(both[k:], rng.integers(0, 2**64, k, dtype=np.uint64))) for _ in range(2))
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            same.append((near_dup.sketch(a) == near_dup.sketch(b)).mean() - j)
        assert abs(np.mean(same)) < 0.03


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (201, 200), (200, 201)]
    rng = random.Random(1)
    rng.shuffle(edges)
    e = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["component"] for r in components(e, Scratch(spark, "test")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}
    assert components(e.limit(0), Scratch(spark, "test")).count() == 0


EMB = "vec_id long, embedding array<float>, label int"


def _vectors(seed=3, dim=16):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for label in (0, 1, 2):
        for _ in range(12):
            centre = rng.normal(size=dim)
            for _ in range(int(rng.choice([1, 2, 25]))):
                v = (centre + rng.normal(size=dim) * rng.choice([0, 0.05, 0.12])) * rng.choice([0.1, 1, 50])
                rows.append((i, [float(x) for x in v.astype(np.float32)], label))
                i += 1
    return rows


def _brute_vectors(rows):
    good = [k for k, (i, v, label) in enumerate(rows) if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {k: np.array(rows[k][1]) / np.linalg.norm(rows[k][1]) for k in good}
    links, linked = [0] * len(rows), []
    for a in good:
        for b in good:
            if a != b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]) and unit[a] @ unit[b] >= 0.98:
                links[a] += 1
                linked.append((rows[a][0], rows[b][0]))
    return links, _closure({r[0] for r in rows if r[0] is not None}, linked)


@pytest.mark.parametrize("block", [7, 256])
def test_grid_join_matches_brute_force(spark, block):
    rows = _vectors()
    d = spark.createDataFrame(rows, EMB).selectExpr("*", "1 AS id", "2 AS v", "'x' AS cells", "3 AS kept", "4 AS dim")
    got = {r["id"]: r for r in grid_join.near_vectors(d, block=block).collect()}
    links, comp = _brute_vectors(rows)
    assert sum(links) > 500
    assert [got[r[0]]["n_links"] for r in rows] == links
    assert {i: r["component_id"] for i, r in got.items()} == comp


def test_grid_join_edges(spark):
    one = [1.0, 0.0, 0.0, 0.0]
    bad = [(10, None, 1), (11, [], 1), (12, [0.0] * 4, 1), (13, [None, 1.0, 0.0, 0.0], 1), (14, [float("nan"), 1.0, 0.0, 0.0], 1), (15, [float("inf"), 1.0, 0.0, 0.0], 1)]
    rows = [*bad, (20, one, None), (None, one, 1), (3, one, 1), (2, one, 1), (2, one, 1), (4, [5.0, 0.0, 0.0, 0.0], 1), (5, [-1.0, 0.0, 0.0, 0.0], 1), (6, [1.0, 0.0], 1), (7, one, 2)]
    rows += [(8, [3.0e38, 0.0, 0.0, 0.0], 1), (9, [1.0e-38, 0.0, 0.0, 0.0], 1), (9, [0.0, 1.0, 0.0, 0.0], 1)]
    out = grid_join.near_vectors(spark.createDataFrame(rows, EMB)).collect()
    links, comp = _brute_vectors(rows)
    assert sorted((str(r["id"]), r["n_links"]) for r in out) == sorted((str(r[0]), n) for r, n in zip(rows, links, strict=True))
    assert {r["id"]: r["component_id"] for r in out if r["id"] is not None} == comp
    assert all(r["kept"] for r in out if r["id"] is None)
    assert grid_join.near_vectors(spark.createDataFrame([], EMB)).count() == 0
    assert grid_join.near_vectors(spark.createDataFrame(bad, EMB)).count() == len(bad)


def test_distant_blocks_are_skipped(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(40):
        centre = np.zeros(16)
        centre[k % 16] = 1 if k < 16 else -1
        rows += [(100 * k + j, [float(x) for x in centre + rng.normal(size=16) * 0.01], 0) for j in range(30)]
    d = spark.createDataFrame(rows, EMB).selectExpr("vec_id AS id", "label", "cast(embedding AS array<double>) AS v", "16 AS dim", "1L AS copies", "vec_id AS cid")
    axes = grid_join.principal_axes(d, grid_join.DIMS)
    ordered = grid_join._projected(d, axes, 0.2, grid_join.DIMS).repartitionByRange(8, "label", "dim", "cells", "id").sortWithinPartitions("label", "dim", "cells", "id")
    blocks = Scratch(spark, "test").write(grid_join._blocks(ordered, 10, grid_join.DIMS), "blocks")
    n = blocks.count()
    assert grid_join._block_pairs(blocks, 0.2, grid_join.DIMS).count() < 0.4 * n * (n + 1) / 2
