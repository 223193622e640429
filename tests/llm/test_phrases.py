"""Phrases against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewater.llm import phrases as ph
from tidewater.llm.storage import Scratch

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang if lang is not None else "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        covered = set()
        for q, b in cands.items():
            for k in range(2, len(q)):
                covered |= {q[i : i + k] for i in range(len(q) - k + 1) if 100 * b >= 80 * c[q[i : i + k]]}
        scored = []
        for p, a in cands.items():
            if p not in covered:
                score, _, left, right = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], start=1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    some = ["the", "of", "The", "été", "a", "b", "c's", "#d", "e", "f g", "\x1fh"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "! ? ", "; "]
    out = []
    for i in range(n):
        body = "".join(rng.choice(some[: 4 + i % 8]) + rng.choice(gaps) for _ in range(rng.choice([0, 3, 40, 90])))
        out.append((i, body, rng.choice(["en", "fr", None, "und"])))
    return [*out, (None, None, "en"), (1, "", None), (2, "of the of the", "de"), (3, "x " * 5000, "en"), (4, "y " * 5000, "en")]


def got(spark, rows, least, top, extra=()):
    d = spark.createDataFrame(rows, SCHEMA).repartition(5)
    if extra:
        d = d.selectExpr("*", *extra)
    return sorted(tuple(r) for r in ph.collocations(d, least=least, top=top).collect())


@pytest.mark.parametrize("least, top", [(30, 2000), (3, 25)])
def test_phrases_equal_brute_force(spark, least, top):
    rows = texts(1, 400)
    want = brute(rows, least, top)
    assert len(want) > 20
    assert got(spark, rows, least, top) == want


@pytest.mark.parametrize("budget", [50, 700])
def test_prefixes_over_the_budget_are_extended(spark, monkeypatch, budget):
    monkeypatch.setattr(ph, "BUDGET", budget)
    monkeypatch.setattr(ph, "BLOCK_WORDS", 900)
    rows = texts(2, 300)
    assert got(spark, rows, 4, 100) == brute(rows, 4, 100)


def test_suffix_groups_keep_to_the_budget(spark, monkeypatch):
    """Two words alternate in most of the corpus: groups part by second and third words."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["hot", "hot", rng.choice("abcdefghij")]) for _ in range(60)), "en") for i in range(100)]
    heavy = [np.sort(np.concatenate([ph._tokens([w])[0] for w in ("hot",)]))]
    h, reach, _ = ph._tokens([r[1] for r in rows])
    columns = ph._columns(h, reach)
    one, two = ph._group_keys(columns, [])[0], ph._group_keys(columns, heavy)[0]
    most = lambda keys: np.unique(keys, return_counts=True)[1].max()
    assert most(two) < 0.75 * most(one)
    monkeypatch.setattr(ph, "BUDGET", 1000)
    assert got(spark, rows, 5, 50) == brute(rows, 5, 50)


def test_empty_table_and_clashing_columns(spark):
    assert got(spark, [], 1, 10) == []
    rows = texts(4, 60)
    clash = ["1 as key", "2 as f", "'s' as ws", "3 as n", "4 as rank", "5 as place", "6 as word", "7 as l", "8 as part"]
    assert got(spark, rows, 2, 40, clash) == brute(rows, 2, 40)


def test_counts_pass_64_bits(spark):
    """Scores by products beyond 64 bits."""
    big = 4 * 10**15
    one = spark.createDataFrame([("en", [1, 2], big)], "lang string, ws array<long>, f long")
    counts = spark.createDataFrame([("en", [1], big + 1), ("en", [2], big + 2)], "lang string, ws array<long>, f long")
    assert ph._scored(one, counts).first()["score"] == 2000000 * big // (2 * big + 3)


def test_words_table_holds_frequent_words_only(spark):
    d = spark.createDataFrame([(1, "a a a b b c", "en")], SCHEMA)
    known, _ = ph.phrase_counts(d.select("text", "lang"), Scratch(spark, "test"), 2)
    assert sorted((r["word"] or "", r["f"]) for r in known.collect()) == [("", 6), ("a", 3), ("b", 2)]
