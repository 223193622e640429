"""Prefix trie against brute force, and the radix tree by itself."""

import hashlib
import random
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import prefix_trie as pt
from tidewater.llm.art import LAYOUTS, Tree

SCHEMA = "conv_id long, turn long, role string, text string"


def turn_id(role, text):
    return hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()[: 2 * pt.WIDTH]


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append(((turn is not None, turn or 0), turn_id(role, text), role, text))
    convs = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(convs.get(first, [])[:h] + own[h:])
    members, kids = defaultdict(set), defaultdict(set)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[s[:d]].add(c)
            if d:
                kids[s[: d - 1]].add(s[:d])
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in kids[p])
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def got(spark, rows, extra=()):
    d = spark.createDataFrame(rows, SCHEMA)
    if extra:
        d = d.selectExpr("*", *extra)
    return sorted(str(tuple(r)) for r in pt.prefix_trie(pt.rebuild(pt.sequences(d))).collect())


def shared_rows(seed, n):
    """Conversations over few turns, some with holes, nulls, ties and repeats."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        c = c * 3 if c % 5 else c * 100
        for turn in range(rng.choice([1, 2, 3, 6, 9])):
            rows.append((c, rng.choice([None, turn, turn]), rng.choice(["user", "assistant", None, ""]), rng.choice(["", None, "a", "bé", "c" * 50])))
    return rows + rows[:3] + [(None, 0, "user", "x"), (-7, 0, "user", "a"), (-100, 0, "user", "b")]


def test_trie_equals_brute_force(spark):
    rows = shared_rows(1, 300)
    assert got(spark, rows) == brute(rows)


def test_chunks_meet_at_their_borders(spark, monkeypatch):
    """Trees of a few keys each: almost every node lies in several chunks."""
    monkeypatch.setattr(pt, "CHUNK_BYTES", 200)
    monkeypatch.setattr(pt, "ID_BLOCK", 4)
    rows = shared_rows(2, 200) + [(1000 + i, t, "user", f"same {t}") for i in range(120) for t in range(4)]
    assert got(spark, rows) == brute(rows)


def test_empty_table_long_texts_and_clashing_columns(spark):
    assert got(spark, []) == []
    rows = [(1, 0, "user", "x" * 300_000), (2, 0, "user", "x" * 300_000), (100, 0, "a", "y")]
    clash = ["1 as node", "2 as key", "3 as n", "'s' as low", "4 as u", "5 as len", "6 as base", "7 as head", "8 as h", "9 as turns", "10 as depth"]
    assert got(spark, rows, clash) == brute(rows)


def test_conversation_without_turns_is_a_member_of_the_root(spark):
    rows = [(c, 0, "user", "t") for c in range(101, 130)]  # no conversation 100
    assert got(spark, rows) == brute(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=80))
def test_tree_walks_keys_in_order(keys):
    tree, want = Tree(), {}
    for i, k in enumerate(keys):
        tree.insert(k, i)
        want[k] = i
    trail, seen = bytearray(), []
    for begin, label, node in tree.walk():
        del trail[begin:]
        trail += label
        if node.value is not None:
            seen.append((bytes(trail), node.value))
    assert seen == sorted(want.items())


def test_layouts_grow_and_prefixes_stay_compressed():
    tree = Tree()
    for n, layout in ((4, 4), (5, 16), (17, 48), (49, 256), (256, 256)):
        for b in range(n):
            tree.insert(b"shared" + bytes([b]) + b"tail", b)
        root, top, *leaves = tree.walk()
        assert top[1] == b"shared" and top[2].layout == layout and layout in LAYOUTS
        assert len(leaves) == n  # one node a chain
        assert [label for _, label, _ in leaves] == [bytes([b]) + b"tail" for b in range(n)]
