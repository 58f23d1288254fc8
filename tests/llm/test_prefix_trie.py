"""The trie's nodes against a plain version of the contract."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tablewright.llm import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string, depth string, n long, key binary"


def plain_nodes(rows):
    """rows: (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            told = f"{len(role.encode())}:".encode() + role.encode() + text.encode()
            own[conv].append((turn is not None, turn or 0, hashlib.sha256(told).digest()[:16], (role, text)))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, convs in members.items():
        own_saved = (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += own_saved
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(path), parent, len(convs), children[path], leaves[path], saved[path], digest))
    return sorted(out, key=str)


def trie_of(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1, b"k") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in prefix_trie.build_trie(table).collect()), key=str)


def talk(seed, convs, alphabet, most):
    random = np.random.default_rng(seed)
    return [
        (int(c), t, "user" if t % 2 else "bot", alphabet[random.integers(len(alphabet))])
        for c in convs for t in range(random.integers(1, most + 1))
    ]


@pytest.fixture
def small_shards(monkeypatch):
    """Cuts deeper than the first turn, as large tables have them."""
    monkeypatch.setattr(prefix_trie, "MOST_TURNS", 12)
    monkeypatch.setattr(prefix_trie, "FEW_SEQUENCES", 2)


def test_nodes_of_shared_beginnings(spark):
    rows = talk(1, range(60), ["yes", "no", "é", "tell me"], 7)
    assert trie_of(spark, rows) == plain_nodes(rows)


def test_cuts_at_several_depths(spark, small_shards):
    rows = talk(2, range(150), ["a", "b"], 14) + talk(3, range(200, 230), ["c", "a" * 50], 3)
    assert trie_of(spark, rows) == plain_nodes(rows)


def test_large_group_of_copies(spark, small_shards, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    rows = [(5 * c, t, "user", f"turn {t}") for c in range(120) for t in range(4)] + talk(4, range(1000, 1030), ["x", "y"], 6)
    assert trie_of(spark, rows) == plain_nodes(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "first"), (1, 0, "user", "first"), (1, 0, "bot", "tie"), (2, 1, "", ""), (-7, 1, "u", "negative"),
        (-5, 1, "u", "negative"), (None, 1, "u", "no conversation"), (9, 0, "u", "\x00\n" * 3), (12, 3, "u", "x" * 300_000),
        *[(40, t, "u", str(t % 3)) for t in range(700)],
    ]
    assert trie_of(spark, rows) == plain_nodes(rows)


def test_only_turnless_conversations(spark):
    # 1 and 4 keep none of their own turns, and conversation 0 is absent.
    convs = [c for c in range(1, 5) if zlib.crc32(str(c).encode()) % 9 > 0]
    rows = [(c, 0, "u", "gone") for c in convs]
    [start] = trie_of(spark, rows)
    assert [start] == plain_nodes(rows) and start[:4] == (min(convs), 0, None, len(convs))


def test_empty_table(spark):
    assert trie_of(spark, []) == []


def test_given_table(spark, folder):
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    assert sorted((tuple(r) for r in prefix_trie.build_trie(table).collect()), key=str) == plain_nodes(rows)


def test_double_array_walks_only_its_sequences():
    random = np.random.default_rng(5)
    sequences = sorted({tuple(random.integers(0, 300, random.integers(1, 6))) for _ in range(3000)})
    codes = np.array([c for s in sequences for c in s])
    sizes = np.array([len(s) for s in sequences])
    starts = np.cumsum(sizes) - sizes
    array = prefix_trie.pack(codes, starts, sizes, 300)
    seen = {}
    for s in sequences:
        node = 0
        for depth, code in enumerate(s, 1):
            node = int(array.step(np.array([node]), np.array([code]))[0])
            assert seen.setdefault(node, s[:depth]) == s[:depth]
    assert len(seen) == len({s[:d] for s in sequences for d in range(1, len(s) + 1)})
    used = np.flatnonzero(array.check >= 0)
    assert len(used) == len(seen) + 1 and used.max() < 3 * len(used)
    absent = next(c for c in range(300) if (c,) not in {s[:1] for s in sequences}) if len({s[0] for s in sequences}) < 300 else None
    if absent is not None:
        with pytest.raises(ValueError):
            array.step(np.array([0]), np.array([absent]))
