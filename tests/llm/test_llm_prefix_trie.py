"""Operator 13 against a plain trie."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from hypercube.llm import prefix_trie

ROWS = "conv_id long, turn long, role string, text string, path string, id string"


def _rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def _trie(paths):
    members, ends = defaultdict(set), defaultdict(set)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].add(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in members:
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += own
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -10**9, len(m), children[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def _found(df):
    return sorted((r[0], r[1], -10**9 if r[2] is None else r[2], *r[3:]) for r in df.collect())


def _random(seed, convs=150, most=9, words=2):
    r = random.Random(seed)
    return [(r.choice([c, c, c, c + 200, -c]), r.choice([t, t, None]), r.choice(["user", "assistant", None]),
             r.choice(["same", "äöü", None, "", *[f"w{k}" for k in range(words)]])) for c in range(convs) for t in range(r.randint(1, most))]


@pytest.mark.parametrize("seed,shards", [(1, 1), (2, 3), (3, 16), (4, 40)])
def test_plain_trie(spark, seed, shards):
    rows = _random(seed) + [(None, 0, "user", "nobody's")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS)
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.paths(df)), shards)
    assert _found(got) == _trie(_rebuilt(rows))


@pytest.mark.parametrize("turns", [1, 2, 256])
def test_shared_chains_and_copies(spark, monkeypatch, turns):
    monkeypatch.setattr(prefix_trie, "SPLITTER_TURNS", turns)
    rows = [(c * 100, t, "user", f"turn {t}") for c in range(40) for t in range(c + 1)]
    rows += [(c * 100, t, "user", "copy") for c in range(100, 160) for t in range(3)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS)
    got = prefix_trie.prefix_trie(prefix_trie.paths(df), 12)
    own = defaultdict(list)
    for c, _, role, text in rows:
        own[c].append((role, text))
    assert _found(got) == _trie(own)


def test_turnless_and_empty(spark):
    empty = prefix_trie.paths(spark.createDataFrame([], ROWS))
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(empty)).count() == 0
    c = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(c, 0, "user", "x" * 100_000)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS)
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.paths(df)))
    assert _found(got) == [(c, 0, -10**9, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_given_table(spark, sf_small):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in prefix_trie.table(spark, sf_small, "conversations").collect()]
    assert _found(prefix_trie.op13_prefix_trie(spark, sf_small)) == _trie(_rebuilt(rows))
