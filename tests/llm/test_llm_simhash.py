"""Operator 9 against a plain version over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from hypercube.llm import simhash
from hypercube.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, root long, __kept long"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, 1, 2, 3) for i, t in rows], DOCS)


def _fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[k: k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(rows):
    prints = [_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                if bin(prints[a] ^ prints[b]).count("1") <= 2 and group[a] != group[b]:
                    low, high = sorted((group[a], group[b]))
                    group = [low if g == high else g for g in group]
                    changed = True
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = i if least.get(g) is None else least[g] if i is None else min(i, least[g])
    return sorted(((i, p - (1 << 64) if p >> 63 else p, least[g]) for (i, _), p, g in zip(rows, prints, group)), key=str)


def _rows():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(300)]
    rows = []
    for i in range(40):
        text = rng.choices(words, k=rng.choice([2, 5, 200, 400]))
        rows.append((i, " ".join(text)))
        for k in range(rng.randrange(3)):
            near = list(text)
            near[rng.randrange(len(near))] = "changed"
            rows.append((100 + 3 * i + k, "\n".join(near).upper()))
    return rows + [(900, None), (901, ""), (902, " \t\x0b"), (903, "one"), (904, "one two"), (905, "É É É"), (906, "é é é"),
                   (907, "a b c " * 30_000), (908, "A  B\tC " * 30_000), (3, rows[3][1]), (3, rows[3][1]), (None, "no id here"), (None, rows[0][1])]


def test_groups_as_over_all_pairs(spark, monkeypatch):
    rows = _rows()
    expected = _groups(rows)
    for bucket in (2048, 1):  # 1: every bucket is dealt anew
        monkeypatch.setattr(simhash, "BUCKET", bucket)
        got = [tuple(r) for r in simhash.near_duplicates(_docs(spark, rows)).select("doc_id", "fp", "component_id").collect()]
        assert sorted(got, key=str) == expected


def test_one_row_of_each_group_stays(spark):
    rows = _rows()
    groups = {g for _, _, g in _groups(rows)}
    docs = _docs(spark, rows)
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=str) == sorted(groups, key=str)


def test_empty_table(spark):
    assert simhash.near_duplicates(_docs(spark, [])).collect() == []
    assert simhash.keep_one_per_group(_docs(spark, [])).collect() == []


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_bit_slices_find_every_pair(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 90, dtype=np.uint64)
    near = [base.copy() for _ in range(4)]
    for n, x in enumerate(near):
        for k in range(len(x)):
            for b in rng.choice(64, n + 1, replace=False):
                x[k] ^= np.uint64(1 << int(b))
    fps = np.unique(np.concatenate([base, *near]))
    rng.shuffle(fps)
    runs = np.array([0, 1, 3, 67, 131, len(fps)])
    i, j = simhash.neighbours(fps, runs, radius)
    expected = {(a, b) for s, e in zip(runs, runs[1:]) for a in range(s, e) for b in range(a + 1, e)
                if bin(int(fps[a] ^ fps[b])).count("1") <= radius}
    assert set(zip(i.tolist(), j.tolist())) == expected and len(i) == len(expected)


def test_masks_leave_no_pair_out():
    for m, bits in ((simhash.masks(2), range(64)), (simhash.masks(2, list(range(26)), 2), range(26))):
        assert all(any(not x & (1 << a | 1 << b) for x in m) for a in bits for b in bits)


def test_text_blocks_make_no_difference(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(3000))
    whole = simhash.simhash(text)
    monkeypatch.setattr(simhash, "BLOCK", 50)
    assert simhash.simhash(text) == whole


def test_components_of_chains_and_stars(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(300, 299), (5, 5), (300, 299)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    expected = {k: 0 for k in range(1, 41)} | {100 + k: 100 for k in range(1, 60)} | {300: 299}
    assert got == expected
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
