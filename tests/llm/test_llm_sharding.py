"""Operator 12: the laws of its shards."""

from __future__ import annotations

import zlib
from collections import defaultdict

import pytest

from hypercube.llm import sharding

DOCS = "doc_id long, text string, size string, shard string, slot string, __hash string"


def _placed(spark, rows, shards=8, tolerance=sharding.TOLERANCE):
    docs = spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], DOCS)
    out = sharding.sharded(docs, shards, tolerance)
    assert out.columns[:6] == docs.columns and out.columns[6:] == ["_size", "_shard", "_slot"]
    return [(r["doc_id"], r["text"], r["_size"], r["_shard"], r["_slot"]) for r in out.collect()]


def _key(row):
    return (row[0] is not None, row[0] or 0, row[1] is not None, row[1] or "")


def _check(rows, got, shards=8, tolerance=sharding.TOLERANCE):
    assert sorted(((i, t) for i, t, *_ in got), key=_key) == sorted(rows, key=_key)
    sizes, slots = [0] * shards, defaultdict(list)
    for _, text, size, shard, slot in got:
        assert size == len((text or "").encode()) + 1
        sizes[shard] += size
        slots[shard].append(slot)
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    if rows:
        longest = max(size for _, _, size, _, _ in got)
        # both ends of a shard may miss their places
        assert max(sizes) - min(sizes) <= 2 * longest + 4 * tolerance * sum(sizes) / shards + 2


@pytest.mark.parametrize("name", ["plain", "hot", "repeats", "nulls", "long", "tiny"])
def test_near_equal_bytes(spark, name):
    rows = {
        "plain": [(i, f"text {i} " * (i % 37)) for i in range(3000)],
        "hot": [(i, "the same text" if i % 3 == 0 else f"é{i}") for i in range(3000)],
        "repeats": [(1, "again and again")] * 2000 + [(i, f"other {i}") for i in range(500)],
        "nulls": [(None, None)] * 600 + [(None, "x"), (3, ""), (3, None)] * 40,
        "long": [(i, "y" * (200_000 if i == 5 else 40)) for i in range(2000)],
        "tiny": [(1, "a"), (2, "b"), (3, None)],
    }[name]
    _check(rows, _placed(spark, rows))


def test_tolerance_and_one_shard(spark):
    rows = [(i, f"words {i}") for i in range(1500)]
    _check(rows, _placed(spark, rows, 5, 0.1), 5, 0.1)
    _check(rows, _placed(spark, rows, 1), 1)


def test_copies_lie_together(spark):
    rows = [(i, f"group {i % 50}") for i in range(1000)]
    of = defaultdict(set)
    for _, text, _, shard, _ in _placed(spark, rows):
        of[text].add(shard)
    assert sum(len(s) > 1 for s in of.values()) <= 7


def test_empty(spark):
    assert _placed(spark, []) == []


def test_query(spark, sf_small):
    docs = {r.doc_id: r.text for r in sharding.table(spark, sf_small, "documents").collect()}
    out = sharding.op12_sharding(spark, sf_small).collect()
    again = sharding.op12_sharding(spark, sf_small).collect()
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, again), key=str)
    assert all(r.law == "bytes" and r.grown_shard is None and r.text_crc32 == zlib.crc32((docs[r.doc_id] or "").encode()) for r in out)
    _check(list(docs.items()), [(r.doc_id, docs[r.doc_id], r["size"], r["shard"], r["slot"]) for r in out])
