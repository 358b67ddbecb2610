"""Operator 1 against a plain sequential version."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

import pytest

from hypercube.llm import mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, u double, target string, __w long"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, 9, 0.5, "x", 1) for i, t, s in rows], DOCS)


def _labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def _mix(rows, quality):
    """Targets by water-filling one source after the other; documents in order of their keys."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    own = defaultdict(list)
    for i, t, s in rows:
        own[s].append((i, size(t)))
    names = sorted(own, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    words = {s: sum(n for _, n in own[s]) for s in names}
    target, left, free = {}, sum(words.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 3 * words[s]}
        if not full:
            target |= {s: weight[s] * level for s in free}
            break
        for s in full:
            target[s] = 3.0 * words[s]
            left -= 3 * words[s]
        free -= full
    taken = []
    for s in names:
        def key(d):
            digest = hashlib.md5(f"7|{'' if d[0] is None else d[0]}|{d[1]}".encode()).hexdigest()
            u = (int(digest[:13], 16) + 0.5) / 2 ** 52
            return -math.log(u) / quality.get(d[0], 1.0)
        epochs = int(target[s] // words[s]) if words[s] else 0
        rest, at = target[s] - epochs * words[s], 0
        for d in sorted(own[s], key=key):
            more = at + d[1] / 2 <= rest and d[1] > 0
            taken.append((d[0], d[1], words[s], round(target[s], 6), (epochs + more) * d[1]))
            at += d[1]
    return sorted(taken, key=str)


ROWS = ([(i, " ".join(["w"] * (1 + i * 7 % 23)), f"s{i % 5}") for i in range(200)]
        + [(1000, None, "s0"), (1001, "", "s1"), (1002, " \t\n", None), (1003, "a b c", None), (1004, "x" * 300_000 + " y", "big"),
           (1005, "long " * 5000, "tiny"), (None, "no id", "s2")])


@pytest.mark.parametrize("bucket", [2048, 4])
def test_mix_as_in_sequence(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET", bucket)
    labels = [(i, i % 2, 0) for i in range(0, 200, 3)] + [(5, None, 1), (None, 1, 0)]
    quality = {i: 2.0 if q else 0.5 for i, q, _ in labels if i is not None and q is not None}
    rows = mixing.sized(_docs(spark, ROWS), mixing.quality_weights(_labels(spark, labels)))
    got = [(r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["copies"] * r["size"]) for r in mixing.mix(rows).collect()]
    assert sorted(got, key=str) == _mix(ROWS, quality)


def test_taken_words_come_near_targets_and_documents_repeat(spark):
    docs, quality = _docs(spark, ROWS), mixing.quality_weights(_labels(spark))
    rows = mixing.mix(mixing.sized(docs, quality)).collect()
    taken, target, most = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= most[s] / 2 for s in taken)
    mixed = mixing.mixed_documents(docs, quality)
    assert mixed.columns == docs.columns
    copies = {r["doc_id"]: r["copies"] for r in rows if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies


def test_empty_table_and_empty_texts(spark):
    quality = mixing.quality_weights(_labels(spark))
    assert mixing.mix(mixing.sized(_docs(spark, []), quality)).collect() == []
    assert mixing.mixed_documents(_docs(spark, []), quality).collect() == []
    assert [r["copies"] for r in mixing.mix(mixing.sized(_docs(spark, [(1, None, None), (2, "", "a")]), quality)).collect()] == [0, 0]


def test_repeated_rows_are_taken_alike(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (2, "c d e", "s"), (3, "f " * 50, "t")]
    got = mixing.mix(mixing.sized(_docs(spark, rows), mixing.quality_weights(_labels(spark)))).collect()
    assert len(got) == 4 and len({r["copies"] for r in got if r["doc_id"] == 1}) == 1
