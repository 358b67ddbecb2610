"""Operators 6 and 7: held-out accuracy, bundling by hand, equal substrings."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hypercube.llm import language, parsing

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, `key` long, block long"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, la, None, None, 1.0, 2, 3) for i, t, la in rows], DOCS)


def _texts(n):
    rng = random.Random(1)
    parts = {"xx": "tha ing the ou er ion".split(), "yy": "ung sch ein keit ü der".split(), "zz": "ção ão nh lh que os".split()}
    return [(i, " ".join("".join(rng.choices(parts[la], k=3)) for _ in range(rng.choice([4, 60]))), la)
            for i in range(n) for la in [rng.choice(list(parts))]]


def test_profile_is_the_bundle_of_bound_letters():
    text, letters = "Ab, é", [0, ord("a"), ord("b"), 0, ord("é"), 0]
    by_hand = np.zeros(language.DIM)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        by_hand += np.roll(language._letter(a), 2).astype(int) * np.roll(language._letter(b), 1) * language._letter(c)
    vectors, known = language.profiles([text, None, "", "12 ?", "x" * 10])
    assert (vectors[0] == by_hand).all() and known.tolist() == [True, False, False, False, True]


def test_batches_and_many_letters_make_no_difference(monkeypatch):
    texts = [t for _, t, _ in _texts(30)] + ["".join(chr(0x4E00 + k) for k in range(3000))]
    whole, _ = language.profiles(texts)
    monkeypatch.setattr(language, "CHARS", 40)
    monkeypatch.setattr(language, "GRAMS", 100)
    assert np.allclose(language.profiles(texts)[0], whole)


def test_texts_are_judged_a_few_at_a_time(monkeypatch):
    # a batch's profiles, 4 KB a text, never stand in memory together
    rows = _texts(60)
    texts = [t for _, t, _ in rows] + [None, "", "12 ?"]
    model = {la: language.profiles([t for _, t, x in rows if x == la])[0].sum(axis=0) for la in ("xx", "yy", "zz")}
    whole = language._judge(texts, model)
    profiled = []
    monkeypatch.setattr(language, "profiles", lambda some, of=language.profiles: profiled.append(len(some)) or of(some))
    langs, scores = language._judge(texts, model, 7)
    assert langs == whole[0] and np.allclose(scores, whole[1]) and len(scores) == 63
    assert max(profiled) == 7 and sum(profiled) == 63 and langs[-3:] == ["und"] * 3


def test_held_out_languages(spark):
    rows = _texts(300) + [(1000, None, "xx"), (1001, "", "xx"), (1002, "12 !?", "yy"), (None, "tha ing the", "xx"), (1003, "schein keit", None)]
    rows += [(5, rows[5][1], rows[5][2])]
    docs = _docs(spark, rows)
    got = language.identify(docs).withColumn("out", language.held_out(F.col("doc_id"))).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, t, _ in rows:
        assert by_id[i]["out"] == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
    assert all((by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0) for i in (1000, 1001, 1002))
    out = [(by_id[i]["lang_pred"], la) for i, _, la in rows[:300] if by_id[i]["out"]]
    assert sum(a == b for a, b in out) / len(out) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((i for i, *_ in rows if i not in (1000, 1001, 1002)), key=str)


def test_small_sample_and_nothing_to_learn(spark):
    rows = _texts(300)
    got = language.identify(_docs(spark, rows), sample=20).collect()
    assert sum(r["lang_pred"] == dict((i, la) for i, _, la in rows)[r["doc_id"]] for r in got) > 270
    unknown = _docs(spark, [(1, "abc", None)])
    assert [tuple(r) for r in language.identify(unknown).collect()] == [(1, "und", 0.0)]
    assert language.keep_identified(unknown).count() == 1
    assert language.identify(_docs(spark, [])).collect() == [] == language.keep_identified(_docs(spark, [])).collect()


@pytest.mark.parametrize("shift", [1, 7, 100])
def test_equal_substrings_share_interior_signatures(shift):
    rng = random.Random(shift)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(1, 9)))
    same = " ".join(word() for _ in range(400))
    a, b = (" ".join(word() for _ in range(shift)) + same + " ".join(word() for _ in range(30)) for _ in range(2))
    inner, left, right = ({int(x) for x in names} for names in parsing._signatures([same, a, b]))
    assert len(inner & left & right) >= len(inner) - 6


def test_signatures_do_not_depend_on_the_batch():
    texts = [t for _, t, _ in _texts(50)] + ["", "a", "aa", "aaaa" * 100, "ab" * 500, "é中" * 7]
    alone = [parsing.sketches([t])[0] for t in texts]
    together = parsing.sketches(texts)
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(alone, together))
    assert all(len(s) for s, t in zip(together, texts) if t) and not len(together[50])


def test_likeness():
    one, two = np.arange(10, dtype=np.uint32), np.arange(5, 15, dtype=np.uint32)
    none = np.zeros(0, np.uint32)
    assert parsing.likeness(one, one) == 1 == parsing.likeness(none, none)
    assert parsing.likeness(one, none) == 0 and abs(parsing.likeness(one, two) - 0.5) < 1e-9


def test_compared_with_edit_as_in_sequence(spark, monkeypatch):
    rows = _texts(120) + [(200, None, None), (201, "", None), (202, "x" * 100_000, None), (7, "seven again", None), (7, "seven again", None),
                          (None, "no id", None), ((1 << 62) + 1, "far", None), (-5, "below", None)]
    monkeypatch.setattr(parsing, "CHARS", 500)
    got = parsing.compare_with_edit(_docs(spark, rows)).collect()
    order = sorted(((-(1 << 63) if i is None else i), t or "") for i, t, _ in rows)
    expected = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        n = len(t) // 4
        edited = t[: len(t) - n] + after[:n]
        own, changed, following = parsing.sketches([t, edited, after])
        expected.append((None if i == -(1 << 63) else i, len(t), hashlib.sha256(edited.encode()).hexdigest(), parsing.as_text(own),
                         parsing.as_text(changed), parsing.likeness(own, changed), parsing.likeness(own, following)))
    assert sorted((tuple(r) for r in got), key=str) == sorted(expected, key=str)
    same = {r["doc_id"]: r["fingerprint"] for r in parsing.fingerprints(_docs(spark, rows)).collect()}
    assert all(same[r["doc_id"]] == r["fingerprint"] for r in got if r["doc_id"] != 7)


def test_one_row_and_no_rows(spark):
    one = parsing.compare_with_edit(_docs(spark, [(1, "abcdefgh", None)])).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and one[0]["near_next"] == 1.0
    assert parsing.compare_with_edit(_docs(spark, [])).collect() == []
