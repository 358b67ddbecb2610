"""Operator 5: every id in exactly one piece, sequences gapless and full."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from hypercube.llm import packing

DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids long, shard long, length long"
PATH = packing.tokenizer_path()

LETTERS = "the of and thin reading mice walked home, don't; É naïve 中文 ΣΑΣ 12 345 end."


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, 1, 2, 3) for i, t in rows], DOCS)


def _rows():
    rng = np.random.default_rng(2)
    words = LETTERS.split()
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 900)))) for i in range(120)]
    rows += [(500 + i, rows[7][1]) for i in range(30)]
    return rows + [(900, None), (901, ""), (902, " \n\t"), (903, "x <|endoftext|> y"), (904, "long words " * 30_000), (3, "again"), (3, "again"), (None, "no id"), (None, None)]


@pytest.mark.parametrize("shard", [packing.SHARD, 3000])
def test_every_id_lies_in_one_piece(spark, shard):
    rows = _rows()
    encode = packing.Encoder(PATH).tokenizer
    ids = [encode.encode(t or "", add_special_tokens=False).ids + [1] for _, t in rows]
    pieces = packing.pack(_docs(spark, rows), PATH, shard=shard, with_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert 0 < p["length"] == len(p["ids"]) and p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
        by_doc[p["doc_id"]].append((p["start"], p["length"], p["doc_tokens"], tuple(p["ids"])))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for doc_id, found in by_doc.items():
        wanted = Counter(tuple(x) for (i, _), x in zip(rows, ids) if i == doc_id)
        assert sum(n for _, n, _, _ in found) == sum(len(x) * k for x, k in wanted.items())
        if len(wanted) == 1 and sum(wanted.values()) == 1:
            found.sort()
            assert [s for s, *_ in found] == np.cumsum([0] + [n for _, n, _, _ in found[:-1]]).tolist()
            assert [x for *_, part in found for x in part] == list(next(iter(wanted)))
            assert {t for _, _, t, _ in found} == {len(next(iter(wanted)))}
    assert sum(p["length"] for p in pieces) == sum(map(len, ids))
    for found in by_sequence.values():
        found.sort()
        assert [o for o, _ in found] == np.cumsum([0] + [n for _, n in found[:-1]]).tolist()
        total = sum(n for _, n in found)
        assert total <= 2048 and total & (total - 1) == 0  # no padding at all


def test_neighbours_share_words():
    docs = [np.array([k % 2 * 100 + j for j in range(50)]) for k in range(40)]
    idf = np.ones(300)
    sequences = packing.fill_windows(docs, [len(d) + 1 for d in docs], idf, 50.0, window=204)
    mixed = [len({d % 2 for d, _, _ in s}) for s in sequences if sum(n for _, _, n in s) == 204]
    assert sum(m > 1 for m in mixed) <= 1


def test_windows_of_short_documents_hold_one_topic():
    # 60 documents fill a window, all are like its seed; topics alternate by place
    docs = [np.array([k % 3 * 100 + 7 * (k // 3) % 90 + j for j in range(9)]) for k in range(3 * 180)]
    docs = [np.append(d, 300 + k % 3) for k, d in enumerate(docs)]
    lengths = [len(d) + 1 for d in docs]
    sequences = packing.fill_windows(docs, lengths, np.ones(400), 10.0, window=660)
    assert [len(s) for s in sequences] == [60] * 9
    assert all(len({d % 3 for d, _, _ in s}) == 1 for s in sequences)


def test_windows_are_those_of_the_full_ranking():
    rng = np.random.default_rng(9)
    docs = [rng.zipf(1.3, rng.integers(1, 90)).clip(1, 199) for _ in range(400)] + [np.arange(40)] * 60
    lengths, idf, mean, window = [len(d) + 1 for d in docs], rng.random(200) + 0.1, 40.0, 512
    counts = [np.bincount(d, minlength=200) for d in docs]
    weights = np.array([idf * (c * (packing.K1 + 1) / (c + packing.K1 * (1 - packing.B + packing.B * len(d) / mean))) for c, d in zip(counts, docs)])
    left, wanted, window_now, seed = list(lengths), [], [], -1
    while any(left):
        if seed < 0:
            seed = next(k for k, n in enumerate(left) if n)
        score = weights[:, np.unique(docs[seed])].sum(axis=1)
        order = [seed] + [k for k in np.argsort(-score.round(9), kind="stable").tolist() if k != seed and left[k] and score[k] > 0]
        seed = -1
        for k in order:
            take = min(left[k], window - sum(n for _, _, n in window_now))
            window_now.append((k, lengths[k] - left[k], take))
            left[k] -= take
            if sum(n for _, _, n in window_now) == window:
                wanted.append(window_now)
                window_now, seed = [], k if left[k] else -1
                break
    found = packing.fill_windows(docs, lengths, idf, mean, window)
    assert found[: len(wanted)] == wanted and len(wanted) > 20


def test_word_by_word_ids_are_the_tokenizers():
    encode = packing.Encoder(PATH)
    texts = [LETTERS, "It's ΣΑΣ İstanbul, foo.\tbar baz x́ <|endoftext|> A.B., .., x", "İ. É, ǅ, 中文。 ", "a\x85b\u3000c\x1cd  e\r\nf", "ﬁ ½ ①, ,", "A,. B.,"]
    texts = texts + ["", " ", "\n\n", *texts]
    texts += ["a1b22.c,,d!x", "x's 'tis ''re a'B", "\u00aa\u00ba\u00b5 \u00b2\u00bd \u00d7\u00f7 \u00e9\u00c9", "".join(map(chr, range(33, 383))), " ".join(map(chr, range(33, 383)))]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_take_whole_texts():
    encode = packing.Encoder(packing.tokenizer_path("byte_bpe_50k.json"))
    assert packing.Encoder(PATH).by_word and not encode.by_word
    for text in [LETTERS, packing.SAMPLE, ""]:
        assert np.frombuffer(encode(text), "<u4").tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_full_memory_of_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBER", 2)
    encode = packing.Encoder(PATH)
    for text in [LETTERS, LETTERS.upper(), LETTERS]:
        assert np.frombuffer(encode(text), "<u4").tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_parts_of_a_batch_are_asked_once(monkeypatch):
    asked = []
    encode = packing.Encoder(PATH)
    monkeypatch.setattr(packing, "CHARS", 40)  # a slice ends within the batch
    monkeypatch.setattr(packing.Encoder, "_part", lambda self, part, plain, of=packing.Encoder._part: asked.append(part) or of(self, part, plain))
    texts = ["walrus, walrus. (walrus", "", "Walrus!\nquince7 7quince", "x <|endoftext|> y", "É walrus\u3000中文 quince", *[LETTERS] * 3, "a  b "]
    for _ in range(2):
        found = list(encode.batch(texts))
        assert [ids.tolist() for ids in found] == [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(asked.count(p) for p in asked) == 1 and asked.count("walrus") == 1
    monkeypatch.setattr(packing, "REMEMBER_BYTES", 100)  # more than the words of some slice take
    assert [ids.tolist() for ids in encode.batch(texts)] == [ids.tolist() for ids in found]


def test_no_documents(spark):
    assert packing.pack(_docs(spark, []), PATH).collect() == []


def test_topics_are_dealt_evenly():
    assert packing._deal({3: 10, 4: 25, 5: 4, 6: 3, 9: 7}, 10) == [(3, 0, 1), (4, 1, 3), (5, 4, 1), (6, 4, 1), (9, 5, 1)]


def test_large_topics_are_split_by_content(spark):
    # one word tells most about all documents; 8 kinds of texts, 25 copies of each, spread over the ids
    kinds = ["zebra " * 40 + f"{ws[0]} {ws[0]} {ws[1]} the of" for ws in
             (("piano", "violin"), ("piano", "guitar"), ("cheese", "butter"), ("cheese", "bread"),
              ("river", "lake"), ("river", "ocean"), ("engine", "wheel"), ("engine", "brake"))]
    rows = [(k * 7919 % 200, kinds[k * 7919 % 200 % 8]) for k in range(200)] + [(1000 + k, "the of and in") for k in range(9000)]
    size = packing.encoder(PATH).tokenizer.get_vocab_size()
    one = [len(packing.encoder(PATH)(t)) // 4 + 1 for t in kinds]
    shard = 2 * 25 * max(one) + 10
    tokens = packing.tokenize(_docs(spark, rows), PATH, "<u2", size)
    found, _, _ = packing.sharded(packing.written(tokens, "test-tokens"), "<u2", size, shard)
    of, filled = defaultdict(set), Counter()
    for r in found.collect():
        if r["doc_id"] < 1000:
            of[r["doc_id"] % 8].add(r["shard"])
        filled[r["shard"]] += len(r["ids"]) // 2 + 1
    assert max(filled.values()) <= shard and len(set.union(*of.values())) == 4
    assert all(len(shards) == 1 for shards in of.values())  # copies meet
    assert all(of[k] == of[k + 1] for k in range(0, 8, 2))  # and those that share the next term


def test_topics_follow_the_documents_not_the_vocabulary(spark):
    # the word with the late id stands in all documents, so it tells nothing
    encode = packing.encoder(PATH)
    ids = {w: np.frombuffer(encode(w), "<u4").tolist() for w in ("the", "and", "zebra")}
    (early,), (other,), late = ids["the"], ids["and"], ids["zebra"]
    assert max(late) > max(early, other)
    idf = np.log1p(np.full(max(late) + 1, 1000.0))
    idf[late] = 0.01
    terms = np.array(sorted([early, *late]))
    assert packing._topic(terms, np.ones(len(terms)), idf) == early


def test_segments_hold_all_rows_and_end_between_topics():
    rng = np.random.default_rng(4)
    rows = sorted((bytes(rng.integers(0, 3, 6).tolist()), int(rng.integers(0, 2)), k, int(rng.integers(1, 9))) for k in range(900))
    rows = sorted(rows + [(b"\x01\x01", 5, 10_000 + k, 4) for k in range(300)])
    for parts in (1, 7):
        found = [x for k in range(parts) for x in packing._segments(iter(rows[k * len(rows) // parts: (k + 1) * len(rows) // parts]), 200, 1)]
        assert sum(x[3] for x in found) == sum(r[3] for r in rows)
        cuts = packing._joined(found, 200, 1)
        filled = Counter()
        for r in rows:
            filled[packing.bisect_right(cuts, r[:3])] += r[3]
        assert max(filled.values()) <= 200 and len(filled) == len(cuts) + 1
    assert list(packing._segments(iter([]), 200, 1)) == []
    long = [(b"\x01", 1, 1, 500), (b"\x02", 1, 2, 3), (b"\x02", 2, 2, 500)]
    assert [x[3] for x in packing._segments(iter(long), 200, 1)] == [500, 3, 500]


def test_terms_are_counted_once_beside_the_ids(spark):
    # what topics, keys and shards need stands in the written tokens; no later pass over them counts ids again
    rows = [(k, t) for k, (_, t) in enumerate(_rows())]
    size = packing.encoder(PATH).tokenizer.get_vocab_size()
    tokens = packing.tokenize(_docs(spark, rows), PATH, "<u2", size).filter("term IS NULL").collect()
    assert len(tokens) == len(rows)
    for r in tokens:
        ids = np.frombuffer(packing.encoder(PATH)(rows[r["doc_id"]][1] or ""), "<u4")
        terms, counts = np.unique(ids, return_counts=True)
        assert np.frombuffer(r["ids"], "<u2").tolist() == ids.tolist() and r["n"] == len(ids) + 1
        assert np.frombuffer(r["terms"], "<u2").tolist() == terms.tolist()
        assert np.frombuffer(r["counts"], packing.COUNT).tolist() == counts.tolist()
        assert r["same"] == zlib.crc32(bytes(r["ids"]))


def test_topics_of_a_batch_are_those_of_its_documents():
    rng = np.random.default_rng(8)
    idf = rng.integers(1, 4, 50) / 2.0  # many ties
    docs = [packing._counted(rng.zipf(1.4, n).clip(1, 49).astype("<u2")) for n in [0, 1, 5, 0, 0, *rng.integers(0, 60, 300), 0]]
    wanted = [int(t[(idf[t] * (c * (packing.K1 + 1) / (c + packing.K1))).argmax()]) if len(t) else -1 for t, c in docs]
    lengths = np.array([len(t) for t, _ in docs])
    assert packing._topics(*map(np.concatenate, zip(*docs)), lengths, idf).tolist() == wanted
    assert packing._topics(np.zeros(0, "<u2"), np.zeros(0, "<u4"), np.zeros(3, int), idf).tolist() == [-1, -1, -1]


@pytest.mark.parametrize("often", [1, 8, 10_000])
def test_frequent_and_rare_terms_score_alike(monkeypatch, often):
    monkeypatch.setattr(packing, "OFTEN", often)
    rng = np.random.default_rng(5)
    docs, idf, mean = [rng.zipf(1.3, rng.integers(0, 90)).clip(1, 199) for _ in range(200)], rng.random(200) + 0.1, 40.0
    index, counts = packing._Index(docs, idf, mean), [np.bincount(d, minlength=200) for d in docs]
    weights = np.array([idf * (c * (packing.K1 + 1) / (c + packing.K1 * (1 - packing.B + packing.B * len(d) / mean))) for c, d in zip(counts, docs)])
    for kept in (np.ones(200, bool), rng.random(200) < 0.5, np.arange(200) % 7 == 3):
        index.keep(kept)
        for k in range(0, 200, 9):
            np.testing.assert_allclose(index.scores(k), weights[index.place][:, np.unique(docs[k])].sum(axis=1), atol=1e-9)
    assert len(index.place) < 40


def test_slices_hold_all_rows(monkeypatch):
    monkeypatch.setattr(packing, "CHARS", 10)
    texts = ["abcd", None, "é" * 6, "x", "", "y" * 25, None, "z"]
    batch = packing.pa.RecordBatch.from_arrays([packing.pa.array(range(8)), packing.pa.array(texts)], ["doc_id", "text"])
    found = [s.column(1).to_pylist() for s in packing._slices(batch)]
    assert [t for s in found for t in s] == texts
    assert all(len(s) == 1 or sum(len(t or "") for t in s) <= 10 for s in found) and len(found) == 4
    assert list(packing._slices(batch.slice(0, 0))) == []


class _Rows:
    """Stands for a DataFrame and returns the function that Arrow batches would go through."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_few_texts_rows_are_held_at_a_time_and_memory_is_given_back(spark, monkeypatch):
    monkeypatch.setattr(packing, "TOGETHER", 3)
    monkeypatch.setattr(packing, "CHARS", 60)
    given = []
    monkeypatch.setattr(packing, "give_back", lambda: given.append(1))
    texts = ["Some words", None, "", "ÀÉ Größe", "ŠKODA İx ÀB", "a\nb", "<|endoftext|> x", "word " * 7] * 3
    size = packing.encoder(PATH).tokenizer.get_vocab_size()
    run = packing.tokenize(_Rows(), PATH, "<u2", size)
    for kind in (packing.pa.string(), packing.pa.large_string()):
        given.clear()
        batch = packing.pa.RecordBatch.from_arrays([packing.pa.array(range(24), packing.pa.int64()), packing.pa.array(texts, kind)], ["doc_id", "text"])
        *parts, last = run(iter([batch, batch]))
        assert max(len(p) for p in parts) == 3 and sum(len(p) for p in parts) == 48
        assert len(given) == 2 * len(list(packing._slices(batch))) > 2
        rows = [r for p in parts for r in p.to_pylist()]
        assert [r["doc_id"] for r in rows] == [*range(24)] * 2 and [r["slot"] for r in rows] == [*range(48)]
        for r in rows:
            ids = packing.encoder(PATH)._encode(texts[r["doc_id"]] or "")
            assert np.frombuffer(r["ids"], "<u2").tolist() == np.frombuffer(ids, "<u4").tolist()
        assert len(last) == len({x for r in rows for x in np.frombuffer(r["ids"], "<u2")})


def test_texts_are_lowered_as_python_does_if_they_are_latin():
    texts = ["".join(map(chr, range(256))), "ÀB Š", "İ", "", "ABİ", "ÞÆ×ß µ"]
    assert packing._lowered(packing.pa.array(texts)).to_pylist() == [t.lower() if all(ord(c) < 256 for c in t) else t for t in texts]
