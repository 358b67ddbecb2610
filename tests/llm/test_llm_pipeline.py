"""The pipeline's stages, each against a plain version of its own input; the registered queries."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import pytest
from test_llm_lines_urls import _dropped
from test_llm_mixing import _mix
from test_llm_simhash import _groups

import __spark_entry__
from hypercube.llm import packing

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def _rows():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(200)]
    rows = []
    for i in range(60):
        text = " ".join(rng.choices(words, k=rng.randint(20, 300)))
        rows.append((i, text + ("\nshared footer" if i % 2 else ""), "xx", f"s{i % 4}"))
    rows += [(100 + i, rows[i][1], "xx", "s1") for i in range(15)]
    rows += [(200, None, "xx", "s0"), (201, "", "xx", "s0"), (202, "12 34 !", "xx", "s0"), (203, "shared footer", None, None), (None, "no id here", "xx", "s2")]
    rows += [(5, *rows[5][1:]), (300, "word " * 20_000, "xx", "s3")]
    return rows


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame([(*r, 0, "kept") for r in _rows()], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(0, 60, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        assert k == 4 or out.columns == docs.columns
        out.write.parquet(f"{folder}/{k}-{name}")
        found.append((docs, out := spark.read.parquet(f"{folder}/{k}-{name}")))
        docs = out
    return folder, found


def _plain(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_documents_without_letters_go(stages):
    before, after = stages[1][0]
    assert _plain(after, "doc_id", "text") == sorted(((r["doc_id"], r["text"]) for r in before.collect()
                                                      if any(c.isalpha() for c in r["text"] or "")), key=str)


def test_footers_go(stages):
    before, after = stages[1][1]
    assert _plain(after, "doc_id", "text", "source") == sorted(_dropped([(r["doc_id"], r["text"], r["source"]) for r in before.collect()]), key=str)


def test_one_of_each_group_stays(stages):
    before, after = stages[1][2]
    assert [i for i, in _plain(after, "doc_id")] == sorted({g for *_, g in _groups([(r["doc_id"], r["text"]) for r in before.collect()])}, key=str)


def test_the_mix_is_taken(stages):
    before, after = stages[1][3]
    quality = {i: 2.0 if i % 2 else 0.5 for i in range(0, 60, 2)}
    # a text that line dedup left empty has no words to take: it comes once per complete epoch of its source
    expected = Counter({i: taken // size if size else int(target // words) if words else 0 for i, size, words, target, taken
                        in _mix([(r["doc_id"], r["text"], r["source"]) for r in before.collect()], quality)})
    assert Counter(r["doc_id"] for r in after.collect()) == +expected


def test_all_ids_are_packed(stages):
    before, after = stages[1][4]
    tokenizer = packing.Encoder(packing.tokenizer_path()).tokenizer
    expected = Counter()
    for r in before.collect():
        expected[r["doc_id"]] += len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1
    found = Counter()
    for r in after.collect():
        found[r["doc_id"]] += r["length"]
    assert found == expected


def test_run_is_its_stages(spark, stages):
    folder, found = stages
    columns = ("doc_id", "start", "length", "ids_crc32")
    assert _plain(corpus_pipeline.run(spark, folder), *columns) == _plain(found[-1][1], *columns)


def test_empty_tables(spark, stages, tmp_path):
    folder = stages[0]
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered_queries():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{n}" for n in range(1, 11)} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
