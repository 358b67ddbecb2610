"""Operators 2 and 4: brute force over all pairs, pages with known articles."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hypercube.llm import html_text, topk

VECTORS = "vec_id long, embedding array<double>, label int, score long, rank int, dim int, asks boolean"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3, True) for i, v in rows], VECTORS)


def _best(rows, step, top):
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fine[i] = min(fine.get(i, v), v)
    whole = {i: [math.floor(256 * x) for x in v] for i, v in fine.items()}
    out = []
    for q in whole:
        if q % step == 0:
            scores = sorted((-max(min(sum(a * b for a, b in zip(whole[q], whole[c])), (1 << 63) - 1), -(1 << 63)), c) for c in whole if c != q and len(whole[c]) == len(whole[q]))
            out += [(q, k + 1, c, -s) for k, (s, c) in enumerate(scores[:top])]
    return sorted(out)


def _found(frame, step, top=5):
    return sorted(tuple(r) for r in topk.top_scores(frame, F.col("vec_id") % step == 0, top).collect())


def test_best_as_over_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=20).tolist()) for i in range(230)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # ties
    rows += [(2000 + i, rows[50][1]) for i in range(3)]
    rows += [(5, None), (10, [1.0, None]), (15, [float("nan")] * 20), (20, [float("inf")] * 20), (None, rows[1][1]), (None, None),
             (3000, [0.5] * 3), (3010, [0.25, -1.0, 7.0]), (3020, []), (3030, []), (25, rows[2][1]), (25, rows[2][1])]
    for sizes in ((8192, 4096, 1024), (16, 32, 8)):
        for name, n in zip(("QUERIES", "CANDIDATES", "STEP"), sizes):
            monkeypatch.setattr(topk, name, n)
        assert _found(_frame(spark, rows), 5) == _best(rows, 5, 5)
    assert _found(_frame(spark, rows[:3]), 1, 5) == _best(rows[:3], 1, 5)


def test_large_components_are_exact(spark):
    rows = [(0, [1e9 + 0.25, 3.0]), (1, [1e9, -1.0]), (2, [1e9, 1.0]), (3, [-1e9, 1.0]), (4, [1e12, 1e12]), (5, [1e12, -1e12])]
    assert _found(_frame(spark, rows), 1, 3) == _best(rows, 1, 3)


def test_no_vectors(spark):
    assert _found(_frame(spark, []), 5) == []
    assert _found(_frame(spark, [(1, [1.0])]), 5) == []


def test_bounds_cap_every_score():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(30, 64)), rng.normal(size=(40, 64)) * 3
    for n in topk.SEGMENTS:
        a, b = topk._summary(x, n), topk._summary(y, n)
        lower = ((a[:, None] - b) ** 2).sum(axis=2)
        assert (lower <= ((x[:, None] - y) ** 2).sum(axis=2) + 1e-9).all()


PROSE = "<p>" + "A long sentence of the article stands here, with commas. " * 6 + "</p>"
TEXT = " ".join(["A long sentence of the article stands here, with commas."] * 6)


def test_articles_without_what_is_around_them():
    cases = {
        f"<html><head><title>x</title></head><body><nav><a href=/>Home</a></nav><div class='ad'>Buy</div><article><h1>T&amp;t</h1>{PROSE}<p>End.</article><footer>f</footer>": f"T&t\n{TEXT}\nEnd.",
        f"<body><header><h1>Site</h1></header><main><h2>T</h2>{PROSE}<p>a<br>b &lt; c&nbsp;d</p></main><aside>s</aside>": f"T\n{TEXT}\na b < c d",
        f"<body><div id='top-menu'><ul><li><a>m</a></ul></div><div id=content><h1>T</h1><div>{PROSE}<p>s</p>{PROSE}</div></div><div class='comments-area'>{PROSE}</div><div class='cookie-notice'>ok</div>": f"T\n{TEXT}\ns\n{TEXT}",
        f"<article><header><h1>T</h1><p>by</p></header>{PROSE}<form><label>x</label><input></form><section id=comments><article class=comment>{PROSE}</article></section><footer>f</footer></article>": f"T\nby\n{TEXT}",
        f"<form id=aspnet><div role=navigation>n</div><article><p>One<script>var t='</p>';</script> two<!-- no --><style>p{{}}</style></p>{PROSE}</article></form>": f"One two\n{TEXT}",
        f"<article><p>x<b>y<p>z</b>w<ul><li>1<li>2</ul><table><tr><td>c<td>d</table>{PROSE}": f"xy\nzw\n1\n2\nc\nd\n{TEXT}",
        f"<article>{PROSE}</article><article class=teaser><p>More</p></article>": TEXT,
        f"<article>{PROSE}<div hidden>h</div><div style='display: none'>i</div><div aria-hidden=true>j</div><p>k</p></article>": f"{TEXT}\nk",
        "<p>only\n\t words</p>": "only words",
        "": "", "<html></html>": "", "<nav>n</nav>": "", "a & b": "a & b", "<article><p>x</p>": "x", "<": "<", "</p></div>": "",
    }
    for html, text in cases.items():
        assert html_text.main_text(html) == text, html
    assert html_text.main_text(None) == ""


def test_articles_count_by_their_content():
    found = html_text.main_text(f"<div class='post'>{PROSE * 3}</div><div class='more'><article><h3>Other story</h3></article></div>")
    assert found.startswith("\n".join([TEXT] * 3))
    found = html_text.main_text(f"<main><p>m</p></main><div><h1>T</h1>{PROSE * 4}</div>")
    assert found.endswith("\n".join(["T"] + [TEXT] * 4))
    parts = [f"<article><h2>Part {k}</h2>{PROSE * n}</article>" for k, n in enumerate((5, 1, 2))]
    assert html_text.main_text("".join(parts)).split("\n") == ["Part 0", *[TEXT] * 5, "Part 1", TEXT, "Part 2", TEXT, TEXT]


def test_content_overrules_names():
    for wrapper in ("class='layout sidebar-right'", "id='page' class='search-page'"):
        assert html_text.main_text(f"<div {wrapper}><article>{PROSE}</article><div class=sidebar>s</div></div>") == TEXT
        assert html_text.main_text(f"<div {wrapper}><div>{PROSE}</div><nav>n</nav></div>") == TEXT
    kept = f"<h2 id='discussion'>D</h2>{PROSE}<h3 id='related-work'>R</h3><section id='responses'>{PROSE}</section><p id='privacy'>p</p>"
    assert html_text.main_text(f"<article>{PROSE * 2}{kept}</article>") == "\n".join([TEXT, TEXT, "D", TEXT, "R", TEXT, "p"])
    assert html_text.main_text("<div class=widget><p>all there is</p></div>") == "all there is"
    assert html_text.main_text(f"<article>{PROSE}</article><div class=related><article>{PROSE}</article></div><div class=comments>{PROSE * 3}</div>") == TEXT


def test_nested_and_long_pages():
    assert html_text.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    long = "word " * 400_000
    assert html_text.main_text(f"<nav>n</nav><article><p>{long}</p></article>") == long.strip()
    many = "".join(f"<p>line {k}</p>" for k in range(20_000))
    assert html_text.main_text(f"<article>{many}</article>").count("\n") == 19_999


def test_pages_table(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x é</p>", "t", 5), (1, "u", "<p>x é</p>", "t", 5), (2, None, None, "t", 5), (None, "v", "", "t", 5)],
                                  "page_id long, url string, html string, text string, n_chars long")
    got = sorted((tuple(r) for r in html_text.extract(pages).collect()), key=str)
    assert got == sorted([(1, "u", "x é", 3), (1, "u", "x é", 3), (2, None, "", 0), (None, "v", "", 0)], key=str)
    assert html_text.extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize("markup", ["<![foo[ x ]]>", "<![>", "<![<b>", "<![CDATA[ x > y ]]>", "<!>", "<!DOCTYPE [ <!ENTITY>", "</>", "<?x>"])
def test_malformed_markup_is_a_comment(markup):
    text = html_text.main_text(f"<p>before it</p>{markup}<p>after it</p>")
    assert text.startswith("before it") and text.endswith("after it")


def test_any_markup_gives_a_text():
    pieces = ["<![", "<!", "]]>", "[", "]", "<!--", "-->", "<p>", "</p>", "<", ">", "</", "<?", "&#x;", "&amp", "CDATA[", "if", "temp[",
              "<script>", "</script>", "<b", " a='", "'", '"', "text", " ", "<article>", "\x00", "<!DOCTYPE", "<textarea>", "<title>"]
    r = random.Random(4)
    for _ in range(30_000):
        assert isinstance(html_text.main_text("".join(r.choices(pieces, k=r.randint(1, 12)))), str)
