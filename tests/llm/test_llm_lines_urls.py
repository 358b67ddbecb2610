"""Operators 3 and 10 against plain versions."""

from __future__ import annotations

import time
from collections import Counter, defaultdict

from hypercube.llm import line_dedup, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, host string, h1 long, __drop string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "h", 1, "d") for i, t, s in rows], DOCS)


def _dropped(rows, ratio=line_dedup.RATIO, least=line_dedup.MIN_PAGES):
    pages, holds = Counter(s for _, _, s in rows), defaultdict(Counter)
    for _, t, s in rows:
        for line in {x.strip(" ") for x in (t or "").split("\n") if t is not None} - {""}:
            holds[s][line] += 1
    bad = {s: {x for x, n in c.items() if n >= least and n > ratio * pages[s]} for s, c in holds.items()}
    return [(i, None if t is None else "\n".join(x for x in t.split("\n") if x.strip(" ") not in bad.get(s, ())), s) for i, t, s in rows]


def test_lines_as_in_plain_python(spark):
    rows = [(i, f"own {i}\nfooter\n\n  rare {i % 40}\nfooter ", "a" if i % 3 else None) for i in range(150)]
    rows += [(200 + i, "footer\nonly", "b") for i in range(4)] + [(300 + i, "all\nall", "c") for i in range(6)]
    rows += [(400, None, "a"), (401, "", "a"), (402, "footer\n" + "x" * 200_000 + "\nfooter", "a"), (None, "footer\nz", "a")]
    rows += [(5, "own 5\nfooter", "a")] * 2
    docs = _docs(spark, rows)
    out = line_dedup.drop_boilerplate(docs)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"], r["source"]) for r in out.collect()), key=str)
    assert got == sorted(_dropped(rows), key=str)
    assert (300, "", "c") in got and (200, "", "b") in got


def test_small_hosts_by_the_ratio(spark):
    """A footer on all 4 pages of a host, a line on 4 of 50 pages, a line on 2 of 50 and lines of one page."""
    rows = [(i, f"a {i}\nfooter", "four") for i in range(4)] + [(100, "lone\nlone", "one")]
    rows += [(200 + i, f"b {i}" + ("\nnotice" if i < 4 else "") + ("\nseldom" if 10 <= i < 12 else ""), "fifty") for i in range(50)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_boilerplate(_docs(spark, rows)).collect()}
    assert got[0] == "a 0" and got[100] == "lone\nlone" and got[200] == "b 0" and got[210] == "b 10\nseldom"
    assert got == {i: t for i, t, _ in _dropped(rows)}


def test_lines_of_an_empty_table(spark):
    assert line_dedup.drop_boilerplate(_docs(spark, [])).collect() == []


def _verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p) and (host or path)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


URLS = [None, "", "no scheme", "http://", "http://example.org", "https://EXAMPLE.org/es/x?y#z", "http://a.b.example.org/en/12",
        "http://example.org/en/2", "http://xexample.org/es/", "http://x.com/fr/", "http://x.com/de/#", "http://com/de/1", "http://x.net/de/",
        "http://u@x.com:80/de/", "http://x.org?/es/", "http://x.org#/", "a://b://c.org/", "http://É.com/fr/é", "http://..com/fr/",
        "http://x.com/fr\n/", "http://x.com/fr/\nb?c", "http://" + "a." * 300 + "com/de/" + "y" * 50_000, "http:///es/"]


def test_urls_as_in_plain_python(spark):
    pages = spark.createDataFrame([(i, u, "v", "r") for i, u in enumerate(URLS + URLS)], "page_id long, url string, verdict string, digest string")
    for rules in (list(url_filter.RULES), [("a.com", "/b", "block"), ("com", "/bcd", "allow"), ("com", "/de/", "allow"), ("com", "/de/", "block"),
                                          ("example.org", "/es/", "allow"), ("", "/es/", "block"), ("x.org", "", "block")]):
        out = url_filter.judged(pages, url_filter.rule_table(spark, rules))
        got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
        assert got == {(i, *_verdict(u, rules)) for i, u in enumerate(URLS + URLS)}
        assert out.columns == ["page_id", "url", "digest", "host", "path", "rule", "verdict"]


def test_very_long_hosts(spark):
    urls = ["http://" + "a." * n + end for n in (20_000, 100_000) for end in ("com/de/", "example.org/es/", "net/fr/")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    began = time.monotonic()
    got = {r["page_id"]: r["rule"] for r in url_filter.judged(pages, url_filter.rule_table(spark)).collect()}
    assert got == {i: _verdict(u, list(url_filter.RULES))[2] for i, u in enumerate(urls)}
    assert time.monotonic() - began < 30


def test_urls_without_rules_or_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [r["verdict"] for r in url_filter.judged(pages, none).collect()] == ["allow"]
    assert url_filter.judged(pages.limit(0), url_filter.rule_table(spark)).collect() == []
    broken = spark.createDataFrame([(None, "/", "block"), ("org", None, "block"), ("org", "/", None)], "host string, path string, verdict string")
    assert [r["rule"] for r in url_filter.judged(pages, broken).collect()] == [None]
