"""Main text of web pages by text-to-tag ratio (operator 4)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.llm.common import table

#: Deviation of the Gaussian that smooths the ratios, in lines.
SIGMA = 1.0

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a line.
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
search section summary table tbody td tfoot th thead title tr ul""".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that are never part of the article.
LEFT_OUT = set("""applet aside audio button canvas datalist dialog embed footer form frame frameset head iframe
input label map menu nav noembed noframes noscript object script search select style svg template textarea title
video""".split())
#: ARIA roles that aren't either.
ROLES = set("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status
tablist toolbar tooltip""".split())
#: Words in class or id that name what isn't part of the article.
NAMES = set("""ad ads adsense adslot advert adverts advertisement advertisements advertising advertorial
aside banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright
dialog disqus discussion feedback footer form gdpr header login masthead menu menus modal nav navbar navigation
newsletter notice notices notification notifications outbrain pager pagination paywall popup privacy promo promos promoted
promotion recommended recommendations related replies reply respond responses search share sharing sidebar
signin signup skip social sponsor sponsored sponsors subscribe subscription taboola teaser teasers toolbar widget
widgets""".split())
COMMENTS = set("comment comments commentlist disqus discussion replies reply respond responses".split())
#: Of these, the ones that an article's own sections are named by as well.
SECTIONS = set("discussion notice notices notifications privacy promotion recommendations related responses search sharing social".split())
#: Before or after these words a name says what the page's frame has, not what the element is.
ABOUT = {"has", "no", "with", "without"}
#: Start tags that end an open element, and where the search for it stops.
ENDS = {
    "p": (BLOCK - {"body", "html", "option", "optgroup", "title"}, BLOCK - {"p"}),
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th", "tr", "tbody", "tfoot"}, {"table"}),
    "th": ({"td", "th", "tr", "tbody", "tfoot"}, {"table"}),
    "tr": ({"tr", "tbody", "tfoot"}, {"table"}),
    "option": ({"option", "optgroup"}, {"select", "datalist"}),
}
_IN_HEAD = set("base basefont bgsound head html link meta noscript script style template title".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _words(attrs: dict[str, str | None], *names: str) -> set[str]:
    return {w.lower() for k in names or ("class", "id") for w in _WORDS.findall(attrs.get(k) or "")}


class Lines(HTMLParser):
    """The page's lines from parser events: text, tags since the last line, place.

    A place is an element's number; ``up`` has the element around it, and
    ``article`` and ``main`` the outermost such element around it (0: none).
    ``named`` has what class or id name as something else than the article,
    with how the name may be overruled; such elements' lines are in ``lines``,
    as parts of text and their places, until ``kept`` leaves them out.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int]] = [("", 0)]
        self.up, self.article, self.main = [0], [0], [0]
        self.lines: list[tuple[list[tuple[str, int]], int, int, bool]] = []
        self.text: list[tuple[str, int]] = []
        self.named: dict[int, str] = {}
        self.tags = 0
        #: Number of open elements below the one that is left out, if one is.
        self.out: int | None = None

    def _end_line(self) -> None:
        text, self.text = self.text, []
        if any(not t.isspace() for t, _ in text):
            self.lines.append((text, self.tags, self.open[-1][1], any(t in HEADINGS for t, _ in self.open[-2:])))
            self.tags = 0

    def _pop(self, at: int) -> None:
        if any(t in BLOCK for t, _ in self.open[at:]):
            self._end_line()
        del self.open[at:]
        if self.out is not None and len(self.open) <= self.out:
            self.out = None

    def _left_out(self, tag: str, attrs: dict[str, str | None]) -> bool:
        role, words = (attrs.get("role") or "").lower(), _words(attrs)
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(
            r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style") or "", re.I)
        if tag in ("html", "body"):
            return False
        if tag in ("article", "main"):
            return bool(hidden)
        if tag == "header":
            # an article's own header holds its title
            return not self.article[self.open[-1][1]]
        return bool(tag in LEFT_OUT or hidden or role in ROLES)

    def _name(self, tag: str, attrs: dict[str, str | None]) -> str:
        """How an element's name, if it says that this isn't the article, may be overruled; else an empty text."""
        words, inside = _words(attrs), self.article[self.open[-1][1]] or self.main[self.open[-1][1]]
        if tag in HEADINGS or (tag == "p" and inside):
            words = _words(attrs, "class")
        if tag in ("html", "body", "header") or words & ABOUT and not (tag in ("article", "main") and words & COMMENTS):
            return ""
        if words & {"header", "masthead"} and (tag in HEADINGS or self.article[self.open[-1][1]]):
            words -= {"header", "masthead"}
        if tag == "section" and inside and words & NAMES and words & NAMES <= SECTIONS and not _words(attrs, "class") & NAMES:
            return "section"
        return "comments" if words & COMMENTS else "name" if words & NAMES else ""

    def outer(self, overruled: set[int]) -> list[int]:
        """For each element the outermost named one around it that isn't overruled, 0 if there is none."""
        out = [0] * len(self.up)
        for e in range(1, len(out)):
            out[e] = out[self.up[e]] or (e if e in self.named and e not in overruled else 0)
        return out

    def kept(self, outer: list[int]) -> list[tuple[str, int, int, bool]]:
        """The lines outside named elements; tags of the others count for the next line."""
        out, before = [], 0
        for parts, tags, place, heading in self.lines:
            before += tags
            text = " ".join("".join([t for t, e in parts if not outer[e]]).split())
            if text:
                out.append((text, before, place, heading))
                before = 0
        return out

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag in VOID:
            if tag in ("br", "hr"):
                self.handle_data(" ") if tag == "br" else self._end_line()
            return
        if len(self.open) > 1 and any(t == "head" for t, _ in self.open[:4]) and tag not in _IN_HEAD:
            self._pop(next(k for k, (t, _) in enumerate(self.open) if t == "head"))
        for name, (starts, stops) in ENDS.items():
            if tag in starts:
                for k in range(len(self.open) - 1, 0, -1):
                    if self.open[k][0] == name:
                        self._pop(k)
                        break
                    if self.open[k][0] in stops:
                        break
        if tag in BLOCK:
            self._end_line()
        if tag in ("article", "main") and self.out is not None and self.open[self.out][0] == "form":
            # a form around the whole page
            self.out = None
        here, around = len(self.up), self.open[-1][1]
        gone = self.out is None and self._left_out(tag, dict(attrs))
        name = "" if gone or self.out is not None else self._name(tag, dict(attrs))
        if name:
            self.named[here] = name
        self.up.append(around)
        self.article.append(self.article[around] or (here if tag == "article" and not gone and name != "comments" else 0))
        self.main.append(self.main[around] or (here if not gone and name != "comments" and (tag == "main" or dict(attrs).get("role") == "main") else 0))
        if gone:
            self.out = len(self.open)
        self.open.append((tag, here))

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                self._pop(k)
                return
            if tag not in BLOCK and self.open[k][0] in BLOCK:
                return

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![...`` is a comment up to the next ``>``, as in browsers; the page's end closes it too."""
        end = self.rawdata.find(">", i + 3)
        return len(self.rawdata) if end < 0 else end + 1

    def handle_data(self, data: str) -> None:
        if self.out is None:
            self.text.append((data, self.open[-1][1]))

    def close(self) -> None:
        super().close()
        self._end_line()


def _content(lines: list[tuple[str, int, int, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """Which lines are content (smoothed text-to-tag ratio of at least its deviation over the page), and which without their neighbours."""
    ratio = np.array([len(text) / max(1, tags) for text, tags, _, _ in lines])
    reach = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel)[reach: reach + len(ratio)]
    smooth = np.convolve(ratio, kernel)[reach: reach + len(ratio)] / weight
    least = min(smooth.std(), smooth.max())
    return smooth >= least, (smooth >= least) & (ratio >= least)


def _overruled(page: Lines) -> set[int]:
    """Named elements that stay: their content says that they are, or hold, the article.

    Those are an element with most of the page's content; one that holds the
    page's only articles or main elements and as much content as the rest; a
    section of an article with content whose id is an everyday word.  Comments
    stay only if they hold the page's only articles.
    """
    out: set[int] = set()
    if not page.named:
        return out
    whole = page.kept([0] * len(page.up))
    content, _ = _content(whole) if whole else (np.zeros(0, bool), None)
    while True:
        outer = page.outer(out)
        held: dict[int, int] = {}
        holds, found = set(), set()
        for (text, _, place, _), c in zip(whole, content):
            e = outer[place]
            held[e] = held.get(e, 0) + (len(text) if c else 0)
            if page.article[place] or page.main[place]:
                holds.add(e)
        for e, n in held.items():
            if e and n and (page.named[e] == "section" or (page.named[e] == "name" and 2 * n > sum(held.values()))
                            or (e in holds and 0 not in holds and n >= held.get(0, 0))):
                found.add(e)
        if not found:
            return out
        out |= found


def main_text(html: str | None) -> str:
    """The page's article, a line for each of its blocks.

    The content lines select the region: the outermost articles, if they hold
    most of the content lines' text, but for those without a line that is
    content by itself; else the same of main elements; else the smallest
    element around all content lines and the headings right before it.  All lines of the region stay,
    the short ones too, but for what markup names as something else: menus,
    headers, footers, sidebars, notices, adverts, forms, comments and the
    like.  Names by class or id count less than content (``_overruled``), and
    not at all if nothing else is left.  Null, empty and text-free pages give
    an empty text.
    """
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.close()
    lines = page.kept(page.outer(_overruled(page))) or page.kept([0] * len(page.up))
    if not lines:
        return ""
    content, alone = _content(lines)
    total = sum(len(line[0]) for line, c in zip(lines, content) if c)
    for around in (page.article, page.main):
        held: dict[int, int] = {}
        full = set()
        for (text, _, place, _), c, own in zip(lines, content, alone):
            if around[place]:
                held[around[place]] = held.get(around[place], 0) + (len(text) if c else 0)
                if own:
                    full.add(around[place])
        if held and 2 * sum(held.values()) >= total:
            full.add(max(held, key=held.get))
            return "\n".join(t for t, _, place, _ in lines if around[place] in full)
    return "\n".join(t for t, _, _, _ in _region(page, lines, content))


def _region(page: Lines, lines: list, content: np.ndarray) -> list:
    """Lines inside the smallest element around all content lines, and headings right before them."""
    seeds = np.flatnonzero(content)
    # an element holds the places numbered from its own to its last descendant's
    last = list(range(len(page.up)))
    for e in range(len(page.up) - 1, 0, -1):
        last[page.up[e]] = max(last[page.up[e]], last[e])
    root, low, high = lines[seeds[0]][2], min(lines[s][2] for s in seeds), max(lines[s][2] for s in seeds)
    while root and not (root <= low and high <= last[root]):
        root = page.up[root]
    inside = [k for k, line in enumerate(lines) if root <= line[2] <= last[root]]
    first = inside[0]
    while first and lines[first - 1][3]:
        first -= 1
    return [line for k, line in enumerate(lines) if k in range(first, inside[0]) or root <= line[2] <= last[root]]


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``; other columns are ignored.

    Repeated rows each keep their row; no rows give no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
