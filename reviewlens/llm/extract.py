"""Operator 5: the main text of web pages by text-to-tag ratios.

The standard library's parser streams a page's events.  Text is gathered into
lines: one for each run of inline content between block tags (pages often have
no line breaks of their own).  Elements that are no content by their tag or
role (menus, headers, footers, asides, forms, scripts, styles) are left out
with all they hold, and so are those named as adverts, notices, sidebars or
reader comments, unless they wrap the body of the page.  A line's ratio is its
characters per tag; the logarithms of the ratios are smoothed with a Gaussian,
and lines above a threshold (the midpoint of two clusters' means) are chosen.

Where articles hold at least half of the chosen characters, their lines are the
text (all articles but those of a few characters or mostly links).  Elsewhere
the chosen lines are the text, completed to the lines beside them: those of a
container that holds chosen lines itself, those between two chosen ones, and
headings of what stays.  Lines of links with a ratio below the threshold go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0
#: share of the chosen characters that articles (or else the main element) hold to be the region
REGION_SHARE = 0.5
#: an article with a smaller share of the chosen characters is a teaser
ARTICLE_SHARE = 0.1
#: share of a line's or article's characters in links that makes it a list of links
LINK_SHARE = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: elements that are never content
NO_CONTENT = frozenset("nav header footer aside form script style noscript template title button select option textarea input iframe object canvas svg menu dialog applet audio video map math".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: words of class and id names of reader comments, and of other things that are no content
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
NAMES = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu
breadcrumb breadcrumbs sidebar aside rail header masthead footer cookie cookies consent gdpr notice notices notification alert popup modal overlay
share sharing social related recommended recommendations newsletter subscribe signup login search widget pagination pager toolbar""".split())
#: names that begin so tell what an element has or lacks, not what it is
STATES = frozenset("has no with without is".split())
#: with one of these a header's name is that of the article's own head
OWN = frozenset("article post entry story main content".split())
SECTIONS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: these hold a line or so each: no regions
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre figcaption caption blockquote ul ol dl figure summary address hgroup".split())
#: a start tag that ends an open element of these kinds
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


#: what an element is by its tag, role and names
CONTENT, LEFT_OUT, NAMED, COMMENT = range(4)


def kind_of(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    if tag in NO_CONTENT:
        return LEFT_OUT
    if tag in ("html", "body"):
        return CONTENT
    if any(k == "role" and v and v.strip().lower() in ROLES for k, v in attrs):
        return LEFT_OUT
    names = [[p.lower() for p in _NAME_PARTS.findall(name)] for k, v in attrs if v and k in ("class", "id") for name in v.split()]
    names = [set(parts) for parts in names if parts and not (parts[0] in STATES and len(parts) > 1)]
    if tag in SECTIONS:  # comments may be articles; other names belong to the article's own looks
        return COMMENT if any(x & COMMENTS for x in names) and not any(x & OWN for x in names) else CONTENT
    if any(x & COMMENTS for x in names):
        return COMMENT
    for x in names:
        found = x & NAMES
        if found and not (x & OWN and found <= {"header"}):
            return NAMED
    return CONTENT


class Line:
    __slots__ = ("text", "tags", "path", "links", "linked", "tag")

    def __init__(self, text: str, tags: int, path: tuple[int, ...], links: int, linked: int, tag: str):
        self.text, self.tags, self.path, self.links, self.linked, self.tag = text, tags, path, links, linked, tag


class PageParser(HTMLParser):
    """Lines of a page, each with its tags and the containers (numbers) that hold it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # tag, number, left out with all it holds
        self.out = 0  # open elements that are left out
        self.named: dict[int, int] = {}  # containers that may be left out by their names -> NAMED or COMMENT
        self.in_link = False
        self.links = self.linked = 0  # of the open line: links, characters in them
        self.n_open: dict[str, int] = {}  # by tag
        self.kinds: list[str] = []
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = 0

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not asked for

    def end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                blocks = [(t, n) for t, n, _ in self.open if t not in INLINE]
                self.lines.append(Line(text, self.tags, tuple(n for _, n in blocks), self.links, self.linked, blocks[-1][0] if blocks else ""))
            self.parts.clear()
        self.tags = self.links = self.linked = 0

    def pop(self, keep: int) -> None:
        while len(self.open) > keep:
            tag, _, left = self.open.pop()
            self.out -= left
            self.n_open[tag] -= 1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in INLINE:
            self.tags += 1
            if tag == "br":
                self.parts.append(" ")
            elif tag == "a":
                self.in_link = True
                self.links += not self.out
        else:
            self.end_line()
            if tag in SECTIONS and self.out:  # a menu or header that was not closed ends here
                first = next(i for i, e in enumerate(self.open) if e[2])
                if self.open[first][0] in ("nav", "header"):
                    self.pop(first)
            ends = ENDED_BY.get(tag)
            if ends and self.open and self.open[-1][0] in ends or self.open and self.open[-1][0] == "p":
                self.pop(len(self.open) - 1)
            self.tags = 1
        if tag not in VOID:
            kind = kind_of(tag, attrs) if attrs or tag in NO_CONTENT else CONTENT
            left = kind == LEFT_OUT or kind != CONTENT and tag in INLINE
            if kind in (NAMED, COMMENT) and not left:
                self.named[len(self.kinds)] = kind
            if left or tag not in INLINE:  # other inline elements hold nothing that matters here
                self.kinds.append(tag)
                self.open.append((tag, len(self.kinds) - 1, left))
                self.out += left
                self.n_open[tag] = self.n_open.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in INLINE:
            self.tags += 1
            self.in_link = self.in_link and tag != "a"
        else:
            self.end_line()
            if self.n_open.get(tag, 0):  # else it was never opened
                i = len(self.open) - 1
                while self.open[i][0] != tag:
                    i -= 1
                self.pop(i)
            return
        if self.open and self.open[-1][0] == tag:
            self.pop(len(self.open) - 1)

    def handle_data(self, data: str) -> None:
        if not self.out:
            self.parts.append(data)
            if self.in_link:
                self.linked += len(data)

    def close(self) -> None:
        if self.rawdata and (m := re.search(r"<[a-zA-Z/!?][^>]*\Z", self.rawdata)):
            self.rawdata = self.rawdata[: m.start()]  # the page ends within a tag
        super().close()
        self.end_line()


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    r = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel)[r:len(ratio) + r]
    return np.convolve(ratio, kernel)[r:len(ratio) + r] / weight


def threshold(x: np.ndarray) -> float:
    """Midpoint of two clusters' means (two-means from the extremes)."""
    lo, hi = float(x.min()), float(x.max())
    x = np.sort(x)
    total = np.append(0.0, np.cumsum(x))
    for _ in range(50):
        k = int(np.searchsorted(x, (lo + hi) / 2))
        if k == 0:
            return lo
        new = float(total[k] / k), float((total[-1] - total[k]) / max(1, len(x) - k))
        if new == (lo, hi):
            break
        lo, hi = new
    return (lo + hi) / 2


def held_by(lines: list[Line]) -> dict[int, int]:
    """Container -> characters of the lines in it."""
    held: dict[int, int] = {}
    for x in lines:
        for c in x.path:
            held[c] = held.get(c, 0) + len(x.text)
    return held


def unnamed_lines(lines: list[Line], kinds: list[str], named: dict[int, int]) -> list[Line]:
    """Without the lines of containers that their names leave out.

    Such a container stays where it wraps the page's body whatever its name
    says: it is no list of comments, holds most characters, and has in it an
    article, the main element or the first-level heading, or at least three
    paragraphs where no article or main element is outside.
    """
    if not named:
        return lines
    held = held_by(lines)
    total = sum(len(x.text) for x in lines)
    left = set()
    for c, kind in named.items():
        stays = False
        if kind == NAMED and 2 * held.get(c, 0) > total:
            inside = [x for x in lines if c in x.path]
            within = {kinds[n] for x in inside for n in x.path[x.path.index(c):]}
            outside = {kinds[n] for x in lines if c not in x.path for n in x.path}
            stays = bool(within & {*SECTIONS, "h1"}) or sum(x.tag == "p" for x in inside) >= 3 and not outside & SECTIONS
        if not stays:
            left.add(c)
    return [x for x in lines if left.isdisjoint(x.path)]


def content_lines(lines: list[Line], kinds: list[str], named: dict[int, int] | None = None, sigma: float = SIGMA) -> list[Line]:
    """The lines of the page's main text."""
    lines = unnamed_lines(lines, kinds, named or {})
    if not lines:
        return []
    ratio = np.log1p([len(x.text) / max(1, x.tags) for x in lines])
    smooth = smoothed(ratio, sigma)
    at = threshold(smooth)
    chosen = smooth >= at
    links = [x.links > 1 and x.linked >= LINK_SHARE * len(x.text) and r < at for x, r in zip(lines, ratio, strict=True)]
    held = held_by([x for x, c in zip(lines, chosen, strict=True) if c])
    total = sum(len(x.text) for x, c in zip(lines, chosen, strict=True) if c)

    linked: dict[int, int] = {}
    for x in lines:
        for c in x.path:
            linked[c] = linked.get(c, 0) + x.linked
    text = held_by(lines)
    articles = {c for c in held if kinds[c] == "article" and held[c] >= ARTICLE_SHARE * total and linked[c] < LINK_SHARE * text[c]}
    if sum(len(x.text) for x, c in zip(lines, chosen, strict=True) if c and not articles.isdisjoint(x.path)) >= REGION_SHARE * total and articles:
        return [x for x, out in zip(lines, links, strict=True) if not out and not articles.isdisjoint(x.path)]

    teasers = {c for c in text if kinds[c] == "article"} - articles
    mains = {c for c in held if kinds[c] == "main" and held[c] >= REGION_SHARE * total}
    region = [i for i, x in enumerate(lines) if not links[i] and teasers.isdisjoint(x.path) and (not mains or not mains.isdisjoint(x.path))]
    n_lines: dict[int, int] = {}
    for x in lines:
        for c in x.path:
            n_lines[c] = n_lines.get(c, 0) + 1
    own, up = [], []  # a line's container, and the one that holds more than this line
    for x in lines:
        holders = [c for c in x.path if kinds[c] not in LEAVES]
        own.append(holders[-1] if holders else -1)
        up.append(next((c for c in reversed(holders) if n_lines[c] > 1), -1))
    direct = {own[i] for i in region if chosen[i] and kinds[own[i]] not in ("html", "body")} if kinds else set()
    keep = {i for i in region if chosen[i] or own[i] in direct}
    last: dict[int, int] = {}  # container -> place in region of its last chosen line
    for k, i in enumerate(region):
        if chosen[i]:
            if up[i] in last:
                keep.update(j for j in region[last[up[i]]:k] if up[j] == up[i])
            last[up[i]] = k
    for i, after in zip(reversed(region[:-1]), reversed(region[1:]), strict=True):
        if lines[i].tag in HEADINGS and after in keep:
            keep.add(i)
    return [lines[i] for i in sorted(keep)]


def main_text(html: str | None) -> str:
    parser = PageParser()
    parser.feed(html or "")
    parser.close()
    return "\n".join(x.text for x in content_lines(parser.lines, parser.kinds, parser.named))


def extract_pages(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of pages, text and n_chars (code points) of each row.

    A null page counts as empty: text '' and 0, as for a page without content.
    Pages that end early give the text as far as it goes.  Each of repeated
    rows gets its row; other columns are not read.
    """
    rows = pages.select(F.col(html_col).cast("string").alias("_html"), *keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]] + ["text string", "n_chars long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [main_text(x) for x in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [*keep, "text", "n_chars"])

    return rows.mapInArrow(run, schema)
