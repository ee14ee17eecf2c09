"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams over a page. Its events give one line per block of text, with the tags that
stand in it. A line's ratio of text to tags is smoothed over its neighbours by a Gaussian; two clusters of the smoothed
ratios set a threshold, and the lines above it are content. The region is the element that holds them all: the innermost
article or main that does, else the innermost element. A line of the region that is below the threshold and mostly links
is a menu and goes, marked or not; a short heading or paragraph stays. Elements that a page itself marks as something else (menus,
headers, footers, sidebars, notices, adverts, forms, comments) are no candidates.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML by their use.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style noscript template iframe object svg math canvas audio video select datalist map textarea".split())
ASIDE = frozenset("nav header footer aside form dialog menu button fieldset".split())
BLOCK = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd table caption thead tbody tfoot tr "
    "td th blockquote pre figure figcaption address details summary center hr title".split()
)
CLOSES_P = BLOCK | ASIDE
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements adsense adbox adslot banner banners sponsor sponsored promo promos "
    "promotion nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars side widget widgets header masthead "
    "topbar footer foot cookie cookies consent gdpr notice notices alert popup popups modal overlay newsletter subscribe "
    "subscription signup login comment comments commentlist disqus reply replies respond discussion share sharing social "
    "related recommended pagination pager skip toolbar legal copyright disclaimer".split()
)
# Names that mean something else as part of a longer one count only as the whole class.
AMBIGUOUS = frozenset("side widget widgets legal related share copyright notice notices discussion".split())
WHOLE = AMBIGUOUS | frozenset("related-posts related-articles related-links legal-notice widget-area footer-widgets".split())
SLUGS = ("tag-", "category-", "cat-", "term-", "topic-")  # of an article's subjects, whatever they are
# An element of these names is no wrapper of the main text, however much it holds.
SURE = frozenset("ad ads advert adverts advertisement advertisements adsense adbox adslot comment comments commentlist disqus reply replies respond cookie cookies consent gdpr".split())
NOT_ASIDE = frozenset("has with without no not article main content".split())  # as in has-sidebar
HEAD_PARTS = frozenset("title meta link style script base noscript template".split())
NAME_PARTS = re.compile(r"[-_\d]+|(?<=[a-z])(?=[A-Z])")
SPACES = re.compile(r"\s+")
SIGMA, RADIUS = 1.0, 2
MENU = 0.6  # share of link text in a line below the threshold, from which on it is a menu


class Line:
    """A block's text, how many tags stood in it, how much of it is link text, and where it stands."""

    __slots__ = ("links", "path", "pieces", "tags")

    def __init__(self, path: tuple):
        self.pieces: list[str] = []
        self.tags = self.links = 0
        self.path = path


class Lines(HTMLParser):
    """Lines of a page, from parser events."""

    def __init__(self, forms: bool = False, names: bool = True, spared: frozenset[int] = frozenset()):
        """forms: a form is a candidate, for pages that stand in one; names: classes and ids shut elements, but not
        those in `spared`."""
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[tuple[str, int]] = []  # open elements; 2: hidden, 1: aside
        self.open: Counter[str] = Counter()  # how many of each tag are in the stack
        self.number = 0
        self.shut = 0  # depth of elements that are no candidates
        self.hidden = 0
        self.anchors = 0
        self.landmarks: set[int] = set()
        self.landmark = 0  # depth of article and main
        self.forms, self.names, self.spared = forms, names, spared
        self.named: list[tuple[int, int]] = []  # open elements that a name shuts: depth of the stack, number
        self.inside: dict[int, int] = {}  # by such element, the length of the text in it
        self.holds: set[int] = set()  # such elements with an article or main in them
        self.size = 0  # length of all text
        self.path: tuple = ()
        self.line: Line | None = None

    def cut(self) -> None:
        self.line = None

    def now(self) -> Line:
        if self.line is None:
            self.line = Line(self.path)
            self.lines.append(self.line)
        return self.line

    def handle_starttag(self, tag, attrs):
        if self.hidden == 1 and tag not in HEAD_PARTS and self.open["head"]:
            self.close_to("head")  # a head that was never closed
        if tag in CLOSES_P and self.open["p"] and any(t == "p" for t, _ in self.stack[-6:]):
            self.close_to("p")
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option") and self.stack and self.stack[-1][0] == tag:
            self.close_to(tag)
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            elif tag == "hr":
                self.cut()
            return
        kind = 0
        if tag in HIDDEN:
            kind = 2
        elif self.marked(tag, attrs):
            kind = 1
        self.number += 1
        if tag in ("article", "main"):
            self.holds.update(n for _, n in self.named)
        if not kind and self.names and tag not in ("html", "body", "main"):
            sure = self.by_name(tag, attrs)
            if sure is not None and self.number not in self.spared:
                kind = 1
                if not sure:
                    self.named.append((len(self.stack), self.number))
        self.stack.append((tag, kind))
        self.open[tag] += 1
        if tag in ("article", "main"):
            self.landmark += 1
            self.landmarks.add(self.number)
        self.hidden += kind == 2
        self.shut += kind == 1
        if tag == "a":
            self.anchors += 1
        if tag in BLOCK or tag in ASIDE:
            self.path = (*self.path, self.number)
            self.cut()
        elif not self.shut and not self.hidden:
            self.now().tags += 1

    def marked(self, tag, attrs) -> bool:
        """Whether its tag or role says that an element is a menu, header, footer, sidebar, notice or form."""
        if tag in ("html", "body", "main"):
            return False
        own = self.landmark > 0  # a header inside an article is the article's own
        if tag in ASIDE and not (tag == "header" and own) and not (tag == "form" and self.forms):
            return True
        for name, value in attrs:
            if name == "hidden":
                return True
            if name == "role" and value and not (tag == "form" and self.forms) and value.strip().lower() in ASIDE_ROLES:
                return True
        return False

    def by_name(self, tag, attrs) -> bool | None:
        """Whether a class or id says so for sure (True), or may say so (False); None: it doesn't.

        An article goes only by a whole class.
        """
        own = self.landmark > 0
        for name, value in attrs:
            if name not in ("class", "id") or not value or tag == "form" and self.forms:
                continue
            for one in value.split():
                plain = one.lower()
                if plain.startswith(SLUGS) or (own and name == "id" and plain == "discussion"):  # a part of a paper
                    continue
                words = {w.lower() for w in NAME_PARTS.split(one)}
                found = words & ASIDE_NAMES - AMBIGUOUS
                if plain in WHOLE:
                    found = {plain}
                elif tag == "article" and plain not in found:
                    continue
                if found and not words & NOT_ASIDE and not (own and found == {"header"}):
                    return tag == "article" or bool(found & SURE)
        return None

    def closed(self, kind: int) -> None:
        """The element at the end of the stack, or behind it, has closed."""
        self.hidden -= kind == 2
        self.shut -= kind == 1
        while self.named and self.named[-1][0] >= len(self.stack):
            self.named.pop()

    def close_to(self, tag) -> None:
        while self.stack:
            name, kind = self.stack.pop()
            self.open[name] -= 1
            self.closed(kind)
            self.anchors -= name == "a"
            self.landmark -= name in ("article", "main")
            if name in BLOCK or name in ASIDE:
                self.path = self.path[:-1]
                self.cut()
            if name == tag:
                return

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_data(" ")
        if self.open[tag]:
            # a formatting element's end doesn't close the blocks around it
            if tag not in BLOCK and tag not in ASIDE and tag not in HIDDEN:
                for i in range(len(self.stack) - 1, -1, -1):
                    name, kind = self.stack[i]
                    if name == tag:
                        self.anchors -= tag == "a"
                        del self.stack[i]
                        self.open[name] -= 1
                        self.shut -= kind == 1
                        self.named = [(d - (d > i), n) for d, n in self.named if d != i]
                        return
                    if name in BLOCK or name in ASIDE:
                        return
            self.close_to(tag)

    def handle_data(self, data):
        if not self.hidden and data:
            length = len(data.strip())
            self.size += length
            for _, number in self.named:
                self.inside[number] = self.inside.get(number, 0) + length
        if self.hidden or self.shut or not data:
            return
        if self.line is None and data.isspace():
            return
        line = self.now()
        line.pieces.append(data)
        if self.anchors:
            line.links += len(data)


def smooth(values: np.ndarray) -> np.ndarray:
    """Gaussian mean over the neighbours, the weights at the ends rescaled."""
    weights = np.exp(-(np.arange(-RADIUS, RADIUS + 1) ** 2) / (2 * SIGMA**2))
    full = np.convolve(values, weights)
    norm = np.convolve(np.ones(len(values)), weights)
    return (full / norm)[RADIUS : RADIUS + len(values)]


def threshold(values: np.ndarray) -> float:
    """Where two clusters of the values part (means of two clusters, iterated)."""
    low, high = float(values.min()), float(values.max())
    for _ in range(100):
        cut = (low + high) / 2
        below, above = values[values <= cut], values[values > cut]
        if not len(below) or not len(above):
            return cut if len(above) else low - 1.0
        new = float(below.mean()), float(above.mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def page_lines(html: str, **how) -> tuple[list[tuple[str, Line]], set[int]]:
    """Lines and landmarks. An element is not shut by a name if it holds an article or main, or most of the page's text."""

    def parsed(**more) -> Lines:
        parser = Lines(**how, **more)
        parser.feed(html)
        parser.close()
        return parser

    parser = parsed()
    spared = parser.holds | {n for n, size in parser.inside.items() if 2 * size > parser.size}
    if spared:
        parser = parsed(spared=frozenset(spared))
    texts = ((SPACES.sub(" ", "".join(line.pieces)).strip(), line) for line in parser.lines)
    return [(text, line) for text, line in texts if text], parser.landmarks


def main_text(html: str) -> str:
    """The main text of a page: its blocks in order, white space collapsed, joined by an empty line."""
    lines, landmarks = page_lines(html)
    if not lines and "<form" in html.lower():
        lines, landmarks = page_lines(html, forms=True)
    if not lines:
        lines, landmarks = page_lines(html, forms=True, names=False)
    if not lines:
        return ""
    ratio = np.array([max(0, len(t) - x.links) / (1 + x.tags) for t, x in lines])
    smoothed = smooth(np.log1p(ratio))
    content = smoothed > threshold(smoothed)
    held: dict[int, int] = {}  # by element, the length of content lines in it; elements are numbered from outside
    for (text, line), chosen in zip(lines, content, strict=True):
        if chosen:
            for number in line.path:
                held[number] = held.get(number, 0) + len(text)
    total = sum(len(t) for (t, _), chosen in zip(lines, content, strict=True) if chosen)
    region = max((n for n, size in held.items() if n in landmarks and size == total), default=0)
    if not region:
        sizes: dict[int, int] = {}
        for _, line in lines:
            for number in line.path:
                sizes[number] = sizes.get(number, 0) + 1
        region = max((n for n, size in held.items() if size == total and sizes[n] > 1), default=0)
    menu = [not chosen and x.links >= MENU * len(t) for (t, x), chosen in zip(lines, content, strict=True)]
    if region:
        return "\n\n".join(t for (t, x), out in zip(lines, menu, strict=True) if region in x.path and not out)
    at = np.flatnonzero(content)
    kept = slice(at[0], at[-1] + 1)
    return "\n\n".join(t for (t, _), out in zip(lines[kept], menu[kept], strict=True) if not out)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages (page_id, url, html).

    The whole page is parsed; a null or empty html, and a page without text, give an empty text. n_chars counts code
    points. page_id and url pass through, null or repeated. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column(2).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"]
            )

    plain = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.coalesce(F.col("html"), F.lit("")).alias("html")
    )
    return plain.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
