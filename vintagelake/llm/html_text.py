"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's streaming parser turns a page into blocks: a block ends
where a block element begins or ends, and is one line of the page for what
follows, with the number of its text characters and of the tags in it
(those that only format words are not counted).  Scripts, styles, controls and
hidden parts give no line.

The lines' text-to-tag ratios are smoothed with a Gaussian kernel over the whole
page.  Lines above a threshold taken from their spread are clustered into
regions, on every page.  Lines of menus, headers, footers, sidebars and forms,
and of elements whose class, id or role names an advert, notice, comment section
or the like, weigh nothing.  Three checks follow:

* Short lines (titles, last lines) beside a region, in the same container, join it,
  links excepted; ``article`` and ``main`` are such containers, links included.
* On a page with marked articles (``article``, ``main``), an unmarked region goes if it has
  less than ``LONG`` characters and less than half of what regions have in the
  articles; so do the articles, if they have less than ``LONG`` and less than a quarter of
  the regions outside.
* An article that is itself named as an advert, a comment or the like counts only
  on a page with no other text.

Defined results: null, empty or textless html gives an empty text; character
references are decoded; white space in a block (a line break included) becomes one
space; blocks are joined by one newline in page order; nothing is cut.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import ship

# Elements of HTML by their part in a page.
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup
option p pre section select summary table tbody td textarea tfoot th thead title tr ul""".split())
SILENT = set("""head script style noscript template button select textarea svg iframe object canvas dialog title audio
video""".split())
SKIPPED = SILENT | {"nav", "header", "footer", "aside", "form", "menu"}
MARKS = {"article", "main"}
CONTAINERS = MARKS | set("body div section details fieldset html".split())
LONG = 200  # characters: a few sentences
INLINE = set("""abbr b bdi bdo big br cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike
strong sub sup time tt u var wbr""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# an element that is opened inside one of its kind ends it, as do these inside p
NO_NESTING = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
ENDS_P = BLOCKS - {"body", "html", "head", "caption", "tbody", "thead", "tfoot", "tr", "td", "th", "option", "optgroup",
                   "title", "legend", "summary", "figcaption"}
# names (or hyphened parts of names) in class and id
BOILERPLATE = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|popup|modal|newsletter|subscribe"
    r"|comments?|commentlist|disqus|replies|respond|sidebar|side-?bar|widget|menu|nav|navbar|navigation|breadcrumbs?"
    r"|footer|masthead|related|recommended|share|sharing|social|pagination|pager|login|signup|search)(?:$|[_-])"
    r"|^(?:site|page|top|main)?[_-]?header$", re.I)
STATES = re.compile(r"(?:has|no|with|without|is)[_-]", re.I)  # names that only tell what the page has
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "alert", "dialog"}
WHITE = re.compile(r"\s+")


class Line(NamedTuple):
    text: str
    tags: int
    links: int  # characters inside links
    named: bool  # in a part that never holds the article
    doubted: bool  # in an article with the name of such a part
    article: int  # number of the outermost marked article around it, or 0
    container: int  # number of the innermost container, 0 for the page


class Open(NamedTuple):
    tag: str
    skips: bool
    silent: bool
    doubted: bool
    article: int
    container: int


class Blocks(HTMLParser):
    """Collects lines while parser events come in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Open] = []
        self.names: Counter[str] = Counter()  # of the open elements
        self.skipping = self.silent = self.doubted = self.in_links = self.opened = 0
        # of lines in parts that may hold the article, and in those that never do
        self.text: tuple[list[str], list[str]] = ([], [])
        self.tags, self.links = [0, 0], [0, 0]

    @staticmethod
    def names_boilerplate(label: str) -> bool:
        return any(BOILERPLATE.search(name) and not STATES.match(name) for name in label.split())

    def end_block(self):
        for named in (0, 1):
            text = WHITE.sub(" ", "".join(self.text[named])).strip()
            if text:
                last = self.open[-1] if self.open else Open("", False, False, False, 0, 0)
                self.lines.append(Line(text, self.tags[named], self.links[named], bool(named), self.doubted > 0,
                                       last.article, last.container))
                self.tags[named] = 0
            self.text[named].clear()
            self.links[named] = 0

    def count_tag(self, tag: str):
        if not self.silent and tag not in INLINE:
            self.tags[self.skipping > 0] += 1

    def pop_to(self, i: int):
        for was in reversed(self.open[i:]):
            self.skipping -= was.skips
            self.silent -= was.silent
            self.doubted -= was.doubted
            self.in_links -= was.tag == "a"
            self.names[was.tag] -= 1
        del self.open[i:]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.end_block()
        elif tag == "br":
            self.text[self.skipping > 0].append(" ")
        if tag in VOID:
            return
        # elements whose end may be left out
        if tag in NO_NESTING and self.names[tag] or tag in ENDS_P and self.names["p"]:
            for i in range(len(self.open) - 1, -1, -1):
                name = self.open[i].tag
                if name == tag and tag in NO_NESTING or name == "p" and tag in ENDS_P:
                    self.pop_to(i)
                    break
                if name in BLOCKS and name != "p":
                    break
        named = dict(attrs)
        outer = self.open[-1] if self.open else Open("", False, False, False, 0, 0)
        hidden = "hidden" in named or named.get("aria-hidden") == "true"
        # the header of an article is its headline, that of a page is not
        skips = tag in SKIPPED and not (tag == "header" and outer.article) or hidden
        doubted = False
        if not skips and tag not in ("html", "body"):
            label = f"{named.get('class') or ''} {named.get('id') or ''}"
            if tag in MARKS:
                doubted = any(BOILERPLATE.match(name) for name in label.split()) or named.get("role") in ROLES
            else:
                skips = self.names_boilerplate(label) or named.get("role") in ROLES
        silent = tag in SILENT or hidden
        self.opened += 1
        article = outer.article
        if tag in MARKS and not (article or doubted or self.doubted or self.skipping or skips):
            article = self.opened
        container = outer.container
        if tag in CONTAINERS:
            container = 0 if tag in ("body", "html") else self.opened
        self.names[tag] += 1
        self.open.append(Open(tag, skips, silent, doubted, article, container))
        self.skipping += skips
        self.silent += silent
        self.doubted += doubted
        self.in_links += tag == "a"
        self.count_tag(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # as in HTML, a slash at the end does not close an element

    def handle_endtag(self, tag):
        self.count_tag(tag)
        if tag in BLOCKS:
            self.end_block()
        if not self.names[tag]:  # an end without a beginning: nothing to look for
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                self.pop_to(i)
                break
            if self.open[i].skips and tag not in SKIPPED and tag not in BLOCKS:
                break  # a stray inline end does not close a skipped part

    def handle_data(self, data):
        if not self.silent:
            named = self.skipping > 0
            self.text[named].append(data)
            self.links[named] += len(data) if self.in_links else 0


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing; the kernel is scaled to what lies inside the page."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach: reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach: reach + len(ratios)] / weight


def regions(ratios: np.ndarray, sigma: float = 1.0, deviations: float = 1.5) -> np.ndarray:
    """Lines in a content region: those whose smoothed ratio reaches the threshold
    (``deviations`` below the mean) and whose own ratio half of it, so that a
    neighbour's ratio alone does not carry a line in, and lines between two of them."""
    if not len(ratios):
        return np.zeros(0, dtype=bool)
    level = smooth(ratios, sigma)
    threshold = min(level.mean(), max(level.mean() - deviations * level.std(), 0.15 * level.max()))
    content = (level >= threshold) & (ratios >= threshold / 2)
    at = np.flatnonzero(content)
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a <= 3:  # a gap of one or two lines belongs to the region around it
            content[a:b] = True
    return content


def chosen(lines: list[Line]) -> np.ndarray:
    """The lines of the main text: regions of smoothed ratios, then the checks."""
    size = np.array([len(line.text) for line in lines], dtype=float)
    weight = np.array([not line.named and not line.doubted for line in lines])
    if not weight.any():
        weight = np.array([not line.named for line in lines])
    ratios = weight * size / np.array([max(1, line.tags) for line in lines])
    if not weight.any():
        return weight
    core = regions(ratios) & weight
    core[ratios.argmax()] = True

    article = np.array([line.article for line in lines])
    container = np.array([line.container for line in lines])
    marked = article > 0
    inside = size[core & marked].sum()
    if inside:
        unmarked = np.flatnonzero(core & ~marked)
        # runs of unmarked lines: a marked line or a gap of three others ends one
        ends = np.flatnonzero((np.diff(unmarked) > 3) | (np.diff(np.cumsum(marked)[unmarked]) > 0)) + 1
        for run in np.split(unmarked, ends):
            if size[run].sum() < min(LONG, inside / 2):
                core[run] = False
        if inside < min(LONG, size[core & ~marked].sum() / 4):
            core &= ~marked
    links = np.array([line.links for line in lines]) > size / 2
    beside = ~marked & ~links & (container > 0) & np.isin(container, container[core & ~marked])
    return core | weight & (beside | marked & np.isin(article, article[core & marked]))


def main_text(html: str | None) -> str:
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    parser.end_block()
    if not parser.lines:
        return ""
    return "\n".join(line.text for line, keep in zip(parser.lines, chosen(parser.lines), strict=True) if keep)


def extract(pages: DataFrame, html: str = "html", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    ship(pages.sparkSession)

    @F.pandas_udf("string")
    def text_of(source: pd.Series) -> pd.Series:
        return source.map(main_text)

    out = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"),
                       text_of(F.coalesce(pages[html], F.lit(""))).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
