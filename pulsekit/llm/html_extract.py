"""Main text of web pages from streamed parser events.

The standard library's parser sends its events to ``PageReader``, which keeps
one line per block (text, tags met, length inside links, container) and never a
tree.  The text-to-tag ratio of the lines is smoothed with a Gaussian; lines
above a threshold between the two clusters of ratios are content seeds.  The
region is the smallest container that holds all seeds, or the outermost one that
is marked as main text; inside it every line stays but those in menus, notices,
forms and the like.  Neither a tag such as form or nav, which some pages put around
everything or never close, nor a role, a hidden mark, a class or an id makes an
element an aside that holds most of the page's seed text, where no article or main
element stands beside it.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup html li main menu nav ol p pre search section summary
    table tbody td tfoot th thead tr ul""".split())
#: Elements that never hold main text.
NEVER = frozenset("""head title script style noscript template nav header footer aside form button select option
    textarea datalist iframe object svg canvas math audio video map dialog menu search""".split())
#: Of these, elements that some pages put around everything or never close: what they hold is judged by its mass.
WEIGHED = frozenset("form nav header footer aside menu search dialog button select".split())
#: Elements whose end tag is optional: what their start closes.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words of a class or id that mark what is not main text, and words that mark main text.
ASIDE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner
    sidebar menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments
    commentlist disqus reply replies respond cookie cookies consent gdpr notice notices notification alert popup
    modal overlay newsletter subscribe subscription signup login search searchbox share sharing social related
    recommended recommendations widget widgets toolbar pagination pager form skip copyright legal disclaimer
    print toc tags""".split())
MAIN_WORDS = frozenset("article content post entry main story body text page wrapper container layout".split())
ASIDE_ROLES = frozenset("""navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar
    toolbar""".split())
MAIN_ROLES = frozenset(["main", "article"])
NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
SPACES = re.compile(r"\s+")
SIGMA = 1.5


def is_aside(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Is this element never main text, by its tag?"""
    return tag in NEVER and tag not in WEIGHED


def is_named_aside(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Do the tag, a role, a hidden mark, a class or an id say that this element holds a menu, form, notice,
    advert, comments or the like?  So it does unless it holds most of the page's seed text."""
    if tag in WEIGHED:
        return True
    if tag in ("html", "body", "main", "article"):
        return False
    for key, value in attrs:
        mark = (value or "").strip().lower()
        if (key == "hidden" or key == "aria-hidden" and mark == "true" or key == "role" and mark in ASIDE_ROLES
                or key == "style" and "display:none" in mark.replace(" ", "")):
            return True
        if key in ("class", "id"):
            for name in (value or "").split():
                words = [w.lower() for w in NAME.findall(name)]
                if words and words[0] not in ("has", "with", "no", "without", "is") and \
                        not ASIDE_WORDS.isdisjoint(words) and words[-1] not in ("wrapper", "container", "layout", "page"):
                    return True
    return False


class Line:
    """``parts`` are (text, inside a link, numbers of the named asides around it)."""

    __slots__ = ("text", "tags", "menu", "path", "tag", "parts")

    def __init__(self, parts, tags, path, tag):
        self.text = SPACES.sub(" ", "".join(t for t, _, _ in parts)).strip()
        solid = [(len("".join(t.split())), link) for t, link, _ in parts]
        self.menu = 10 * sum(n for n, link in solid if link) >= 9 * sum(n for n, _ in solid)  # links alone
        self.parts, self.tags, self.path, self.tag = parts, tags, path, tag

    def outside(self, asides: set[int]) -> Line:
        """This line without what stands in the given asides."""
        parts = [p for p in self.parts if asides.isdisjoint(p[2])]
        return self if len(parts) == len(self.parts) else Line(parts, self.tags, self.path, self.tag)


class PageReader(HTMLParser):
    """Parser events -> lines.  ``path`` holds the numbers of the open containers."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, bool]] = []  # tag, number, aside, named aside
        self.aside = 0
        self.named: tuple[int, ...] = ()  # numbers of the open named asides
        self.lines: list[Line] = []
        self.parts: list[tuple[str, bool, tuple[int, ...]]] = []
        self.tags = self.links = self.count = 0
        self.kinds: list[tuple[str, bool, bool]] = []  # of containers: tag, marked as main, so by tag or role
        self.asides: list[bool] = []  # of named asides: also marked as main

    def flush(self) -> None:
        if not self.parts:
            return
        if any(t and not t.isspace() for t, _, _ in self.parts):
            path = tuple(x[1] for x in self.open if x[1] >= 0)
            tag = next((x[0] for x in reversed(self.open) if x[0] in BLOCK), "")
            self.lines.append(Line(self.parts, self.tags, path, tag))
        self.tags, self.parts = 0, []

    def close_last(self) -> None:
        _, _, aside, named = self.open.pop()
        self.aside -= aside
        if named:
            self.named = self.named[:-1]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
        self.tags += 1
        if tag == "br":
            self.handle_data(" ")
        if tag in VOID:
            return
        if tag in CLOSES:
            for k in range(len(self.open) - 1, -1, -1):
                name = self.open[k][0]
                if name in CLOSES[tag]:
                    while len(self.open) > k:
                        self.close_last()
                    break
                if name in BLOCK:
                    break
        elif tag in BLOCK:
            for k in range(len(self.open) - 1, -1, -1):
                name = self.open[k][0]
                if name == "p":
                    while len(self.open) > k:
                        self.close_last()
                    break
                if name in BLOCK:
                    break
        aside, named, number, marked = is_aside(tag, attrs), is_named_aside(tag, attrs), -1, False
        if tag in BLOCK:
            number, self.count = self.count, self.count + 1
            roles = {(v or "").lower() for k, v in attrs if k == "role"}
            names = {w for k, v in attrs if k in ("class", "id") for n in (v or "").split() for w in [n.lower()]}
            declared = tag in ("article", "main") or not roles.isdisjoint(MAIN_ROLES)
            marked = declared or not names.isdisjoint(MAIN_WORDS - {"page", "wrapper", "container", "layout", "body"})
            self.kinds.append((tag, marked, declared))
        if tag == "a":
            self.links += 1
        self.open.append((tag, number, aside, named))
        self.aside += aside
        if named:
            self.named = (*self.named, len(self.asides))
            self.asides.append(marked)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        self.tags += 1
        if tag == "a" and self.links:
            self.links -= 1
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                while len(self.open) > k:
                    self.close_last()
                break
            if self.open[k][0] in BLOCK and tag not in BLOCK:
                break  # an inline end tag closes nothing beyond its block

    def handle_data(self, data):
        if not self.aside:
            self.parts.append((data, self.links > 0, self.named))

    def finish(self) -> None:
        self.close()
        self.flush()


def read_lines(html: str) -> PageReader:
    reader = PageReader()
    reader.feed(html)
    reader.finish()
    return reader


def smoothed_ratios(lines: list[Line]) -> np.ndarray:
    """Characters per tag of each line, smoothed with a Gaussian over neighbouring lines."""
    ratio = np.array([len(x.text) / max(1, x.tags) for x in lines], float)
    reach = max(1, math.ceil(2 * SIGMA))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    padded = np.convolve(ratio, kernel)[reach:-reach]
    weight = np.convolve(np.ones_like(ratio), kernel)[reach:-reach]
    return padded / weight


def threshold(values: np.ndarray) -> float:
    """Middle of the two cluster means (2-means on a line, from the extremes); the least value if they are not apart."""
    low, high = float(values.min()), float(values.max())
    for _ in range(20):
        cut = (low + high) / 2
        below, above = values[values <= cut], values[values > cut]
        if not len(below) or not len(above):
            break
        new = float(below.mean()), float(above.mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2 if 2 * low < high else float(values.min())


def seeds(lines: list[Line]) -> list[int]:
    """Length of each line that is a content seed, 0 for the others and for lines of links alone."""
    ratios = smoothed_ratios(lines)
    cut = threshold(ratios)
    return [len(x.text) if r >= cut and not x.menu else 0 for x, r in zip(lines, ratios)]


def without_asides(page: PageReader) -> list[Line]:
    """The lines outside the named asides.

    An element around most of the seed text is none, unless it has no main word in its class or id and
    an article or main element with text stands beside it.
    """
    if not page.asides:
        return page.lines
    total, mass = 0, [0] * len(page.asides)
    for x, s in zip(page.lines, seeds(page.lines) if page.lines else ()):
        for text, _, inside in x.parts if s else ():
            total += len(text)
            for n in inside:
                mass[n] += len(text)

    def beside(n: int) -> bool:
        around, others = set(), set()
        for x in page.lines:
            declared = [c for c in x.path if page.kinds[c][2]]
            (around if any(n in p[2] for p in x.parts) else others).update(declared)
        return bool(others - around)

    asides = {n for n, m in enumerate(mass) if 2 * m <= total or not page.asides[n] and beside(n)}
    return [y for x in page.lines if (y := x.outside(asides)).text]


def main_lines(html: str | None) -> list[str]:
    page = read_lines(html or "")
    lines, kinds = without_asides(page), page.kinds
    if not lines:
        return []
    seed = seeds(lines)
    if links := not any(seed):  # a page of links: no line says more than another
        seed = [len(x.text) for x in lines]
    paths = [x.path for x, s in zip(lines, seed) if s]
    holds = set(paths[0]).intersection(*paths[1:])  # containers of one path: higher numbers are inside lower ones
    marked = [n for n in holds if kinds[n][1]]
    paragraphs = ("p", "li", "td", "th", "tr", "dd", "dt", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6")
    # a lone paragraph is no region
    region = min(marked) if marked else max((n for n in holds if kinds[n][0] not in paragraphs), default=-1)
    whole = region < 0 or kinds[region][0] in ("html", "body")
    out = []
    for x, s in zip(lines, seed):
        menu = (whole or links) and x.menu and (x.tag == "li" or not s and x.tag not in paragraphs)
        if (whole or region in x.path) and not menu:
            out.append(x.text)
    return out


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, ...) -> (page_id, url, text, n_chars), one row per page.

    ``text`` is the main text: blocks in page order joined by one line feed, white space inside a
    block turned into one space, character references decoded.  A null, empty or contentless html
    gives the empty text; broken markup is read as the parser finds it; null and repeated page ids
    and urls are kept; other columns are not read.
    """
    def extract(batches):
        for batch in batches:
            texts = ["\n".join(main_lines(h)) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
            .mapInArrow(extract, "page_id long, url string, text string, n_chars long"))
