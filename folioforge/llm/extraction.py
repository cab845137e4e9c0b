"""HTML extraction: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clusters.

The standard library's streaming parser turns a page into lines: a line ends
where a block element begins or ends and at a line break.  Each line has the
logarithm of its text-to-tag ratio: characters outside links for each tag.  A
landmark is markup that speaks against the text in it, so it counts as that many
tags more: an element, role or class name of menus, headers, footers, sidebars,
notices, adverts, forms and comments as ``FULL``, a class name of which only a part
says so as ``PART``; in an article or main element a line counts as ``RAISE``
characters longer.  The ratios are smoothed with a Gaussian over the lines' order;
the threshold is a share of the mean of the smoothed ratios, weighted by text
length.  A line is chosen if its smoothed ratio reaches the threshold and its own
ratio a part of it (under a whole landmark, also ``WHOLE``).  A container (the nearest division, list or table cell) of which
the chosen lines hold most of the text is one cluster with them: its other lines
join, but for those that are mostly links or under a whole landmark.

Nulls and edges: a null or empty page gives an empty text; markup without text
gives an empty text; unclosed elements end with the element around them, and a
menu or form that is still open ends where an article or main element begins; an
unfinished tag, comment or declaration takes what follows it with it.  The work
grows in proportion to the page, however deep its elements are nested.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What is in these is no text of the page.
SKIP = frozenset("head title script style noscript template select textarea button iframe object svg canvas".split())
#: Elements, roles and words of classes and ids whose lines are lowered.
LOWERED = frozenset("nav header footer aside form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidebars nav navbar navigation menu breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus replies respond share sharing social related recommended widget widgets toolbar pagination pager paywall".split()
)
BLOCKS = frozenset("address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("article main section div td body ul ol".split())
RAISED = frozenset("article main".split())
#: Open elements of these end where an article or main element begins: nothing of an article is in them.
ENDED = frozenset("nav header menu form button select option ul ol li a title".split())
#: A start of one of these ends an open one of the set, up to the nearest container.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
_BOUNDS = frozenset([*CONTAINERS, "table", "dl"])
_SPLIT = re.compile(r"[^a-z0-9]+")
#: Class names that stand for the text of a page: beside one of these, others count in part.
CONTENT = frozenset("content article main post entry story text".split())
#: Tags that a landmark counts as: one that is named in whole, and one that is a part of a class name.
FULL, PART = 1000, 30
#: Characters that a line of an article gains, and the ratio that a line under a whole landmark needs: text of some 650 characters.
RAISE, WHOLE = 40, 0.5


class _Lines(HTMLParser):
    """Collects lines as (text, tags, link characters, container number, tags of landmarks, whether in an article)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, int, bool]] = []
        self.texts: list[str] = []
        self.tags = self.linked = self.skips = self.links = self.low = self.raised = self.n = 0
        self.stack: list[tuple[str, int, int, int]] = []  # (tag, skipped, tags of landmarks, container number or -1)
        self.open: dict[str, int] = {}
        self.path: list[int] = [-1]  # numbers of the open containers
        self.scopes: list[dict[str, int]] = [{}]  # open elements since each element of _BOUNDS

    # what the base class would give out as text at the end of a page, or refuse
    def parse_comment(self, i: int, report: bool = True) -> int:
        end = self.rawdata.find("-->", i + 4)
        if end < 0 and self.rawdata.startswith("<!-->", i):
            return i + 5
        return end + 3 if end >= 0 else len(self.rawdata)

    def parse_html_declaration(self, i: int) -> int:
        if self.rawdata.startswith("<!--", i):
            return self.parse_comment(i)
        sign = "]]>" if self.rawdata.startswith("<![CDATA[", i) else ">"
        end = self.rawdata.find(sign, i)
        return end + len(sign) if end >= 0 else len(self.rawdata)

    def parse_starttag(self, i: int) -> int:
        k = super().parse_starttag(i)
        return k if k >= 0 else len(self.rawdata)

    def parse_endtag(self, i: int) -> int:
        k = super().parse_endtag(i)
        return k if k >= 0 else len(self.rawdata)

    def parse_pi(self, i: int) -> int:
        k = super().parse_pi(i)
        return k if k >= 0 else len(self.rawdata)

    def end_line(self) -> None:
        if self.texts:
            text = " ".join("".join(self.texts).split())
            if text:
                self.lines.append((text, self.tags, self.linked, self.path[-1], self.low, self.raised > 0))
            self.texts.clear()
            self.tags = self.linked = 0

    def _pop(self, to: int) -> None:
        while len(self.stack) > to:
            tag, skip, low, container = self.stack.pop()
            self.skips -= skip
            self.low -= low
            self.links -= tag == "a"
            self.raised -= tag in RAISED
            self.open[tag] -= 1
            if tag in _BOUNDS:
                self.scopes.pop()
            self.scopes[-1][tag] -= 1
            if container >= 0:
                self.path.pop()

    def _close(self, tag: str) -> None:
        """End an open element that the start of ``tag`` ends, unless a container is in between."""
        scope = self.scopes[-1]
        if any(scope.get(x) for x in CLOSES[tag]):
            i = len(self.stack) - 1
            while self.stack[i][0] not in CLOSES[tag]:
                i -= 1
            self._pop(i)
        elif len(self.scopes) > 1 and (tag in ("td", "th", "tr")) and self.open.get("td"):
            i = len(self.stack) - 1
            while self.stack[i][0] not in _BOUNDS:
                i -= 1
            if self.stack[i][0] == "td":
                self._pop(i)

    def _recover(self, main: bool) -> None:
        """End the open menus and forms around a new article, and anything lowered around a main element."""
        for i, (tag, skip, low, _) in enumerate(self.stack):
            if (skip or low >= FULL) and (main or tag in ENDED):
                self.end_line()
                self._pop(i)
                return

    @staticmethod
    def landmark(names: list[str]) -> int:
        """Tags that class names count as: one is named in whole if all of its words are landmarks."""
        whole = any(WORDS.issuperset(w for w in _SPLIT.split(n) if w) for n in names if n.strip("-_"))
        return FULL if whole and CONTENT.isdisjoint(names) else PART

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if tag in VOID:
            return
        if tag in CLOSES:
            self._close(tag)
        if tag in RAISED and (self.skips or self.low >= FULL):
            self._recover(tag == "main")
        skip, low = tag in SKIP, FULL if tag in LOWERED else 0
        if not skip and not low and attrs and tag not in ("html", "body"):
            for name, value in attrs:
                if name in ("class", "id") and value and not WORDS.isdisjoint(found := _SPLIT.split(value.lower())):
                    if tag not in RAISED or not {"comment", "comments", "ad", "advert", "sponsored", "related"}.isdisjoint(found):
                        low = max(low, self.landmark(value.lower().split()))
                elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
                    low = FULL
        if low >= FULL and tag not in BLOCKS and tag not in LOWERED:  # inside a line: left out of it
            skip, low = True, 0
        if low and tag not in BLOCKS:
            self.end_line()
        container = -1
        if tag in CONTAINERS:
            container, self.n = self.n, self.n + 1
            self.path.append(container)
        self.skips += skip
        self.low += low
        self.links += tag == "a"
        self.raised += tag in RAISED
        self.stack.append((tag, int(skip), int(low), container))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.scopes[-1][tag] = self.scopes[-1].get(tag, 0) + 1
        if tag in _BOUNDS:
            self.scopes.append({})

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS or tag in LOWERED:
            self.end_line()
        self.tags += 1
        if self.open.get(tag):
            i = len(self.stack) - 1
            while self.stack[i][0] != tag:
                i -= 1
            self._pop(i)

    def handle_data(self, data: str) -> None:
        if not self.skips:
            self.texts.append(data)
            if self.links:
                self.linked += len(data)


def lines(html: str) -> list[tuple[str, int, int, int, int, bool]]:
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    return parser.lines


def smooth(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing; the kernel is cut at three sigma and weighs only lines that exist."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    middle = slice(reach, reach + len(values))
    return np.convolve(values, kernel)[middle] / np.convolve(np.ones(len(values)), kernel)[middle]


def ratios(found: list[tuple[str, int, int, int, int, bool]]) -> np.ndarray:
    """The logarithm of one more than each line's characters outside links for each tag; landmarks count as tags."""
    of = lambda f: np.array([f(x) for x in found], float)
    gained = of(lambda x: RAISE if x[5] and len(x[0]) > x[2] else 0)
    return np.log1p(((of(lambda x: len(x[0]) - x[2])).clip(0) + gained) / of(lambda x: max(1, x[1]) + x[4]))


def main_text(html: str | None, sigma: float = 0.6, share: float = 0.85, least: float = 0.4) -> str:
    """The main text of a page: the lines of its content clusters in their order, joined by one space.

    The threshold is ``share`` of the mean of the smoothed ratios, weighted by text
    length; a line's own ratio has to reach ``least`` of the threshold, so that
    smoothing lifts no line that is nothing by itself.
    """
    found = lines(html or "")
    if not found:
        return ""
    length, box = np.array([len(x[0]) for x in found], float), np.array([x[3] for x in found])
    ratio = ratios(found)
    smoothed = smooth(ratio, sigma)
    threshold = share * float((smoothed * length).sum() / length.sum())
    whole = np.array([x[4] >= FULL for x in found])
    chosen = (smoothed >= threshold) & (ratio >= np.where(whole, np.maximum(WHOLE, least * threshold), least * threshold))
    # a container that is mostly content takes its other lines along
    size, inside = (np.bincount(box + 1, w) for w in (length, length * chosen))
    cluster = (2 * inside >= size)[box + 1] & (box >= 0)
    linked = np.array([x[2] for x in found], float) > 0.6 * length
    chosen |= cluster & ~whole & ~linked
    return " ".join(x[0] for x, c in zip(found, chosen) if c)


def extract(pages: DataFrame, *, html_col: str = "html", out: str = "text") -> DataFrame:
    """All columns of ``pages`` but the html, and the main text of each page (a column of that name is replaced)."""
    kept = pages.drop(out) if out != html_col else pages
    fields = [f for f in kept.schema.fields if f.name != html_col]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 500):
                part = batch.slice(a, 500)
                texts = pa.array([main_text(x.as_py()) for x in part.column(html_col)], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in fields), texts], names=[*(f.name for f in fields), out])

    return kept.withColumn(html_col, F.col(html_col).cast("string")).mapInArrow(each, T.StructType([*fields, T.StructField(out, T.StringType())]))
