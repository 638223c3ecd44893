"""Main text of web pages (operator 5).

The standard library's parser streams events; every block (what lies between
block-level tags) becomes a line with its text and its number of tags.  The
ratio of text to tags per line is smoothed with a Gaussian kernel, and the
lines whose smoothed ratio reaches the threshold (the ratios' mean or standard
deviation, whichever is less) are clustered: the content region is the
innermost container that holds most of their text, widened to the article it
stands in or, on a page without one, to every container whose further text is
mostly clustered too.  Elements that are page furniture by their tag, role or class names
(menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts,
styles) have ratio 0 and never count.  All other blocks of the region are kept.

Sums per element are taken once, from the last element to the first, and a tag
or comment that the page never closes ends with the page, so that broken and very
deep pages cost what others cost.

Defined results: a null or empty html has the empty text; unclosed or stray
tags never fail; ties between containers go to the inner one; repeated rows
are rows of their own; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, chunks, table

SIGMA = 1.5
#: Share of the clustered text that the region's container must hold.
MOST = 0.5

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = set("article body div html main section table tbody td tr".split())
#: Elements whose content is never page text.
SILENT = set("head script style noscript template svg math canvas iframe object audio video title".split())
FURNITURE = set("nav footer aside form button select textarea menu dialog fieldset".split())
FURNITURE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
FURNITURE_WORDS = set(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr login masthead menu modal "
    "nav navbar navigation newsletter notice notices pagination popup promo promoted related share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: A tag that, when it opens, closes an open one of these.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES |= {b: {"p"} for b in BLOCKS - set(CLOSES)}
_WORDS = re.compile(r"[^A-Za-z0-9]+")


class _Element:
    __slots__ = ("tag", "parent", "bad", "article", "depth", "whole", "held", "kept")

    def __init__(self, tag: str, parent: _Element | None, bad: bool, article: bool):
        self.tag, self.parent, self.bad, self.article = tag, parent, bad, article
        self.depth = parent.depth + 1 if parent else 0
        self.whole = self.held = 0  # code points of its blocks, and of the clustered ones
        self.kept = False


def _furniture(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    if tag in FURNITURE or tag in SILENT or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body", "main"):
        return False
    for name, value in attrs:
        if not value:
            if name == "hidden":
                return True
            continue
        if name == "role" and value.lower() in FURNITURE_ROLES:
            return True
        if name in ("class", "id"):
            words = set(_WORDS.split(value.lower()))
            if words & FURNITURE_WORDS or ("header" in words and not in_article):
                return True
    return False


class Lines(HTMLParser):
    """Collects (element, text, tags) of every block of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Element("html", None, False, False)
        self.elements = [self.root]  # parents before children
        self.open = Counter()  # tags from the root to `at`
        self.lines: list[tuple[_Element, str, int]] = []
        self.parts: list[str] = []
        self.tags = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append((self.at, text, self.tags))
                self.tags = 0
            self.parts = []

    def _climb(self, to: _Element) -> None:
        while self.at is not to:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def _close(self, tags: set[str]) -> None:
        """Close the nearest open element among ``tags`` within its container."""
        if not any(self.open[t] for t in tags):
            return
        e = self.at
        while e is not self.root and e.tag not in tags:
            if e.tag in CONTAINERS or (e.tag in ("ul", "ol", "dl", "table") and "p" not in tags):
                return
            e = e.parent
        if e is not self.root:
            self._climb(e.parent)

    def _unclosed(self, i: int, *ends: str) -> bool:
        """Whether none of ``ends`` follows position ``i`` of the page."""
        text = self.rawdata
        if self.last_in is not text:
            self.last_in, self.last = text, {}
        for end in ends:
            if end not in self.last:
                self.last[end] = text.rfind(end)
        return all(self.last[end] < i for end in ends)

    last_in: str | None = None

    def parse_starttag(self, i):
        return len(self.rawdata) if self._unclosed(i, ">") else super().parse_starttag(i)

    def parse_endtag(self, i):
        return len(self.rawdata) if self._unclosed(i, ">") else super().parse_endtag(i)

    def parse_pi(self, i):
        return len(self.rawdata) if self._unclosed(i, ">") else super().parse_pi(i)

    def parse_html_declaration(self, i):
        return len(self.rawdata) if self._unclosed(i, ">") else super().parse_html_declaration(i)

    def parse_comment(self, i, report=1):
        return len(self.rawdata) if self._unclosed(i + 2, "-->", "--!>") else super().parse_comment(i, report)

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
            self._close(CLOSES[tag])
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID or tag == "html":
            return
        article = self.at.article or tag in ("article", "main")
        self.at = _Element(tag, self.at, self.at.bad or _furniture(tag, attrs, self.at.article), article)
        self.elements.append(self.at)
        self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if not self.open[tag]:
            return
        e = self.at
        while e is not self.root and e.tag != tag:
            if e.tag in CONTAINERS and tag not in CONTAINERS and tag not in FURNITURE and tag != "header":
                return  # a stray end tag does not close what contains it
            e = e.parent
        if e is self.root:
            return
        if tag in BLOCKS or any(x in BLOCKS for x in self._between(e)):
            self.flush()
        self._climb(e.parent)

    def _between(self, top: _Element) -> list[str]:
        tags, e = [], self.at
        while e is not top:
            tags.append(e.tag)
            e = e.parent
        return tags

    def handle_data(self, data):
        if not self.at.bad:
            self.parts.append(data)
        elif self.at.tag not in SILENT:
            self.tags += 1  # furniture's words count as markup


def _region(lines: list[tuple[_Element, str, int]], elements: list[_Element]) -> _Element | None:
    """The element whose blocks are the content."""
    ratio = np.array([len(t) / max(1, n) for _, t, n in lines])
    reach = math.ceil(2 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    smooth = np.convolve(ratio, kernel / kernel.sum(), "full")[reach : reach + len(ratio)]
    chosen = smooth >= min(smooth.mean(), smooth.std() or smooth.mean())
    total = 0
    for (e, text, _), yes in zip(lines, chosen, strict=True):
        e.whole += len(text)
        if yes:
            e.held += len(text)
            total += len(text)
    if not total:
        return None
    for e in reversed(elements[1:]):
        e.parent.whole += e.whole
        e.parent.held += e.held
    # the containers with more than half lie within each other
    top = max((e for e in elements if e.tag in CONTAINERS and e.held > MOST * total), key=lambda e: e.depth, default=None)
    e, marked = top, False
    while e is not None:  # widen to the outermost article or main part it stands in
        if e.tag in ("article", "main"):
            top, marked = e, True
        e = e.parent
    if top is None or marked:
        return top
    e = top.parent
    while e is not None:  # without one, to what adds mostly clustered text
        if e.tag in CONTAINERS and e.held - top.held >= MOST * (e.whole - top.whole):
            top = e
        e = e.parent
    return top


def main_text(html: str) -> str:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    if not parser.lines:
        return ""
    region = _region(parser.lines, parser.elements) or parser.root
    for e in parser.elements:
        e.kept = e is region or (e.parent is not None and e.parent.kept)
    return "\n".join(text for e, text, _ in parser.lines if e.kept)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            texts = [main_text(h) if h else "" for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    src = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return arrow_map(src, run, f"page_id {src.schema['page_id'].dataType.simpleString()}, url {src.schema['url'].dataType.simpleString()}, text string, n_chars long")


def op5_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
