"""Main-text extraction from HTML.

The standard library's streaming parser turns a page into lines, one per block
element, each with its text and the number of tags met on the way. The text-to-tag
ratio of the lines is smoothed with a Gaussian and split at a two-means threshold
into content and the rest. Regions (article, main, section, div, body) that hold
content lines are selected whole, so their short lines stay.

Markup is evidence beside that. Elements that are page furniture by their kind never count.
Regions that a class or id names as furniture, and forms, go unless they hold an article or main
element of another kind. Forms and regions whose class has such a name only as a part ("header-fixed") also
stay when they hold most of the page's text; "no-sidebar" or "has-sidebar" names nothing. The selection is made inside
articles and main elements when they hold a good part of the content lines: there all regions stay
that hold a content line or are not made of tags mostly.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.shared import slices

REGIONS = frozenset("html body main article section div center".split())
FURNITURE = frozenset("head nav header footer aside form script style noscript template iframe object svg canvas button select textarea dialog menu title".split())
BLOCKS = REGIONS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address hr br fieldset details summary".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: A start tag ends an open element of the same row of this table, up to the nearest region or list.
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = BLOCKS - {"br"}
NAMES = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|popup|modal|newsletter|subscribe|sidebar|widget|menu|nav|navbar|navigation|"
    r"breadcrumbs?|pager|pagination|footer|header|masthead|comments?|commentlist|disqus|replies|share|social|related|recommended|login|signup|search",
    re.IGNORECASE,
)
#: Parts of a class that speak about furniture without being some.
ABOUT = frozenset("no not has have with without is layout open closed fixed sticky enabled disabled".split())
#: Kinds of regions that may go as a whole.
FORM, PARTLY, NAMED = "form", "partly", "named"
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())


def furniture_name(marked: str) -> str | None:
    """How far a class or id names furniture: whole, in part, or not."""
    found = None
    for token in marked.split():
        if NAMES.fullmatch(token):
            return NAMED
        parts = re.split(r"[_-]+", token.lower())
        if any(NAMES.fullmatch(part) for part in parts) and ABOUT.isdisjoint(parts):
            found = PARTLY
    return found


class Lines(HTMLParser):
    """Collects ``[region, text parts, tags]`` lines; region -1 is furniture."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.regions: list[tuple[int, bool, str, str]] = [(-1, False, "", "")]  # parent region, inside an article or main element, kind if suspect, tag
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.open: dict[str, int] = {}
        self.lines: list[list] = []
        self.line: list | None = None

    def _break(self) -> None:
        self.line = None

    def _pop(self) -> None:
        tag, _ = self.stack.pop()
        self.open[tag] -= 1

    def _count(self, region: int) -> list:
        if self.line is None or self.line[0] != region:
            self.line = [region, [], 0]
            self.lines.append(self.line)
        return self.line

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS or tag in FURNITURE:
            self._break()
        ends = SELF_CLOSING.get(tag, ()) or (("p",) if tag in CLOSES_P else ())
        if any(self.open.get(t) for t in ends):
            for depth in range(len(self.stack) - 1, 0, -1):
                name = self.stack[depth][0]
                if name in ends:
                    while len(self.stack) > depth:
                        self._pop()
                    break
                if name in REGIONS or name in ("ul", "ol", "dl", "table"):
                    break
        region = self.stack[-1][1]
        if region >= 0:
            self._count(region)[2] += 1
        if tag in VOID:
            return
        if region >= 0:
            named = dict(attrs)
            style = (named.get("style") or "").replace(" ", "").lower()
            marked = f"{named.get('class') or ''} {named.get('id') or ''}"
            kind = "" if tag in ("html", "body") else furniture_name(marked) or ""
            if tag == "form" and kind != NAMED:
                kind = FORM
            if tag in FURNITURE and tag != "form" or "hidden" in named or "display:none" in style or (named.get("role") or "").lower() in ROLES:
                region = -1
            elif tag in REGIONS or kind:
                self.regions.append((region, self.regions[region][1] or tag in ("article", "main"), kind, tag))
                region = len(self.regions) - 1
        self.stack.append((tag, region))
        self.open[tag] = self.open.get(tag, 0) + 1

    def parse_html_declaration(self, i):
        try:
            return super().parse_html_declaration(i)
        except AssertionError:  # "<![" and no known keyword: a bogus comment, up to ">" or the end
            end = self.rawdata.find(">", i)
            return len(self.rawdata) if end < 0 else end + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS or tag in FURNITURE:
            self._break()
        if self.open.get(tag):
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data):
        region = self.stack[-1][1]
        if region >= 0:
            self._count(region)[1].append(data)


def smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    radius = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel)[radius : radius + len(values)]
    return np.convolve(values, kernel)[radius : radius + len(values)] / weight


def threshold(values: np.ndarray) -> float:
    """Border between the two clusters of ``values`` (two-means in one dimension)."""
    low, high = values.min(), values.max()
    for _ in range(50):
        border = (low + high) / 2
        above = values >= border
        if above.all() or not above.any():
            return border
        new = values[~above].mean(), values[above].mean()
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def without_suspects(lines: list[tuple[int, str, int]], regions: list[tuple[int, bool, str, str]]) -> list[tuple[int, str, int]]:
    """The lines outside suspect regions, and in those that hold an article or main element that is none itself.

    Forms, and regions that are named in part only, also stay when they hold most of the text.
    """
    if not any(kind for _, _, kind, _ in regions):
        return lines
    around: dict[int, list[int]] = {}
    held: dict[int, int] = {}
    whole: set[int] = set()
    for region, text, _ in lines:
        if region not in around:
            suspects, up, article = [], region, False
            while up >= 0:
                _, _, kind, tag = regions[up]
                if kind:
                    suspects.append(up)
                    if article:
                        whole.add(up)
                elif tag in ("article", "main"):
                    article = True
                up = regions[up][0]
            around[region] = suspects
        for suspect in around[region]:
            held[suspect] = held.get(suspect, 0) + len(text)
    total = sum(len(text) for _, text, _ in lines)
    whole.update(suspect for suspect, n in held.items() if 2 * n > total and regions[suspect][2] != NAMED)
    return [x for x in lines if whole.issuperset(around[x[0]])]


def content_lines(lines: list[tuple[int, str, int]], sigma: float) -> np.ndarray:
    """Which lines are content by their smoothed text-to-tag ratio."""
    ratio = smoothed(np.array([len(text) / max(1, tags) for _, text, tags in lines]), sigma)
    return ratio >= min(threshold(ratio), ratio.max())


def main_text(html: str | None, sigma: float = 1.0, article_share: float = 0.15, least_ratio: float = 12.0) -> str:
    """The main text; blocks are joined by one space, white space runs become one space.

    Articles and main elements are chosen when they hold ``article_share`` of the text that is left; inside them
    a region of ``least_ratio`` characters a tag or more stays also without a content line.
    """
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    regions = parser.regions
    lines = [(region, text, tags) for region, parts, tags in parser.lines if (text := " ".join("".join(parts).split()))]
    lines = without_suspects(lines, regions)
    if not lines:
        return ""
    marked = [x for x in lines if regions[x[0]][1]]
    size = sum(len(text) for _, text, _ in marked)
    inside = size > 0 and size >= article_share * sum(len(text) for _, text, _ in lines)
    lines = marked if inside else lines
    content = content_lines(lines, sigma)
    chosen = {region for (region, _, _), good in zip(lines, content, strict=True) if good}
    if inside:  # and regions that are text rather than tags
        told: dict[int, list[int]] = {}
        for region, text, tags in lines:
            cell = told.setdefault(region, [0, 0])
            cell[0], cell[1] = cell[0] + len(text), cell[1] + max(1, tags)
        chosen |= {region for region, (n, tags) in told.items() if n >= least_ratio * tags}

    def kept(region: int) -> bool:
        while region >= 0 and region not in chosen:
            region = regions[region][0]
        return region >= 0

    keep = {region: region in chosen if inside else kept(region) for region in {x[0] for x in lines}}
    return " ".join(text for region, text, _ in lines if keep[region])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page; a null or empty page has the text "".

    Repeated rows are answered each; other columns are ignored; null ids and urls stay null.
    """

    def run(batches):
        for batch in slices(batches, 64):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
