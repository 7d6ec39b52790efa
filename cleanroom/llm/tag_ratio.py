"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page's events into lines, one per block-level
element (pages are often written without line breaks).  A line's text-to-tag ratio is its
number of characters by its number of tags; links count as tags and their text for
nothing.  The ratios are smoothed by a Gaussian, and lines above a threshold, the
standard deviation of the smoothed ratios, form the content clusters.

Ratios alone lose short paragraphs and take long notices, so two things the page says of
itself come first: lines inside elements whose name, role, id or class says that they
are not content are never taken; and where the page marks articles or main parts and at least
half of the clusters' text lies in them, the clusters choose among these regions and
reach over all lines of each that holds one.  Otherwise (a page of plain elements, also
beside marked teasers) a cluster takes the lines of low ratio between two of its lines
and the headings before it.

Defined cases: a null or empty page, and one without text, gives an empty text; broken
markup is read as far as the parser goes (elements that are not closed end with what
holds them, end tags without a start are passed over) in time linear in its length; an
empty table gives no rows; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0
SILENT = frozenset("script style template noscript head title svg math iframe object canvas audio video select textarea button".split())
ASIDE = frozenset("nav header footer aside form menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What names of classes and ids say of elements that are not content.
ASIDE_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|sponsor(?:ed)?|promo(?:tion)?|nav|navbar|navigation|menu|breadcrumbs?"
    r"|header|masthead|footer|side-?bar|aside|widget|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscribe|signup|login"
    r"|share|sharing|social|related|recommended|comments?|disqus|replies|reply|respond|pagination|pager|toolbar|skip-?link|copyright"
    r"|disclaimer|legal)(?:$|[\s_-])",
    re.IGNORECASE,
)
ASIDE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: An element of these names closes an open one of those names, up to an element that holds both.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SPACES = re.compile(r"\s+")


class Lines(HTMLParser):
    """Collects (text, tags, link characters, aside, marked region or 0, heading) per block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, int, bool]] = []
        self.open: list[tuple[str, bool, bool, int, bool]] = []  # name, silent, aside, marked region, link
        #: Where open elements are, by name, those that are blocks and those that are blocks
        #: but not headings, so that no tag looks through all that are open.
        self.where: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.holders: list[int] = []
        self.regions = 0
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.heading = False

    @property
    def state(self) -> tuple[str, bool, bool, int, bool]:
        return self.open[-1] if self.open else ("", False, False, 0, False)

    def cut(self, k: int) -> None:
        """Close the elements from ``k`` on."""
        for name, *_ in self.open[k:]:
            self.where[name].pop()
        for at in (self.blocks, self.holders):
            while at and at[-1] >= k:
                at.pop()
        del self.open[k:]

    def end_line(self) -> None:
        text = SPACES.sub(" ", "".join(self.parts)).strip()
        if text:
            _, _, aside, article, _ = self.state
            self.lines.append((text, self.tags, self.linked, aside, article, self.heading))
            self.tags = 0
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        _, silent, aside, article, link = self.state
        if tag in BLOCKS:
            self.end_line()
            self.implied_end(tag)
            _, silent, aside, article, link = self.state
            self.heading = tag in HEADINGS
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        about = dict(attrs)
        named = f"{about.get('class') or ''} {about.get('id') or ''}"
        marks_article = tag in ("article", "main") or about.get("role") in ("main", "article") or about.get("itemprop") == "articleBody"
        page = tag in ("html", "body") or marks_article
        # A header inside an article may hold its heading; elsewhere it is the site's.
        inner_header = tag == "header" and article
        own = (tag in ASIDE and not inner_header) or about.get("role") in ASIDE_ROLE or (bool(ASIDE_NAME.search(named)) and not page and not inner_header)
        hidden = "hidden" in about or about.get("aria-hidden") == "true" or "display:none" in (about.get("style") or "").replace(" ", "")
        if marks_article and not article:
            self.regions += 1
            article = self.regions
        self.where.setdefault(tag, []).append(len(self.open))
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
            if tag not in HEADINGS:
                self.holders.append(len(self.open))
        self.open.append((tag, silent or tag in SILENT or (hidden and not page), aside or own, article, link or tag == "a"))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self.handle_endtag(tag)

    def implied_end(self, tag):
        """What an element's start ends: an open paragraph, an item of the same list, a cell of the same row."""
        ends = CLOSES.get(tag, ())
        while self.holders:
            name = self.open[self.holders[-1]][0]
            if name != "p" and name not in ends:
                return
            self.cut(self.holders[-1])
            if name != "p":
                return

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if at := self.where.get(tag):  # an inline end tag does not close the blocks inside
            if tag in BLOCKS or not self.blocks or self.blocks[-1] < at[-1]:
                self.cut(at[-1])

    def handle_data(self, data):
        _, silent, _, _, link = self.state
        if silent:
            return
        self.parts.append(data)
        if link:
            self.linked += len(data.strip())

    def close(self):
        super().close()
        self.end_line()


def lines_of(html: str) -> list[tuple[str, int, int, bool, bool, bool]]:
    parser = Lines()
    parser.feed(html)
    parser.close()
    return parser.lines


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; beyond the ends there is nothing."""
    reach = max(int(3 * sigma + 0.5), 1)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel)[reach : reach + len(values)]
    return np.convolve(values, kernel)[reach : reach + len(values)] / weight


def content(html: str | None, sigma: float = SIGMA) -> list[str]:
    """The content lines of a page, in order."""
    lines = lines_of(html) if html else []
    if not lines:
        return []
    usable = np.array([not line[3] for line in lines])
    ratio = np.array([max(len(line[0]) - line[2], 0) / max(line[1], 1) for line in lines])
    smooth = smoothed(np.where(usable, ratio, 0.0), sigma)
    chosen = usable & (smooth >= smooth.std()) & (ratio > 0)
    region, size = np.array([line[4] for line in lines]), np.array([len(line[0]) for line in lines])
    marked = usable & (region > 0)
    if marked.any() and size[chosen & marked].sum() >= size[chosen & ~marked].sum():
        held = np.unique(region[chosen & marked])
        chosen = marked & np.isin(region, held) if len(held) else marked
    elif chosen.any():
        at = np.flatnonzero(chosen)
        first, last = at[0], at[-1]
        while first and usable[first - 1] and lines[first - 1][5]:
            first -= 1
        chosen = usable & (np.arange(len(lines)) >= first) & (np.arange(len(lines)) <= last)
    else:
        chosen = usable & (ratio > 0)
    return [line[0] for line, on in zip(lines, chosen) if on]


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""

    def run(batches):
        for batch in batches:
            texts = ["\n".join(content(h)) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
