"""HTML extraction (operator 2): text-to-tag ratios of parser events, smoothed and clustered.

The standard library's parser is fed one page at a time. Its events become lines: a line ends where
a block element starts or ends. A line carries its text, its number of tags, the length of its link texts, whether it lies in a
part that never holds the article (menus, forms, scripts, ...), and its container. The text-to-tag
ratios of the lines are smoothed by a Gaussian kernel and split by a threshold; the high lines vote
for the container that holds the article, and all its lines outside the excluded parts are the text.

Names and forms exclude a part only as long as the article lies elsewhere: a part that holds the page's only
article element, or half of its text where little is outside such parts, is layout and excludes nothing by itself.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

SIGMA = 1.0

# HTML's elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math canvas object audio video select option button textarea title map datalist".split())
BOXES = frozenset("html body main article section div aside nav header footer form fieldset ul ol dl table tbody thead tfoot tr td th figure details dialog menu address blockquote center".split())
BLOCKS = BOXES | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr caption figcaption summary legend".split())
APART = frozenset("nav aside footer form menu dialog header fieldset".split())
#: Parts of APART that may be wrapped around a page.
WRAPS = frozenset("form header fieldset".split())
ARTICLE = frozenset("article main".split())
#: They hold no blocks but div: another one ends them, as it does in browsers.
INLINE = frozenset("button select option datalist svg math".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class and id that name what isn't the article.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert newsletter subscribe subscription popup modal overlay "
    "sidebar side menu nav navbar navigation breadcrumb breadcrumbs topbar masthead header footer foot comments comment commentlist respond replies reply disqus share sharing social related recommended "
    "login signup search widget toolbar pagination pager skip legal copyright".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
# Words of NOISE that name sections of an article, too.
SECTIONS = frozenset("side header notice notices alert legal copyright search".split())
_NAME = re.compile("[a-z]+")
_STATE = re.compile(r"(?<!\S)(?:has|no|with|without)[-_]\S*")  # of a layout, not of what it holds


class Lines(HTMLParser):
    """Lines of one page from parser events."""

    def __init__(self, open_from: dict[str, tuple[int, int]]):
        super().__init__(convert_charrefs=True)
        self.open_from = open_from  # of raw elements: where those begin that never end
        self.stack: list[tuple[str, bool, int]] = []  # element, excluded, container
        self.parents, self.kinds = [-1], ["page"]
        self.soft: list[bool] = [False]  # of containers: excluded unless the article is in it
        self.lines: list[tuple[str, int, int, bool, int, bool]] = []
        self.text: list[str] = []
        self.tags = self.links = self.in_link = 0
        self.raw, self.raw_at = "", (0, 0)
        self.head = self.heading = False

    def _flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            excluded, box = (self.stack[-1][1], self.stack[-1][2]) if self.stack else (False, 0)
            self.lines.append((text, self.tags, self.links, excluded, box, self.heading))
            self.tags = 0
        self.text, self.links = [], 0

    def handle_starttag(self, tag, attrs):
        if self.raw in INLINE and tag in BLOCKS:
            self.raw = ""
        if self.raw:
            return
        self.head = (self.head or tag == "head") and tag not in BLOCKS
        self.tags += not self.head
        if tag in RAW:
            self._flush() if tag == "title" else None
            if self.getpos() < self.open_from.get(tag, (math.inf, 0)):
                self.raw, self.raw_at = tag, self.getpos()
            return
        if tag == "br":
            self.text.append(" ")
            return
        if tag not in BLOCKS:
            if tag == "a":
                self.in_link += 1
            return
        self._flush()
        self.heading = tag in HEADINGS
        if tag not in BOXES:
            return
        excluded, box = (self.stack[-1][1], self.stack[-1][2]) if self.stack else (False, 0)
        given = dict(attrs)
        names = set(_NAME.findall(_STATE.sub("", f"{given.get('class') or ''} {given.get('id') or ''}".lower())))
        in_article = any(self.kinds[b] in ARTICLE for b in self._up(box))
        apart = tag in APART and not (tag == "header" and in_article)
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in (given.get("style") or "").replace(" ", "").lower()
        noise = tag not in ("html", "body") and tag not in ARTICLE and (names & (NOISE - SECTIONS if in_article else NOISE) or (given.get("role") or "").lower() in ROLES)
        self.parents.append(box)
        self.kinds.append(tag)
        self.soft.append(bool(noise) or apart and tag in WRAPS)
        self.stack.append((tag, excluded or apart and tag not in WRAPS or hidden, len(self.parents) - 1))

    def _up(self, box):
        while box >= 0:
            yield box
            box = self.parents[box]

    def handle_startendtag(self, tag, attrs):
        if not self.raw:
            self.tags += 1
            if tag in BLOCKS:
                self._flush()
            elif tag == "br":
                self.text.append(" ")

    def handle_endtag(self, tag):
        if self.raw:
            if tag == self.raw:
                self.raw = ""
            return
        self.tags += not self.head
        self.head = self.head and tag != "head"
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if tag not in BLOCKS:
            return
        self._flush()
        self.heading = self.heading and tag not in HEADINGS
        if any(tag == x[0] for x in self.stack):
            while self.stack.pop()[0] != tag:
                pass
            self.in_link = 0

    def handle_data(self, data):
        if not self.raw:
            self.text.append(data)
            if self.in_link:
                self.links += len(data.strip())

    def close(self):
        super().close()
        self._flush()


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; at the ends the kernel is cut and rescaled."""
    reach = max(1, math.ceil(3 * sigma))
    kernel = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * sigma**2))
    whole = np.convolve(ratios, kernel, "full")[reach : reach + len(ratios)]
    return whole / np.convolve(np.ones(len(ratios)), kernel, "full")[reach : reach + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """The border of two clusters of the values in one dimension, from the ends inward."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        border = (low + high) / 2
        below, above = values[values < border], values[values >= border]
        if not len(below) or not len(above) or (now := (float(below.mean()), float(above.mean()))) == (low, high):
            break
        low, high = now
    return min((low + high) / 2, float(values.std()) or high)


def parse(html: str) -> Lines:
    """The page's lines. A raw element without its end, but for scripts and styles, hides nothing: then all later ones of that name don't."""
    open_from: dict[str, tuple[int, int]] = {}
    while True:
        page = Lines(open_from)
        page.feed(html)
        page.close()
        if not page.raw or page.raw in ("script", "style"):
            return page
        open_from[page.raw] = page.raw_at


def _is_link(page: Lines, line) -> bool:
    """A line of a list of links."""
    return line[2] >= 0.8 * len(line[0]) and page.kinds[line[4]] in ("ul", "ol", "menu", "td")


def _shown(page: Lines) -> list:
    """Lines outside the excluded parts. Parts excluded by name that hold the article exclude nothing by themselves."""
    lines = [x for x in page.lines if not x[3]]
    inner: dict[int, int] = {}  # characters of text
    named: set[int] = set()  # boxes around articles
    articles: set[int] = set()  # the outermost
    total = outside = free = 0
    for x in lines:
        if _is_link(page, x):
            continue
        up, n = list(page._up(x[4])), len(x[0])
        at = [k for k, b in enumerate(up) if page.kinds[b] in ARTICLE]
        around = up[at[-1] :] if at else []  # boxes around the outermost article
        articles.update(around[:1])
        total, outside = total + n, outside + n * (not any(page.soft[b] for b in up))
        free += n * (bool(at) and not any(page.soft[b] for b in around))
        for b in up:
            inner[b] = inner.get(b, 0) + n
        named.update(around)
    for b in range(len(page.soft)):
        if page.soft[b] and page.kinds[b] not in ARTICLE and not free:
            page.soft[b] = not (len(articles) == 1 and b in named or 2 * inner.get(b, 0) >= total > 5 * outside)
    return [x for x in lines if not any(page.soft[b] for b in page._up(x[4]))]


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The article's blocks joined by line feeds; "" for null, empty or textless pages."""
    if not html:
        return ""
    page = parse(html)
    shown = _shown(page)
    lines = [x for x in shown if not _is_link(page, x)]
    if not lines:
        return ""
    ratios = np.array([len(x[0]) / max(1, x[1]) for x in lines], float)
    level = smooth(ratios, sigma)
    high = level >= threshold(level) if len(lines) > 2 else np.ones(len(lines), bool)
    weight: dict[int, int] = {}
    for x, h in zip(lines, high, strict=True):
        if h:
            for box in page._up(x[4]):
                weight[box] = weight.get(box, 0) + len(x[0])
    total = weight.get(0, 0)
    named = [b for b in weight if page.kinds[b] in ARTICLE and weight[b] >= 0.3 * total]
    # an article or main element if it holds much of it, else the smallest box with nearly all of it
    best = max(named, key=lambda b: (page.kinds[b] == "article", weight[b], b)) if named else max((b for b in weight if weight[b] >= 0.9 * total), default=0)
    inside = [k for k, x in enumerate(shown) if best in page._up(x[4])]
    if page.kinds[best] in ARTICLE:
        return "\n".join(shown[k][0] for k in inside)
    # elsewhere lists of links count between lines of text, and the headings just before it belong to a box
    text = [k for k in inside if not _is_link(page, shown[k])]
    first = text[0]
    while first and shown[first - 1][5] and page.parents[best] in (shown[first - 1][4], page.parents[shown[first - 1][4]]):
        first -= 1
    return "\n".join(shown[k][0] for k in [*range(first, text[0]), *(k for k in inside if text[0] <= k <= text[-1])])


def extract(pages: DataFrame, *, html_col="html", text_col="text", sigma: float = SIGMA) -> DataFrame:
    """`pages` with the main text in `text_col`, which replaces a column of that name. A narrow pass.

    Null and empty pages, and pages of markup only, give "". Repeated rows are each extracted; an
    empty table gives no rows; other columns stay as they are. Very long pages are parsed whole.
    """
    kept = [f for f in pages.schema.fields if f.name != text_col or f.name == html_col]
    pages = pages.select([f.name for f in kept])
    schema = T.StructType([*(f for f in kept if f.name != text_col), T.StructField(text_col, T.StringType())])

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(html_col)
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                text = pa.array([main_text(x, sigma) for x in part.column(at).to_pylist()], pa.string())
                columns = [part.column(k) for k in range(part.num_columns) if part.schema.names[k] != text_col]
                yield pa.RecordBatch.from_arrays([*columns, text], names=schema.names)

    return pages.mapInArrow(run, schema)


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
