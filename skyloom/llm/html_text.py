"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard-library parser streams start, end and text events. Every block element begins a new line; a line holds
its text (white space as one blank), the tags met while it was filled, and how much of it is link text. Elements, roles
and class names that say that they are no article (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles, comments of readers, hidden parts) are a help: what they name is not read at all.

What decides is the ratio of text outside links to tags. Its logarithm is smoothed over all lines with a Gaussian; the
values of lines that are not mostly links are split in two clusters, at the cut that leaves the least variance inside
them; lines in the upper cluster are content.
Where the clusters are less than a factor ``APART`` apart, all lines with text of their own are. Of the lower cluster only
these stay: lines in the container or the article element of a content line, and lines between content lines inside the
container of one of them, that are not mostly links, or are a single such line between others. So a title or a short
paragraph stays with its article, and menus, link lists and footers go, whatever they are called.

Defined results: a null or empty page, or one without content, gives an empty text; a page cut off anywhere is read
as far as it goes; markup the parser rejects is read as text; lines are never capped; rows are independent.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import each, fields, query, table

RESULT = fields(text=T.StringType(), n_chars=T.LongType())
SIGMA = 1.0
LINK_SHARE = 0.6
APART = 2.0

#: Fixed names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("article main section div td body blockquote ul ol dl table html".split())
SKIP = frozenset(
    "script style noscript template head title nav aside footer form button select textarea iframe object svg canvas "
    "audio video dialog menu search math".split()
)
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar note".split())
#: Words of class and id names that mark what is no article.
SKIP_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adbox|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alert|popup|"
    r"modal|overlay|side-?bar|aside|menu|nav|navbar|navigation|breadcrumbs?|topbar|toolbar|pagination|pager|masthead|"
    r"footer|header|copyright|legal|comments?|disqus|replies|respond|share|sharing|social|follow|subscribe|"
    r"subscription|newsletter|signup|login|related|recommend\w*|widget|skip-?link)(?=$|[\s_-])", re.I)
#: Names that say what an element is beside, or the head of: no mark of the element itself.
WRAPPER_NAMES = re.compile(
    r"\b(?:has|with|no|without)-[\w-]+|\b(?:article|post|entry|story|content)-?_?(?:header|title)\b", re.I)


class Line(NamedTuple):
    text: str
    tags: int
    link: int  # characters inside links
    box: int  # nearest container
    article: int  # outermost article element
    marked: bool  # inside an article or main part

    @property
    def linked(self) -> bool:
        return self.link >= LINK_SHARE * len(self.text)


class _Lines(HTMLParser):
    """Collects lines from parser events."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int]] = []  # open elements and their numbers
        self.skip_from = -1  # depth of the element that is skipped
        self.opened = 0
        self.articles = 0
        self.links = 0
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = self.link_chars = 0
        self.above: dict[int, int] = {0: 0}  # container around each container

    # ------------------------------------------------------------------ lines
    def places(self) -> tuple[int, int, bool]:
        """The nearest container, the outermost open article, and whether that or a main part is open (0: none)."""
        near = article = 0
        marked = False
        for tag, number in self.stack:
            near = number if tag in CONTAINER else near
            article = article or (number if tag == "article" else 0)
            marked |= tag in ("article", "main")
        return near, article, marked

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, self.tags, self.link_chars, *self.places()))
            self.tags = 0
        self.parts, self.link_chars = [], 0

    # ------------------------------------------------------------------ events
    def unwanted(self, tag: str, attrs) -> bool:
        if tag in SKIP:
            return True
        if tag == "header":
            return not self.articles
        if tag in ("html", "body", "article", "main", "h1", "p"):
            return any(k == "hidden" for k, _ in attrs)
        for name, value in attrs:
            value = value or ""
            if name == "hidden" or name == "role" and value.lower() in SKIP_ROLES:
                return True
            if name in ("class", "id") and SKIP_NAMES.search(WRAPPER_NAMES.sub(" ", value)):
                return True
            if name == "style" and "display:none" in value.replace(" ", "").lower():
                return True
            if name == "aria-hidden" and value.lower() == "true":
                return True
        return False

    def handle_starttag(self, tag, attrs):
        if self.skip_from >= 0 and tag == "main" and self.stack[self.skip_from][0] in ("nav", "aside", "form"):
            self.close_to(self.skip_from)  # a part that was never closed
        if tag in VOID:
            if self.skip_from < 0:
                self.tags += 1
                if tag in BLOCK:
                    self.end_line()
                else:
                    self.parts.append(" " if tag == "br" else "")
            return
        if self.skip_from < 0:
            if tag in BLOCK:
                self.end_line()
            self.tags += 1
        if tag == "p" and self.stack and self.stack[-1][0] == "p":
            self.close_to(len(self.stack) - 1)
        elif tag in ("li", "dt", "dd", "tr", "td", "th", "option") and self.stack and self.stack[-1][0] == tag:
            self.close_to(len(self.stack) - 1)
        self.opened += 1
        skip = self.skip_from < 0 and (
            self.unwanted(tag, attrs) or tag == "article" and self.comment(attrs)
        )
        if tag in CONTAINER:
            self.above[self.opened] = self.places()[0]
        self.stack.append((tag, self.opened))
        if skip:
            self.end_line()
            self.skip_from = len(self.stack) - 1
        elif self.skip_from < 0:
            if tag in ("article", "main"):
                self.articles += 1
            self.links += tag == "a"

    @staticmethod
    def comment(attrs) -> bool:
        return any(k in ("class", "id") and re.search(r"(?:^|[\s_-])comments?(?=$|[\s_-])", v or "", re.I) for k, v in attrs)

    def close_to(self, depth: int) -> None:
        """Close every open element from ``depth`` on."""
        for k in range(len(self.stack) - 1, depth - 1, -1):
            tag = self.stack[k][0]
            if self.skip_from == k:
                self.skip_from = -1
            elif self.skip_from < 0:
                if tag in BLOCK:
                    self.end_line()
                self.articles -= tag in ("article", "main")
                self.links -= tag == "a"
            self.stack.pop()

    def handle_endtag(self, tag):
        if self.skip_from < 0:
            self.tags += 1
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == tag:
                if depth < self.skip_from and tag not in ("body", "html", "main", "article") and tag not in CONTAINER:
                    return  # an inline end tag does not reach out of a skipped part
                self.close_to(depth)
                return
        if self.skip_from < 0 and tag in BLOCK:
            self.end_line()

    def handle_data(self, data):
        if self.skip_from < 0:
            self.parts.append(data)
            if self.links:
                self.link_chars += len(data.strip())


def page_lines(html: str) -> tuple[list[Line], dict[int, int]]:
    """Lines of a page, and the container around each container."""
    parser = _Lines()
    try:
        parser.feed(html)
        parser.close()
    except AssertionError:  # a marked section the parser does not know: read its opening as text
        parser = _Lines()
        parser.feed(re.sub(r"<!\[", "&lt;![", html))
        parser.close()
    parser.end_line()
    return parser.lines, parser.above


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; weights at the ends are those of the lines that exist."""
    radius = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    total = np.convolve(ratios, kernel)[radius:radius + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), kernel)[radius:radius + len(ratios)]


def cluster_threshold(values: np.ndarray) -> float:
    """Least value of the upper of two clusters: the cut of the sorted values with the least variance inside the parts.

    Where the means of the parts are less than ``APART`` (of ratios; these are logarithms) apart, all values are one cluster.
    """
    x = np.sort(values)
    if x[0] == x[-1]:
        return float(x[0])
    n, k = len(x), np.arange(1, len(x))
    below = np.cumsum(x)[:-1]
    above = x.sum() - below
    at = int(np.argmax(below ** 2 / k + above ** 2 / (n - k)))  # least variance inside is most between
    apart = above[at] / (n - 1 - at) - below[at] / (at + 1)
    return float(x[at + 1] if apart >= np.log(APART) else x[0])


def content_lines(lines: list[Line]) -> np.ndarray:
    """Which lines are content by the clusters of their smoothed ratios."""
    own = np.array([max(0, len(x.text) - x.link) / max(1, x.tags) for x in lines], dtype=float)
    ratios, free = smooth(np.log1p(own)), ~np.array([x.linked for x in lines])
    return free & (ratios >= cluster_threshold(ratios[free]) - 1e-9) if free.any() else free


def extract(html: str | None) -> str:
    """Main text of one page."""
    if not html:
        return ""
    lines, above = page_lines(html)
    if any(x.marked and not x.linked for x in lines):  # the page says where its article is
        lines = [x for x in lines if x.marked]
    if not lines:
        return ""
    content = content_lines(lines)
    boxes = {x.box for x, yes in zip(lines, content) if yes}
    articles = {x.article for x, yes in zip(lines, content) if yes} - {0}

    def within(box: int) -> bool:
        """Is a container that holds content itself around this one?"""
        while box and box not in boxes:
            box = above[box]
        return box in boxes

    at = np.flatnonzero(content)
    keep = content.copy()
    for k, x in enumerate(lines):
        if not content[k] and not x.linked:
            between = len(at) and at[0] < k < at[-1]
            keep[k] = x.box in boxes or x.article in articles or between and within(x.box)
    for k in range(1, len(lines) - 1):  # a line that is one link, in the midst of others
        if lines[k].linked and keep[k - 1] and keep[k + 1] and lines[k].box == lines[k - 1].box == lines[k + 1].box:
            keep[k] = True
    return "\n\n".join(x.text for x, yes in zip(lines, keep) if yes)


def main_text(html: Column) -> Column:
    """Struct(text, n_chars) of a column of pages."""

    def one(page):
        text = extract(page)
        return text, len(text)

    return each(one, RESULT)(html)


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without its ``html_col``, with ``text`` and ``n_chars`` in a struct column ``main``."""
    others = [F.col(f"`{c}`") for c in pages.columns if c not in (html_col, "main")]
    return pages.select(*others, main_text(F.col(f"`{html_col}`")).alias("main"))


@query("op3_html_extraction")
def op3_html_extraction(spark, sf_dir):
    return extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "main.*")
