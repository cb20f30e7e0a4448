"""The main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tagloom.llm.common import in_batches

# Fixed values of HTML: elements without end tag, and elements whose start ends an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot"
    " th thead title tr ul".split()
)
# An open element of the second kind ends where one of the first starts, up to the nearest of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
P_SCOPE = {"button", "caption", "html", "object", "table", "td", "th", "template"}

# Elements that are never part of an article, and words of class, id or role that say the same of any element, as a
# form does, but for one that holds the main part of the page (`_wrappers`).
NOT_SHOWN = frozenset("head iframe noscript object script select style svg template textarea title".split())
NOT_ARTICLE = frozenset("aside button dialog footer menu nav".split())
NOT_ARTICLE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments complementary consent"
    " contentinfo cookie cookies disqus disclaimer footer form gdpr login masthead menu modal nav navbar navigation newsletter"
    " notice notices pager pagination popup promo promoted promotion related replies responses search share sharing sidebar"
    " signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
MAIN_PART, NEARLY_ALL = 0.5, 0.9  # of the density sum: with the page's headline, and without
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Page(HTMLParser):
    """The elements of a page in page order, as parallel lists, and its texts."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents = ["#page"], [-1]
        self.marks = [False]  # no part of an article: True by the element's kind, None by its name only
        self.texts: list[tuple[int, str]] = []  # (element, text); (element, None): a block begins or ends
        self.open = [0]
        # Where in ``open`` the open elements of a name are, and those that are blocks, so that no end looks at all of them.
        self.places: dict[str, list[int]] = {"#page": [0]}
        self.blocks: list[int] = []
        self.feed(html)
        self.close()

    def _close_to(self, depth: int) -> None:
        for node in reversed(self.open[depth:]):
            tag = self.tags[node]
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()
                self.texts.append((node, None))
        del self.open[depth:]

    def _last(self, names) -> int:
        """The place of the innermost open element with one of the names, 0 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def _end(self, names, until) -> None:
        """Close the innermost open element of ``names``, unless one of ``until`` lies further in."""
        depth = self._last(names)
        if depth and depth >= (self.blocks[-1] if until is BLOCK and self.blocks else 0 if until is BLOCK else self._last(until)):
            self._close_to(depth)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._end({"p"}, P_SCOPE)
        if tag in ENDS:
            self._end(*ENDS[tag])
        parent = self.open[-1]
        if tag == "br":
            self.texts.append((parent, None))
        self.tags.append(tag)
        self.parents.append(parent)
        self.marks.append(self._mark(tag, attrs))
        if tag in BLOCK:
            self.texts.append((len(self.tags) - 1, None))
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            if tag in BLOCK:
                self.blocks.append(len(self.open))
            self.open.append(len(self.tags) - 1)

    def _mark(self, tag, attrs) -> bool | None:
        if tag in NOT_SHOWN or tag in NOT_ARTICLE:
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        if tag == "header":
            return not self._last(("article", "main"))
        mark = None if tag == "form" else False
        for name, value in attrs:
            if value and name in ("class", "id", "role"):
                if not NOT_ARTICLE_WORDS.isdisjoint(_WORD.findall(_CAMEL.sub(" ", value).lower())):
                    mark = None
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                return True
        return mark

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        self._end({tag}, () if tag in BLOCK else BLOCK)

    def handle_data(self, data):
        self.texts.append((self.open[-1], data))


def densities(page: Page, out: list[bool] | None = None) -> list[float]:
    """The composite text density of every element: characters per tag, adjusted by the links in it.

    Elements that are ``out`` are left out of those that they are in.
    """
    n = len(page.tags)
    chars, tags, link_chars, links = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[page.parents[i]] or page.tags[i] == "a"
    for node, text in page.texts:
        if text is not None and page.tags[node] not in NOT_SHOWN:
            size = sum(map(len, text.split()))
            chars[node] += size
            link_chars[node] += size * in_link[node]
    for i in range(n - 1, 0, -1):
        if out and out[i]:
            continue
        up = page.parents[i]
        chars[up] += chars[i]
        link_chars[up] += link_chars[i]
        tags[up] += tags[i] + 1
        links[up] += links[i] + (page.tags[i] == "a")
    share = link_chars[0] / max(1, chars[0])
    out = []
    for c, t, lc, lt in zip(chars, tags, link_chars, links):
        t = max(1, t)
        base = math.log(c * lc / max(1, c - lc) + share * c + math.e)
        adjust = max(0.0, math.log(max(1e-9, (c / max(1, lc)) * (t / max(1, lt)))))
        out.append(c / t * (adjust / math.log(base) if base > 1 + 1e-9 else 1.0) if c else 0.0)
    return out


def _out(page: Page, lifted: set[int] | None) -> list[bool]:
    """Which elements are no part of an article: those marked and all in them. ``lifted`` marks by name do not count;
    None lifts all."""
    out = [False] * len(page.tags)
    for i in range(1, len(out)):
        mark = page.marks[i]
        out[i] = out[page.parents[i]] or (mark if mark is not None else lifted is not None and i not in lifted)
    return out


def _densest(page: Page, density: list[float], out: list[bool]) -> tuple[int, float]:
    """The element whose children's densities have the largest sum, and the sum."""
    sums = [0.0] * len(density)
    for i in range(1, len(sums)):
        if not out[i]:
            sums[page.parents[i]] += density[i]
    best = max(range(len(sums)), key=lambda i: (not out[i], sums[i]))
    return best, sums[best]


def _path(page: Page, node: int) -> list[int]:
    path = []
    while node >= 0:
        path.append(node)
        node = page.parents[node]
    return path


def _wrappers(page: Page, density: list[float]) -> set[int]:
    """The elements marked by name that hold the main part of the page.

    They lie around the element that is densest by itself, and the page without marked elements has less than half of its sum if
    they hold the headline, else less than a tenth. From the outermost to the innermost, so that long comments in a wrapper
    stay out.
    """
    if None not in page.marks:
        return set()
    whole, most = _densest(page, density, _out(page, None))
    marked = [i for i in reversed(_path(page, whole)) if page.marks[i] is None]
    headline = [tag in ("h1", "article", "main") for tag in page.tags]
    for i in range(len(headline) - 1, 0, -1):
        headline[page.parents[i]] |= headline[i]

    def stays(k: int) -> bool:
        out = _out(page, set(marked[:k]))
        _, rest = _densest(page, densities(page, out), out)
        return rest >= most * (1 - (MAIN_PART if headline[marked[k]] else NEARLY_ALL))

    return set(marked[: bisect_left(range(len(marked)), True, key=stays)])


def main_text(html: str) -> str:
    """The text of the element whose children's densities have the largest sum.

    The lowest density on the way from there to the body is the threshold: what lies below it and is mostly links
    is a list of links and left out. If the element lies in an article or main element, that is the main text.
    Elements that say they are no article count for neither, but for those by name that hold the main part of the page.
    """
    page = Page(html)
    n, density = len(page.tags), densities(page)
    out = _out(page, _wrappers(page, density))
    best, _ = _densest(page, density, out)
    path = _path(page, best)
    whole = [i for i in path if page.tags[i] in ("article", "main")]
    root = whole[-1] if whole else best
    threshold = min((density[i] for i in path if page.tags[i] not in ("html", "#page")), default=0.0)
    inside, linked = [False] * n, _mostly_links(page)
    inside[root] = not out[root]
    for i in range(root + 1, n):
        links_only = linked[i] and density[i] < threshold
        inside[i] = inside[page.parents[i]] and not out[i] and not links_only
    parts = [" " if text is None else text for node, text in page.texts if inside[node] or text is None]
    return " ".join("".join(parts).split())


def _mostly_links(page: Page) -> list[bool]:
    """Of lists, tables and divisions: is over half of the text in links?"""
    n = len(page.tags)
    chars, links, in_link = [0] * n, [0] * n, [False] * n
    for i in range(1, n):
        in_link[i] = in_link[page.parents[i]] or page.tags[i] == "a"
    for node, text in page.texts:
        if text is not None:
            size = sum(map(len, text.split()))
            chars[node] += size
            links[node] += size * in_link[node]
    for i in range(n - 1, 0, -1):
        chars[page.parents[i]] += chars[i]
        links[page.parents[i]] += links[i]
    return [t in ("ul", "ol", "table", "div", "section") and 2 * b > a for t, a, b in zip(page.tags, chars, links)]


def extract_main_text(pages: DataFrame, html_column: str = "html", out_column: str = "main_text") -> DataFrame:
    """``pages`` with the main text of each page's whole html.

    Character references are decoded; white space inside a block becomes one space, and blocks are joined by
    one space in page order. Null or empty html, and pages without any article text, give an empty text.
    Missing and wrongly nested end tags are read as browsers do. Other columns pass through; a column with the
    name of the result is replaced. Pages are independent: no shuffle.
    """
    kept = [c for c in pages.columns if c != out_column]
    schema = T.StructType([*[pages.schema[c] for c in kept], T.StructField(out_column, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h) if h else "" for h in batch.column(html_column).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], texts], [*kept, out_column])

    return in_batches(pages, run, schema)
