"""Main text of web pages by tree scoring.

Paragraphs give points for their length and commas to the elements around them, less to those
farther out, and links take points away. The best element is the container; it and those of
its siblings that score, too, or are headings or full paragraphs make up the text. A page is
read into flat lists, one entry for each element and each piece of text, in one pass.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import by_batch, texts

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
NO_TEXT = frozenset(
    "head script style noscript template iframe object embed svg canvas math audio video nav aside footer form button input select "
    "textarea label fieldset dialog menu title option".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = BLOCKS - frozenset("body caption head html tbody td tfoot th thead title tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd figcaption".split())
WHOLE = frozenset("article main".split())
#: An element of the first kind ends open ones of the second, up to one of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Words in a class, id or role that mark what is not part of an article.
ASIDE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup sidebar sidebars side rail widget widgets menu menus nav navbar navigation "
    "breadcrumb breadcrumbs masthead topbar toolbar footer footnav comment comments commentlist reply replies respond disqus discussion share sharing "
    "social related recommended recommendations teaser teasers login search searchbox pagination pager contentinfo complementary "
    "dialog alert copyright".split())

#: What a name says that is about the wrapper and not of it, as in has-sidebar; such names count for nothing.
ABOUT = frozenset("has no with without enabled disabled layout col row not is if".split())
#: An element is left in, whatever its name, if it holds more than this share of the text: named wholly, or in part.
MOST_NAMED, MOST_IN_PART = 0.9, 0.5

# Quotes hold a value only after an equals sign; no part of a tag is read twice.
_VALUE = r"""\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<with>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_VALUE})?+)*+)>|[^<]++|<", re.S)
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?<![\w-])(?:hidden(?![\w-])|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*(?:display\s*:\s*none|visibility\s*:\s*hidden))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: How an element is marked: not, by a part of a name, by a whole name, by what it is.
_NOT, _IN_PART, _NAMED, _ALWAYS = range(4)
#: Points that a sibling needs in any case, and the share of the container's.
LEAST_SIBLING, SIBLING_SHARE = 10.0, 0.2
LEAST_PARAGRAPH = 25


class Page:
    """Elements of a page in the order of their starts, and its pieces of text."""

    def __init__(self, html: str):
        self.tags, self.parents, self.last, self._marks = ["html"], [-1], [0], [_NOT]
        self.pieces: list[tuple[int, int, str]] = []  # element, block, text
        self.block = 0
        self._stack, self._open = [0], Counter()
        self._places: dict[str, list[int]] = {}  # of each tag: where on the stack it is open
        at = 0
        while at < len(html):
            m = _TOKEN.match(html, at)
            tag = m["tag"]
            if tag is None:
                if m[0] == "<" and (html[at + 1:at + 2].isalpha() or html[at + 1:at + 2] == "/" and html[at + 2:at + 3].isalpha()):
                    self.pieces.append((self._stack[-1], self.block, html[at:]))  # the page breaks off in a tag
                    break
                at = m.end()
                if m[0][0] != "<" or m[0] == "<":
                    self.pieces.append((self._stack[-1], self.block, m[0]))
                continue
            at = m.end()
            tag = tag.lower()
            if m["end"]:
                self._end(tag)
                continue
            self._start(tag, m["with"])
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = close.end() if close else len(html)
                self._end(tag)
        for element in self._stack:
            self.last[element] = len(self.tags) - 1
        self.unwanted = self._judged()

    def _judged(self) -> list[bool]:
        """Elements that are no part of an article, nor is what is in them.

        A name counts unless the element is around an article or its heading, or holds most of the text.
        """
        n = len(self.tags)
        length, core = [0] * n, [tag in WHOLE or tag == "h1" for tag in self.tags]
        gone = [False] * n
        for e in range(1, n):
            gone[e] = gone[self.parents[e]] or self._marks[e] == _ALWAYS
        for element, _, text in self.pieces:
            if not gone[element]:
                length[element] += len(text)
        for e in range(n - 1, 0, -1):
            length[self.parents[e]] += length[e]
            core[self.parents[e]] |= core[e] and not gone[e]
        most = {_NOT: -1.0, _IN_PART: MOST_IN_PART * length[0], _NAMED: MOST_NAMED * length[0]}
        for e in range(1, n):
            mark = self._marks[e]
            named = mark in (_IN_PART, _NAMED) and not core[e] and length[e] <= most[mark]
            gone[e] = gone[self.parents[e]] or mark == _ALWAYS or named
        return gone

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body") and self._open[tag] or tag == "html":
            return
        if tag in CLOSES_P and self._open["p"]:
            self._end("p")
        if tag in ENDS:
            closed, until = ENDS[tag]
            above = max((self._places[t][-1] for t in until if self._places.get(t)), default=0)
            lowest = [places[k] for t in closed if (places := self._places.get(t)) and (k := bisect_right(places, above)) < len(places)]
            if lowest:
                self._cut(min(lowest))
        if tag in BLOCKS:
            self.block += 1
        element = len(self.tags)
        parent = self._stack[-1]
        self.tags.append(tag)
        self.parents.append(parent)
        self.last.append(element)
        self._marks.append(self._mark(tag, attributes, parent))
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            self._places.setdefault(tag, []).append(len(self._stack))
            self._stack.append(element)
            self._open[tag] += 1
        elif tag == "br":
            self.pieces.append((parent, self.block, " "))

    def _mark(self, tag: str, attributes: str, parent: int) -> int:
        if tag in NO_TEXT or tag == "header" and not self._open["article"]:
            return _ALWAYS
        if tag in HEADINGS and self._open["article"] and self.tags[parent] == "header":
            return _NOT
        if tag in ("article", "main", "body") or not attributes:
            return _NOT
        if _HIDDEN.search(attributes):
            return _ALWAYS
        mark = _NOT
        for m in _NAMES.finditer(attributes):
            for name in (m[1] or m[2] or m[3] or "").split():
                parts = {part.lower() for part in _PARTS.findall(name)}
                if not parts.isdisjoint(ASIDE) and parts.isdisjoint(ABOUT):
                    mark = max(mark, _NAMED if name.lower() in ASIDE else _IN_PART)
        return mark

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.block += 1
        if self._places.get(tag):
            self._cut(self._places[tag][-1])

    def _cut(self, k: int) -> None:
        for element in self._stack[k:]:
            self._open[self.tags[element]] -= 1
            self._places[self.tags[element]].pop()
            self.last[element] = len(self.tags) - 1
        del self._stack[k:]


def main_text(html: str) -> str:
    """Blocks of the article, one a line; empty if there are none."""
    page = Page(html)
    n = len(page.tags)
    length, linked, commas, holds_block = [0] * n, [0] * n, [0] * n, [False] * n
    in_link = [False] * n
    for e in range(1, n):
        in_link[e] = in_link[page.parents[e]] or page.tags[e] == "a"
    for element, _, text in page.pieces:
        if not page.unwanted[element]:
            size = len(text) if " " not in text and "\n" not in text else len(" ".join(text.split()))
            length[element] += size
            commas[element] += text.count(",")
            if in_link[element]:
                linked[element] += size
    for e in range(n - 1, 0, -1):
        up = page.parents[e]
        if page.tags[e] in BLOCKS:
            holds_block[up] = True
        holds_block[up] = holds_block[up] or holds_block[e]
        length[up] += length[e]
        linked[up] += linked[e]
        commas[up] += commas[e]

    points = [0.0] * n
    for e in range(1, n):
        if page.unwanted[e] or length[e] < LEAST_PARAGRAPH or not (page.tags[e] in PARAGRAPHS or page.tags[e] in BLOCKS and not holds_block[e]):
            continue
        given = 1 + commas[e] + min(length[e] / 100, 3)
        up = page.parents[e]
        for level in range(4):
            if up < 0:
                break
            points[up] += given / (1, 2, 6, 9)[level]
            up = page.parents[up]
    for e in range(n):
        points[e] *= 1 - linked[e] / length[e] if length[e] else 0.0
    best = max(range(n), key=lambda e: (points[e], -e))
    up = best
    while up > 0:
        if page.tags[up] in WHOLE:
            best = up
        up = page.parents[up]

    taken = [(best, page.last[best])]
    if best:
        least = max(LEAST_SIBLING, SIBLING_SHARE * points[best])
        around = page.parents[best]
        e = around + 1
        while e <= page.last[around]:
            if e != best and not page.unwanted[e] and length[e]:
                few_links = linked[e] < 0.25 * length[e]
                if points[e] >= least or few_links and (page.tags[e] in HEADINGS or page.tags[e] == "p" and length[e] > 80):
                    taken.append((e, page.last[e]))
            e = page.last[e] + 1
    within = [False] * n
    for first, last in taken:
        within[first:last + 1] = [True] * (last + 1 - first)

    blocks: list[str] = []
    now, parts = -1, []
    for element, block, text in page.pieces:
        if within[element] and not page.unwanted[element]:
            if block != now:
                blocks.append("".join(parts))
                now, parts = block, []
            parts.append(unescape(text))
    blocks.append("".join(parts))
    tidy = (" ".join(b.split()) for b in blocks)
    return "\n".join(b for b in tidy if b)


def extract_main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of each page.

    A missing or empty page, and one without any paragraph outside menus and the like, has an
    empty text. Of equally good containers the first is taken. Broken markup is read as
    browsers do in the common cases: open paragraphs, cells and items end where the next
    begins, unclosed comments and scripts run to the end. A name such as ``sidebar`` in a class, id
    or role takes an element out, but not one that is around the article or holds most of the text. Repeated rows each get a row, an
    empty table gives an empty result, other columns are ignored.
    """
    rows = pages.select("page_id", "url", F.col(html).alias("html"))

    def make():
        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [main_text(t) for t in texts(batch.column(2))]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )
        return turn

    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]
    return by_batch(rows, make, ", ".join([*kinds, "text string", "n_chars long"]))


def op2_main_text(spark, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
