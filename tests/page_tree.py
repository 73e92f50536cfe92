"""Selectors over a tree of elements, plain and slow, to hold the page rules against.

A page becomes a tree of elements; a rule finds elements by a CSS selector made of
tag, classes, one attribute test and descendants, and takes text or attributes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from typing import Any

_EMPTY = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# An opening tag ends an open element of these kinds if it is the innermost one.
_ENDS = {
    **dict.fromkeys(
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 "
        "header hr main nav ol p pre section table ul".split(), frozenset({"p"})
    ),
    "li": frozenset({"li", "p"}),
    "dt": frozenset({"dt", "dd", "p"}),
    "dd": frozenset({"dt", "dd", "p"}),
    "option": frozenset({"option"}),
    "tr": frozenset({"tr", "td", "th", "p"}),
    "td": frozenset({"td", "th", "p"}),
    "th": frozenset({"td", "th", "p"}),
}
_STEP = re.compile(r'([\w-]*)((?:\.[\w-]+)*)(?:\[([\w-]+)(?:\*="([^"]*)")?\])?')


@dataclass(eq=False, slots=True)
class Element:
    tag: str
    attributes: dict[str, str]
    parent: "Element | None" = None
    children: list["Element | str"] = field(default_factory=list)
    place: int = 0
    # Of a whole page: its elements by tag, by class (with a point before it) and all ('').
    index: dict[str, list["Element"]] | None = None

    def below(self) -> Iterator["Element"]:
        """Elements inside this one, in page order."""
        waiting = [c for c in reversed(self.children) if isinstance(c, Element)]
        while waiting:
            element = waiting.pop()
            yield element
            waiting.extend(c for c in reversed(element.children) if isinstance(c, Element))

    def text(self, glue: str) -> str | None:
        """Text inside, whitespace collapsed; None if there is none."""
        pieces: list[str] = []
        waiting: list[Element | str] = [self]
        while waiting:
            part = waiting.pop()
            if isinstance(part, str):
                pieces.append(part)
            elif part is self or part.tag not in ("script", "style"):
                waiting.extend(reversed(part.children))
        return " ".join(glue.join(pieces).split()) or None


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.open = Element("", {}, index={"": []})

    def handle_starttag(self, tag, attrs):
        ends = _ENDS.get(tag, ())
        while self.open.tag in ends:
            self.open = self.open.parent
        index = self.root.index
        # Of an attribute given twice the first counts.
        element = Element(tag, {k: v or "" for k, v in reversed(attrs)}, self.open, place=len(index[""]))
        self.open.children.append(element)
        for key in {"", tag, *("." + name for name in element.attributes.get("class", "").split())}:
            index.setdefault(key, []).append(element)
        if tag not in _EMPTY:
            self.open = element

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.open.tag == tag and tag not in _EMPTY:
            self.open = self.open.parent

    def handle_endtag(self, tag):
        element = self.open
        while element.parent is not None and element.tag != tag:
            element = element.parent
        if element.parent is not None:
            self.open = element.parent

    def handle_data(self, data):
        self.open.children.append(data)


def read_page(html: str) -> Element:
    reader = _Reader()
    reader.feed(html)
    reader.close()
    return reader.root


@dataclass(frozen=True)
class _Step:
    tag: str
    classes: frozenset[str]
    attribute: str | None
    part: str | None

    @property
    def key(self) -> str:
        """Under which a page has the elements that may fit."""
        return "." + min(self.classes) if self.classes else self.tag

    def fits(self, element: Element) -> bool:
        has = element.attributes
        return (
            (not self.tag or self.tag == element.tag)
            and (not self.classes or self.classes <= set(has.get("class", "").split()))
            and (self.attribute is None or self.attribute in has)
            and (self.part is None or self.part in has[self.attribute])
        )


class Selector:
    """'div.a b[href], p' as alternatives of descendant steps."""

    def __init__(self, css: str) -> None:
        self._paths = [[self._step(s) for s in path.split()] for path in css.split(",")]

    @staticmethod
    def _step(css: str) -> _Step:
        match = _STEP.fullmatch(css)
        if not match:
            raise ValueError(f"unsupported selector: {css}")
        tag, classes, attribute, part = match.groups()
        return _Step(tag, frozenset(classes.split(".")[1:]), attribute, part)

    def all(self, root: Element) -> Iterator[Element]:
        """Matches below an element in page order; on a whole page only those are tried that end like a path."""
        if root.index is None:
            return (e for e in root.below() if any(self._leads_to(e, p) for p in self._paths))
        found = {e.place: e for p in self._paths for e in root.index.get(p[-1].key, ()) if self._leads_to(e, p)}
        return (found[place] for place in sorted(found))

    def first(self, root: Element) -> Element | None:
        return next(self.all(root), None)

    @staticmethod
    def _leads_to(element: Element, path: list[_Step]) -> bool:
        if not path[-1].fits(element):
            return False
        left = len(path) - 1
        above = element.parent
        while left and above is not None:
            left -= path[left - 1].fits(above)
            above = above.parent
        return not left


@dataclass(frozen=True)
class Rule:
    """What to take from a page, and the Spark type of what is taken."""

    type: str
    take: Callable[[Element], Any]


def text(css: str, within: str | None = None, glue: str = " ", parent: bool = False) -> Rule:
    """Text of the first match; ``within`` the first match of another selector, if given."""
    wanted, block = Selector(css), Selector(within) if within else None

    def take(page: Element):
        root = block.first(page) if block else page
        found = wanted.first(root) if root else None
        if found is not None and parent:
            found = found.parent
        return found.text(glue) if found is not None else None

    return Rule("string", take)


def texts(css: str, inner: str | None = None, glue: str = " ") -> Rule:
    """Texts of all matches, or of the first ``inner`` match in each."""
    wanted, part = Selector(css), Selector(inner) if inner else None

    def take(page: Element):
        found = (part.first(e) if part else e for e in wanted.all(page))
        return [t for t in (e.text(glue) for e in found if e is not None) if t]

    return Rule("array<string>", take)


def values(css: str, attribute: str, within: str | None = None) -> Rule:
    """One attribute of all matches, trimmed, empty ones left out."""
    wanted, block = Selector(css), Selector(within) if within else None

    def take(page: Element):
        root = block.first(page) if block else page
        found = wanted.all(root) if root else ()
        return [v for v in (e.attributes.get(attribute, "").strip() for e in found) if v]

    return Rule("array<string>", take)


def present(css: str) -> Rule:
    wanted = Selector(css)
    return Rule("boolean", lambda page: wanted.first(page) is not None)


def pairs(css: str, label: str, value: str, needs: str | None = None) -> Rule:
    """label → value out of each match that has both, and ``needs`` if given."""
    wanted, label_at, value_at = Selector(css), Selector(label), Selector(value)
    needed = Selector(needs) if needs else None

    def take(page: Element):
        found: dict[str, str] = {}
        for item in wanted.all(page):
            ends = label_at.first(item), value_at.first(item)
            if None in ends or (needed and needed.first(item) is None):
                continue
            name, content = (end.text("") for end in ends)
            if name and content:
                found[name] = content
        return found

    return Rule("map<string,string>", take)
