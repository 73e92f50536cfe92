"""Rules that pick fields out of one HTML page: a per-row helper for Spark tasks.

Rules find elements by CSS selectors made of tag, classes, one attribute test and descendants,
and take text or attributes. The selectors of all rules become one automaton: a bit for each
step, set on an element if it fits and the step before is set on an element around it. It runs
once over the tags of a page, keeps only the open elements, and stops when every rule that takes
first matches is filled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from html import unescape
from operator import methodcaller
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
_NONE: frozenset[str] = frozenset()
_NO_ATTRIBUTES: dict[str, str] = {}
_STEP = re.compile(r'([\w-]*)((?:\.[\w-]+)*)(?:\[([\w-]+)(?:\*="([^"]*)")?\])?')
# Quotes hold a value only after an equals sign. No part is read twice, so a tag takes time by its length.
_VALUE = r"""\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)"""
_INSIDE = rf"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_VALUE})?+)*+>"
_TEXT = r"<(?![A-Za-z/!?])[^<]*+"
# Tags as most are written; text, which goes on over a "<" that begins no tag; scripts and styles with
# what is in them; other tags; comments; and what the page breaks off in, to its end.
_TOKENS = re.compile(
    rf'</?(?!(?i:script|style))[A-Za-z][\w-]*+(?: [\w-]++="[^"]*+")*+>|(?:[^<]++|{_TEXT})(?:{_TEXT})*+'
    rf"|<(?i:script)(?=[\s/>]){_INSIDE}(?<!/>)(?s:.*?)(?=</(?i:script)[\s/>]|\Z)|<(?i:style)(?=[\s/>]){_INSIDE}(?<!/>)(?s:.*?)(?=</(?i:style)[\s/>]|\Z)"
    rf"|</?[A-Za-z][^\s/>]*+{_INSIDE}|<!--(?s:.*?)-->|<(?![A-Za-z]|/[A-Za-z]|!--)[^>]*+>|<(?s:.*)"
)
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*+)")
_WHOLE = re.compile(rf"<[A-Za-z][^\s/>]*+{_INSIDE}")
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))?+""")
_RAW = ("script", "style")
#: Tags whose reading a task keeps, and their length; then it starts anew.
_MOST_KEPT, _LONGEST_KEPT = 20_000, 300


def _attributes(tag: str) -> dict[str, str]:
    """Attributes of a tag; of one given twice the first counts."""
    found: dict[str, str] = {}
    for key, value in _ATTRIBUTE.findall(tag, _NAME.match(tag).end(), _WHOLE.match(tag).end() - 1):
        if value[:1] in ('"', "'"):
            value = value[1:-1]
        found.setdefault(key.lower(), unescape(value) if "&" in value else value)
    return found


@dataclass(frozen=True)
class _Step:
    tag: str
    classes: frozenset[str]
    attribute: str | None
    part: str | None

    def fits(self, tag: str, has: dict[str, str], classes: set[str]) -> bool:
        return (
            (not self.tag or self.tag == tag)
            and self.classes <= classes
            and (self.attribute is None or self.attribute in has)
            and (self.part is None or self.part in has[self.attribute])
        )


def steps_of(css: str) -> list[list[_Step]]:
    """'div.a b[href], p' as alternatives of descendant steps."""
    def step(part: str) -> _Step:
        match = _STEP.fullmatch(part)
        if not match:
            raise ValueError(f"unsupported selector: {part}")
        tag, classes, attribute, inside = match.groups()
        return _Step(tag, frozenset(classes.split(".")[1:]), attribute, inside)

    return [[step(part) for part in path.split()] for path in css.split(",")]


class Page:
    """What a run over a page has come to: open elements, texts so far, what rules have taken and how many want more."""

    __slots__ = ("open", "texts", "state", "wanting", "at_end", "raw", "has")

    def __init__(self, slots: int, wanting: int, outside: tuple):
        self.open = [outside]  # (tag, steps reached on the way to it, texts before it, how many are open)
        self.texts: list[str] = []
        self.state: list[Any] = [None] * slots
        self.wanting = wanting
        self.at_end: dict[int, list[_Span | _Leave]] = {}  # by place among the open elements
        self.raw: str | None = None  # of a script or style: what is in it
        self.has: dict[str, str] = {}  # the attributes of a match

    def then(self, place: int, what: _Span | _Leave) -> None:
        """Has ``what`` finished when the element at a place ends."""
        if place in self.at_end:
            self.at_end[place].append(what)
        else:
            self.at_end[place] = [what]

    def close(self, place: int) -> None:
        for what in self.at_end.pop(place):
            what.finish()


class _Leave:
    """Something to do when an element ends."""

    __slots__ = ("finish",)

    def __init__(self, finish: Callable[[], None]):
        self.finish = finish


class _Span:
    """The texts inside an element, from its start to its end."""

    __slots__ = ("page", "start", "end", "raw", "fills", "read")

    def __init__(self, page: Page, place: int, fills: bool = False):
        """Of the element that is about to be opened, or of an open one. With ``fills`` its end fills the rule."""
        self.page, self.fills, self.read = page, fills, None
        if place < len(page.open):
            self.start, self.raw = page.open[place][2], None
        else:
            self.start, self.raw = len(page.texts), page.raw
        page.then(place, self)

    def finish(self) -> None:
        self.end = len(self.page.texts)
        if self.fills:
            self.page.wanting -= 1

    def text(self, glue: str) -> str | None:
        """Text inside, whitespace collapsed; None if there is none."""
        if self.read is None or self.read[0] != glue:
            pieces = self.page.texts[self.start:self.end]
            whole = glue.join(pieces)
            if "&" in whole:
                whole = glue.join([unescape(t) if "&" in t else t for t in pieces])
            self.read = glue, " ".join((whole if self.raw is None else self.raw).split()) or None
        return self.read[1]


#: What a rule does at a match: the page so far, and the place that the element is about to get.
Take = Callable[[Page, int], None]


class Reader:
    """The automaton of some rules. ``read`` gives what each of them takes from a page."""

    def __init__(self, rules: Sequence[Rule]):
        self.steps: list[_Step] = []
        self.firsts = self.slots = self.watched = 0
        self.ends: dict[str, int] = {}  # of a selector: the bits of its last steps
        self.watch: list[tuple[int, Take]] = []
        self.takes_of: dict[int, list[Take]] = {}  # by the watched bits of a match
        self.kept: dict[str, tuple] = {}
        self.open_of: dict[str, list[int]] = {}  # of each tag: how many are open
        self.values = [rule.build(self) for rule in rules]
        self.wanting = len(rules) if all(rule.first_only for rule in rules) else -1
        self.of_any = [k for k, step in enumerate(self.steps) if not step.tag]
        self.of_tag = {step.tag: [k for k, s in enumerate(self.steps) if s.tag in ("", step.tag)] for step in self.steps if step.tag}

    def slot(self) -> int:
        """A place for what a rule keeps of a page; empty at its start."""
        self.slots += 1
        return self.slots - 1

    def at(self, css: str, take: Take) -> None:
        """Has ``take`` called at the matches of a selector, before those that are given later."""
        if css not in self.ends:
            ends = 0
            for path in steps_of(css):
                self.firsts |= 1 << len(self.steps)
                self.steps += path
                ends |= 1 << (len(self.steps) - 1)
            self.ends[css] = ends
        self.watch.append((self.ends[css], take))
        self.watched |= self.ends[css]

    def token(self, raw: str) -> tuple:
        """Of a tag: its name, the steps that fit it (-1 for an end tag, -2 for what is none), whether it stays open, what it ends, how many are open and its attributes."""
        found = _NAME.match(raw)
        name = found[1].lower() if found and raw.endswith(">") or found and found[1].lower() in _RAW else ""
        if not name:
            return "", -2, False, _NONE, [0], _NO_ATTRIBUTES
        count = self.open_of.setdefault(name, [0])
        if raw[1] == "/":
            facts = name, -1, False, _NONE, count, _NO_ATTRIBUTES
        else:
            whole = _WHOLE.match(raw)
            if whole is None:  # the page breaks off in it
                return "", -2, False, _NONE, [0], _NO_ATTRIBUTES
            has = _attributes(raw) if whole.end() > found.end() + 1 else _NO_ATTRIBUTES
            classes, fits = set(has.get("class", "").split()), 0
            for k in self.of_tag.get(name, self.of_any):
                if self.steps[k].fits(name, has, classes):
                    fits |= 1 << k
            stays = name not in _EMPTY and raw[whole.end() - 2] != "/"
            facts = name, fits, stays, _ENDS.get(name, _NONE), count, has if fits else _NO_ATTRIBUTES
        if len(raw) <= _LONGEST_KEPT:
            if len(self.kept) > _MOST_KEPT:
                self.kept.clear()
            self.kept[raw] = facts
        return facts

    def read(self, html: str) -> tuple:
        page = Page(self.slots, self.wanting, ("", 0, 0, [0]))
        self._run(html, page)
        for place in sorted(page.at_end, reverse=True):
            page.close(place)
        for element in page.open:
            element[3][0] = 0
        taken = tuple([value(page) for value in self.values])
        page.state.clear()  # spans and pages hold each other, and would wait for the collector
        return taken

    def _run(self, html: str, page: Page) -> None:
        open_, at_end, firsts, watched = page.open, page.at_end, self.firsts, self.watched
        add_text, kept = page.texts.append, self.kept.get
        texts, takes_of = page.texts, self.takes_of
        # One by one where the page need not be read to its end.
        for raw in _TOKENS.findall(html) if page.wanting < 0 else map(methodcaller("group"), _TOKENS.finditer(html)):
            if raw[0] != "<":
                add_text(raw)
                continue
            name, fits, stays, ends, count, has = kept(raw) or self.token(raw)
            if fits < 0:
                if fits == -2:
                    if raw[1:2] not in "!?/" and not raw[1:2].isalpha():
                        add_text(raw)
                elif count[0]:
                    closed = None
                    while closed != name:
                        closed, _, _, n = open_.pop()
                        n[0] -= 1
                        if at_end and len(open_) in at_end:
                            page.close(len(open_))
                    if not page.wanting:
                        return
                continue
            while open_[-1][0] in ends:
                open_.pop()[3][0] -= 1
                if at_end and len(open_) in at_end:
                    page.close(len(open_))
            reached = open_[-1][1]
            new = fits and fits & (firsts | reached << 1)
            if seen := new & watched:
                page.has = has
                page.raw = raw[_WHOLE.match(raw).end():] if name in _RAW else None
                place = len(open_)
                if seen not in takes_of:
                    takes_of[seen] = [take for bits, take in self.watch if seen & bits]
                for take in takes_of[seen]:
                    take(page, place)
                if not stays and place in at_end:
                    page.close(place)
                if not page.wanting:
                    return
            if stays:
                open_.append((name, reached | new, len(texts), count))
                count[0] += 1


@dataclass(frozen=True)
class Rule:
    """The Spark type of what is taken from a page, and what puts it into a reader: it gives what makes the value of a page.

    A rule that takes ``first_only`` has to lower ``Page.wanting`` once when it is filled.
    """

    type: str
    build: Callable[[Reader], Callable[[Page], Any]]
    first_only: bool = False


_INSIDE_OF, _LEFT = 1, 2


def text(css: str, within: str | None = None, glue: str = " ", parent: bool = False) -> Rule:
    """Text of the first match; ``within`` the first match of another selector, if given."""
    def build(reader: Reader) -> Callable[[Page], Any]:
        found, block = reader.slot(), _block(reader, within)

        def take(page: Page, place: int) -> None:
            if page.state[found] is None and (within is None or page.state[block] == _INSIDE_OF):
                page.state[found] = _Span(page, place - parent, fills=within is None)

        reader.at(css, take)
        _watch_block(reader, within, block)
        return lambda page: page.state[found] and page.state[found].text(glue)

    return Rule("string", build, first_only=True)


def _block(reader: Reader, within: str | None) -> int | None:
    return reader.slot() if within else None


def _watch_block(reader: Reader, within: str | None, block: int | None) -> None:
    """Keeps whether the first match of ``within`` is open; a rule is filled when it ends."""
    def take(page: Page, place: int) -> None:
        if page.state[block] is None:
            page.state[block] = _INSIDE_OF
            page.then(place, _Leave(lambda: leave(page)))

    def leave(page: Page) -> None:
        page.state[block] = _LEFT
        page.wanting -= 1

    if within:
        reader.at(within, take)


def texts(css: str, inner: str | None = None, glue: str = " ") -> Rule:
    """Texts of all matches, or of the first ``inner`` match in each."""
    def build(reader: Reader) -> Callable[[Page], Any]:
        if inner is None:
            found = reader.slot()

            def take(page: Page, place: int) -> None:
                if page.state[found] is None:
                    page.state[found] = []
                page.state[found].append(_Span(page, place))

            reader.at(css, take)
            return lambda page: [t for t in (span.text(glue) for span in page.state[found] or ()) if t]
        items = _items(reader, css, [inner])
        return lambda page: [t for t in (span.text(glue) for span, in page.state[items] or () if span) if t]

    return Rule("array<string>", build)


def _items(reader: Reader, css: str, parts: list[str]) -> int:
    """The slot of a list for each match of a selector: the first match in it of each of the parts."""
    items = reader.slot()
    lacking = [reader.slot() for _ in parts]  # open matches without that part; what is opened later leaves earlier

    def take_part(k: int, slot: int) -> Take:
        def take(page: Page, place: int) -> None:
            if page.state[slot]:
                span = _Span(page, place)
                for item in page.state[slot]:
                    item[k] = span
                page.state[slot] = []
        return take

    def take_item(page: Page, place: int) -> None:
        item: list[_Span | None] = [None] * len(parts)
        if page.state[items] is None:
            page.state[items] = []
        page.state[items].append(item)
        for slot in lacking:
            if page.state[slot] is None:
                page.state[slot] = []
            page.state[slot].append(item)
        page.then(place, _Leave(lambda: leave(page, item)))

    def leave(page: Page, item: list) -> None:
        for slot in lacking:
            if page.state[slot] and page.state[slot][-1] is item:
                page.state[slot].pop()

    for k, (part, slot) in enumerate(zip(parts, lacking)):
        reader.at(part, take_part(k, slot))
    reader.at(css, take_item)
    return items


def values(css: str, attribute: str, within: str | None = None) -> Rule:
    """One attribute of all matches, trimmed, empty ones left out."""
    def build(reader: Reader) -> Callable[[Page], Any]:
        found, block = reader.slot(), _block(reader, within)

        def take(page: Page, place: int) -> None:
            if within is None or page.state[block] == _INSIDE_OF:
                value = page.has.get(attribute, "").strip()
                if value:
                    if page.state[found] is None:
                        page.state[found] = []
                    page.state[found].append(value)

        reader.at(css, take)
        _watch_block(reader, within, block)
        return lambda page: page.state[found] or []

    return Rule("array<string>", build, first_only=within is not None)


def present(css: str) -> Rule:
    def build(reader: Reader) -> Callable[[Page], Any]:
        found = reader.slot()

        def take(page: Page, place: int) -> None:
            if page.state[found] is None:
                page.state[found] = True
                page.wanting -= 1

        reader.at(css, take)
        return lambda page: page.state[found] is True

    return Rule("boolean", build, first_only=True)


def pairs(css: str, label: str, value: str, needs: str | None = None) -> Rule:
    """label → value out of each match that has both, and ``needs`` if given."""
    def build(reader: Reader) -> Callable[[Page], Any]:
        items = _items(reader, css, [part for part in (label, value, needs) if part])

        def made(page: Page) -> dict[str, str]:
            found: dict[str, str] = {}
            for item in page.state[items] or ():
                if None not in item:
                    name, content = (end.text("") for end in item[:2])
                    if name and content:
                        found[name] = content
            return found

        return made

    return Rule("map<string,string>", build)
