"""Reading flat parts of HTML text without leaving the JVM.

Enough for tags known by name and attributes; elements known by what surrounds
them need :mod:`parcelle.operators.page_rules`.
"""

from __future__ import annotations

import functools
from html import unescape as unescape_text
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelle.functions.text import literal_map

# Comments, scripts and styles may hold anything that looks like a tag.
_HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"

# A reference, as a browser reads it: a number, or a name, of which a few old ones go without ';'.
_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?"
# By far the most frequent ones, looked at before all others.
_FREQUENT = ("&amp;", "&lt;", "&gt;", "&quot;", "&#39;", "&nbsp;", "&eacute;")
_LAST_POINT = 0x10FFFF


@functools.lru_cache(maxsize=1)
def _named() -> dict[str, str]:
    """Characters of all named references, from the standard library's table."""
    return {f"&{name}": chars for name, chars in html5.items()}


@functools.lru_cache(maxsize=1)
def _renumbered() -> dict[str, str]:
    """Numbers that browsers read as others: those of the control characters that an old code page had letters for."""
    points = {}
    for number in range(0x80, 0xA0):
        letter = bytes([number]).decode("cp1252", "ignore")
        if letter:
            points[str(number)] = str(ord(letter))
    return points


def _character(reference: Column) -> Column:
    body = F.rtrim(reference, F.lit(";"))
    hexadecimal = F.lower(F.substring(body, 2, 2)) == "#x"
    digits = F.ltrim(F.when(hexadecimal, F.substring(body, 4, 1 << 20)).otherwise(F.substring(body, 3, 1 << 20)), F.lit("0"))
    short = F.length(digits) <= 8
    number = F.when(short & hexadecimal, F.conv(digits, 16, 10)).when(short, digits)
    number = F.coalesce(literal_map(_renumbered())[number], number).try_cast("long")
    valid = number.between(1, _LAST_POINT) & ~number.between(0xD800, 0xDFFF)
    point = F.when(F.coalesce(valid, F.lit(False)), number).otherwise(0xFFFD)
    numeric = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    known = F.when(F.lit(False), reference)
    for frequent in _FREQUENT:
        known = known.when(reference == frequent, unescape_text(frequent))
    return known.when(F.substring(reference, 2, 1) == "#", numeric).otherwise(F.coalesce(literal_map(_named())[reference], reference))


def unescape(text: Column) -> Column:
    """A text with all character references, named and numeric, as the characters they stand for."""
    references = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    between = F.split(text, _REFERENCE, -1)
    ends = F.concat(F.transform(references, _character), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(between, ends, lambda piece, end: F.concat(piece, end)), "")
    return F.when(text.contains("&"), joined).otherwise(text)


def visible(html: Column) -> Column:
    """A page without comments, scripts and styles."""
    return F.regexp_replace(html, _HIDDEN, "")


def attribute_values(html: Column, tag: str, attribute: str) -> Column:
    """Values of one attribute over all tags of a name, in page order.

    Values stand in double quotes, in single quotes or in none; of an attribute given
    twice in a tag the first counts.
    """
    tags = F.regexp_extract_all(visible(html), F.lit(rf"""(?i)<{tag}(?=[\s/])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""), F.lit(0))
    part = F.lit(r"""([^\s=>"'/<]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")

    def value(tag_text: Column) -> Column:
        names = F.transform(F.regexp_extract_all(tag_text, part, F.lit(1)), F.lower)
        given = F.regexp_extract_all(tag_text, part, F.lit(2))
        return F.get(given, (F.array_position(names, attribute) - 1).cast("int"))

    def bare(quoted: Column) -> Column:
        in_quotes = quoted.startswith('"') | quoted.startswith("'")
        return F.when(in_quotes, F.substring(quoted, F.lit(2), F.length(quoted) - 2)).otherwise(quoted)

    found = F.filter(F.transform(tags, value), lambda v: v.isNotNull())
    return F.transform(found, lambda v: F.trim(unescape(bare(v))))


def element_texts(html: Column, tag: str) -> Column:
    """Texts of all elements of a name that do not contain one another, tags taken out."""
    pattern = rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"
    found = F.regexp_extract_all(visible(html), F.lit(pattern), F.lit(1))
    return F.transform(found, lambda inner: unescape(F.regexp_replace(inner, "<[^>]*>", "")))
