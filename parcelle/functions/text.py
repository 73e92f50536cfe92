"""Text, number and name clean-up."""

from __future__ import annotations

import functools
import json
import sys
import unicodedata
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelle import fixed_values as V

# Whitespace as Unicode has it, no-break space and the four separators included.
BLANKS = r"(?U)[\s\x1c-\x1f]+"
NO_BREAK_SPACE = " "


def clean_text(text: Column) -> Column:
    """Every run of whitespace becomes one space; nothing left becomes NULL."""
    return F.nullif(collapse_blanks(text), F.lit(""))


def collapse_blanks(text: Column) -> Column:
    """Like :func:`clean_text`, but an empty text stays an empty text."""
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def price_from_text(text: Column) -> Column:
    """Digits and points of a price text as a double; no number, no price."""
    return F.regexp_replace(text, "[^0-9.]", "").try_cast("double")


def positive_price(price: Column) -> Column:
    """Prices of zero or less are not prices."""
    return F.when(price > 0, price)


def price_label(price: Column) -> Column:
    """A price rounded to whole units, without separators or exponent."""
    return price.try_cast("decimal(38,0)").cast("string")


def first_number(text: Column) -> Column:
    """The first run of digits and blanks as an integer; NULL if it is not one."""
    spaced = _plain_digits(F.replace(text, F.lit(NO_BREAK_SPACE), F.lit(" ")))
    run = F.regexp_extract(spaced, r"(?U)[\d\s\x1c-\x1f]+", 0)
    return F.replace(run, F.lit(" "), F.lit("")).try_cast("bigint")


def has_text(text: Column) -> Column:
    """Neither missing nor blank."""
    return F.coalesce(F.trim(text) != "", F.lit(False))


def seller_name(name: Column, placeholders: Iterable[str]) -> Column:
    """Lower-case seller; missing, blank and placeholder names become 'unknown'."""
    tidy = F.lower(F.trim(name))
    usable = (tidy != "") & ~tidy.isin(*placeholders)
    return F.when(usable, tidy).otherwise(V.UNKNOWN_SELLER)


def id_from_url(url: Column, pattern: str) -> Column:
    """First group of ``pattern`` in the address, NULL without a match."""
    return F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))


def absolute_url(href: Column, base: Column | str) -> Column:
    """``href`` as seen from the root page of ``base``; steps such as ``./`` and ``../`` are taken."""
    root = F.lit(base) if isinstance(base, str) else base
    scheme = F.regexp_extract(root, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    path = F.regexp_extract(href, "^[^?#]*", 0)
    rest = F.substring(href, F.length(path) + 1, F.length(href))
    rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    walked = F.when(rooted.rlike(r"/\.{1,2}(/|$)"), _walked(rooted)).otherwise(rooted)
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(path == "", F.concat(root, href))
        .otherwise(F.concat(root, walked, rest))
    )


def _walked(path: Column) -> Column:
    """A path from the root with its ``.`` and ``..`` steps taken; steps above the root stay there."""
    steps = F.split(path, "/", -1)

    def take(done: Column, step: Column) -> Column:
        back = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(step == "..", back).when(step == ".", done).otherwise(F.concat(done, F.array(step)))

    start = F.slice(steps, 1, 1)
    walked = F.aggregate(F.slice(steps, F.lit(2), F.size(steps)), start, take)
    ends_open = F.element_at(steps, -1).isin(".", "..")
    return F.concat(F.array_join(walked, "/"), F.when(ends_open, "/").otherwise(""))


def ascii_fold(text: Column) -> Column:
    """Compatibility decomposition with everything outside ASCII dropped.

    Characters that fold to one ASCII character go through ``translate``, which is
    all that Latin labels need. The few that fold to several (ligatures, fractions,
    ...) are looked up one by one, in texts that have any. Both tables follow from
    the Unicode data by rule.
    """
    source, target, longer = _fold_tables()
    outside = r"[^\x00-\x7F]"
    single = F.translate(text, source, target)
    several = literal_map(longer)
    spelled = F.array_join(
        F.transform(F.split(single, ""), lambda c: F.coalesce(several[c], c)), ""
    )
    return (
        F.when(~text.rlike(outside), text)
        .when(~single.rlike(outside), single)
        .otherwise(F.regexp_replace(
            F.when(single.rlike(_one_of(longer)), spelled).otherwise(single), outside, ""
        ))
    )


def literal_map(entries: Mapping[str, str]) -> Column:
    """A constant map, handed over as one text, which Spark folds while planning."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def _one_of(chars: Iterable[str]) -> str:
    """Pattern for any one of the characters, runs of neighbours as ranges."""
    points = sorted(map(ord, chars))
    starts = [p for i, p in enumerate(points) if i == 0 or points[i - 1] != p - 1]
    ends = [p for i, p in enumerate(points) if i + 1 == len(points) or points[i + 1] != p + 1]
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in zip(starts, ends)) + "]"


def column_name(label: Column) -> Column:
    """A label as a lower-case ASCII identifier; a label without Latin letters or digits gives ''."""
    joined = F.regexp_replace(ascii_fold(label), "[^0-9a-zA-Z]+", "_")
    return F.lower(F.btrim(joined, F.lit("_")))


def label_to_column(label: str) -> str:
    """:func:`column_name` for a label known while the plan is built."""
    folded = unicodedata.normalize("NFKD", label).encode("ascii", "ignore").decode()
    words = "".join(c if c.isalnum() else " " for c in folded).split()
    return "_".join(words).lower()


@functools.lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    source, target, longer = [], [], {}
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        if not unicodedata.decomposition(char):
            continue
        folded = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(folded) == 1:
            source.append(char)
            target.append(folded)
        elif folded:
            longer[char] = folded
    return "".join(source), "".join(target), longer


@functools.lru_cache(maxsize=1)
def _digit_tables() -> tuple[str, str]:
    digits = [
        chr(point)
        for point in range(0x80, sys.maxunicode + 1)
        if unicodedata.category(chr(point)) == "Nd"
    ]
    return "".join(digits), "".join(str(unicodedata.decimal(d)) for d in digits)


def _plain_digits(text: Column) -> Column:
    """Decimal digits of any script as 0-9."""
    return F.translate(text, *_digit_tables())
