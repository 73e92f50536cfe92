"""Personal data: fixed patterns, and identifiers that the same contexts as theirs give away.

The matches of fixed patterns are seeds. Mentions are seeds, words with a digit, numbers written in
several words, and words around a written-out @. A lexical pattern is the word before a mention and
its outline, the outline and the word after, or both words and only whether it has letters.
Patterns and the different strings seen in them form a graph; Spark scores its two sides in
turn: a pattern by the share of its strings that are known, a string by the best pattern it is
seen in.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import by_batch, cut, documents, texts
from parcelle.llm.secrets import SPANS, _SPAN, count_of, ordered, written

# Kinds in their order, and their patterns.
BASE_KINDS = ("email", "ip", "card", "phone")
LOCAL, DOMAIN = re.compile(r"[A-Za-z0-9._%+-]++"), re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")  # an @ between them
#: From the first digit of a number only: from another one it would end alike.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Discovered spans are of kinds of their own, after the fixed ones.
KINDS = (*BASE_KINDS, *(f"like_{kind}" for kind in BASE_KINDS))
ROUNDS = 3
#: A pattern counts if so many different strings were seen in it and its score is so high.
LEAST_STRINGS = 5
LEAST_SCORE = 0.8

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = "\"'`.,;:!?()[]{}<>|*#$%&="
_DIGIT = re.compile(r"[0-9]")
_LETTERS = re.compile(r"[^\W\d_]+")
#: Words that a written number may be made of, and how many digits it has.
_NUMERIC = re.compile(r"[0-9+().-]+")
LEAST_DIGITS, MOST_DIGITS = 7, 19
#: An @ written out, as a word or between two.
_AT = re.compile(r"(?<![^\x20\x09-\x0D])(?:[(\[{<]\x20?at\x20?[)\]}>])(?![^\x20\x09-\x0D])", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        v = int(d) * (1 + at % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """From each @ back over the local part and on over the domain, so that no run of characters is read twice."""
    found, done, sign = [], 0, text.find("@")
    while sign >= 0:
        local = LOCAL.match(text[done:sign][::-1])
        domain = local and DOMAIN.match(text, sign + 1)
        if domain:
            found.append((sign - local.end(), domain.end()))
        done = domain.end() if domain else sign + 1
        sign = text.find("@", done)
    return found


def seeds(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, kind by kind."""
    found = [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return found


def outline(mention: str) -> str:
    """Digits as 9, runs of letters as a; signs as they are."""
    return _LETTERS.sub("a", _DIGIT.sub("9", mention))


def mentions(text: str, found: list) -> list[dict]:
    """Seeds, and other words with a digit, each with its outline and its neighbours."""
    if not (found or _DIGIT.search(text) or _AT.search(text)):
        return []
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    starts = [a for a, _ in words]
    taken = sorted((a, b) for _, a, b in found)
    spans = [(kind, a, b) for kind, a, b in found]
    def free(a: int, b: int) -> bool:
        at = bisect_right(taken, (b,)) - 1
        return not any(x < b and a < y for x, y in taken[max(0, at - 4):at + 2])

    for sign in _AT.finditer(text):
        at = bisect_right(starts, sign.start()) - 1
        after = bisect_right(starts, sign.end() - 1)
        if at > 0 and after < len(words) and free(words[at - 1][0], words[after][1]):
            spans.append((None, words[at - 1][0], words[after][0] + len(text[slice(*words[after])].rstrip(_EDGES))))
    in_run = tried = 0  # words up to there are in a written number, or in a run that is none
    for k, (a, b) in enumerate(words):
        word = text[a:b]
        if k < in_run or not _DIGIT.search(word):
            continue
        if k >= tried:
            tried = k
            while tried < len(words) and _NUMERIC.fullmatch(text, *words[tried]):
                tried += 1
            if tried > k + 1:
                inner = text[a:words[tried - 1][1]].rstrip(_EDGES)
                if LEAST_DIGITS <= sum(map(str.isdigit, inner)) <= MOST_DIGITS and free(a, a + len(inner)):
                    spans.append((None, a, a + len(inner)))
                    in_run = tried
                    continue
        inner = word.strip(_EDGES)
        a += word.find(inner)
        b = a + len(inner)
        if len(inner) >= 4 and free(a, b):
            spans.append((None, a, b))
    out = []
    for kind, a, b in spans:
        first = bisect_right(starts, a) - 1
        last = bisect_right(starts, b - 1)
        before = text[slice(*words[first - 1])] if first > 0 else ""
        after = text[slice(*words[last])] if last < len(words) else ""
        shape = outline(text[a:b])
        out.append({
            "kind": kind, "start": a, "end": b, "name": text[a:b],
            "left": f"{before.lower().strip(_EDGES)} {shape}", "right": f"{shape} {after.lower().strip(_EDGES)}",
            "both": f"{before.lower().strip(_EDGES)} {'<letters>' if _LETTERS.search(text, a, b) else '<digits>'} {after.lower().strip(_EDGES)}" if before and after else None,
        })
    return out


_MENTION = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("left", pa.string()), ("right", pa.string()), ("both", pa.string())]))


def _read(batch: pa.RecordBatch) -> pa.RecordBatch:
    base, seen = [], []
    for text in texts(batch.column(1)):
        found = seeds(text)
        base.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
        seen.append(mentions(text, found))
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, _SPAN), pa.array(seen, _MENTION)], ["key", "base", "seen"])


def discovered(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Strings (``name``, ``kind``) found by patterns, from edges (pattern, name, kind of a seed or NULL).

    Each round scores a pattern for a kind by the summed scores of its different strings over
    their number plus one, and a string by its best pattern that counts. Seeds score 1.
    """
    # Each edge once; a string that is a seed anywhere is one everywhere.
    distinct = edges.groupBy("pattern", "name").agg(F.max("kind").alias("kind"))
    sizes = distinct.groupBy("pattern").agg(F.count("*").alias("strings")).where(F.col("strings") >= LEAST_STRINGS)
    # Only patterns that hold a seed can ever count, and only strings in two patterns pass scores on.
    graph = cut(distinct.join(sizes, "pattern"))
    known = graph.where("kind IS NOT NULL").select("name", F.col("kind").alias("as_kind"), F.lit(1.0).alias("score")).distinct()
    fresh = None
    for _ in range(rounds):
        scored = known if fresh is None else known.unionByName(fresh)
        patterns = (
            graph.join(scored, "name").groupBy("pattern", "strings", "as_kind").agg(F.sum("score").alias("sum"))
            .select("pattern", "as_kind", (F.col("sum") / (F.col("strings") + 1)).alias("score")).where(F.col("score") >= LEAST_SCORE)
        )
        fresh = cut(
            graph.where("kind IS NULL").join(patterns, "pattern").groupBy("name", "as_kind").agg(F.max("score").alias("score"))
        )
    best = fresh.groupBy("name").agg(F.max(F.struct("score", "as_kind")).alias("best"))
    return best.select("name", F.concat(F.lit("like_"), F.col("best.as_kind")).alias("found"))


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of ``docs``: key, ``base`` and ``spans`` (kind, start, end; code points).

    ``base`` are the spans of the fixed patterns, by kind, then start; ``spans`` also the
    mentions of discovered strings. A missing or empty text has none; repeated rows each get a
    row and count once in the graph; an empty table gives an empty result; other columns are
    ignored. A text with spans of equal start keeps them all, in the order of kinds.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    mention = "array<struct<kind:string,start:long,end:long,name:string,left:string,right:string,both:string>>"
    found = cut(by_batch(rows, lambda: _read, f"key {kind}, base {SPANS}, seen {mention}").withColumn("row", F.monotonically_increasing_id()))
    seen = found.select("row", F.explode("seen").alias("m")).select("row", "m.*")
    edges = seen.select("name", "kind", F.explode(F.array("left", "right", "both")).alias("pattern")).where("pattern IS NOT NULL")
    new = seen.where("kind IS NULL").join(discovered(edges, rounds), "name")
    spans = new.groupBy("row").agg(F.collect_list(F.struct(F.col("found").alias("kind"), "start", "end")).alias("more"))
    merged = found.join(spans, "row", "left")
    every = F.concat(F.col("base"), F.coalesce(F.col("more"), F.array().cast(SPANS)))
    return merged.select(F.col("key").alias(key), ordered(F.col("base"), KINDS, True).alias("base"), ordered(every, KINDS, True).alias("spans"))


def op3_personal_data(spark, sf_dir: str) -> DataFrame:
    found = personal_data(documents(spark, sf_dir))
    return found.select(
        "doc_id", *(count_of(F.col("base"), k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
    )
