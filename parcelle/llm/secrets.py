"""Secret scan: fixed patterns, and strings that a battery of randomness tests can't tell from random.

For each long token an encoding is inferred. Its symbols are tested for uniform use of the
alphabet (chi-squared), for runs above and below the middle, and for serial correlation. A
token that passes is a discovery if ordinary writing is also an unlikely source. How unlikely
falls with its length, and the limit is set by false-discovery control over all tokens tested
in the corpus.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import by_batch, cut, documents, texts
from parcelle.llm.quality import chi2_share

# Kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
LEAST_VALUE = 6
# A run that is too short has no part that is long enough, so the lengths can stand in the patterns.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets from the narrowest to the widest; a token has the first that holds all its symbols.
ENCODINGS = {
    "decimal": DIGITS,
    "hex": DIGITS + LOWER[:6],
    "hex_upper": DIGITS + UPPER[:6],
    "base32": UPPER + "234567",
    "base36": DIGITS + LOWER,
    "base36_upper": DIGITS + UPPER,
    "base62": UPPER + LOWER + DIGITS,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64_url": UPPER + LOWER + DIGITS + "-_",
    "any": UPPER + LOWER + DIGITS + "+/-_",
}
_SETS = {name: (frozenset(symbols), {c: i for i, c in enumerate(symbols)}) for name, symbols in ENCODINGS.items()}

#: How ordinary writing goes on: chance of the class of the next symbol by that of the last one.
_CLASS = {**dict.fromkeys(LOWER, "l"), **dict.fromkeys(UPPER, "u"), **dict.fromkeys(DIGITS, "d"), **dict.fromkeys("+/-_", "s")}
_SIZE = {"l": 26, "u": 26, "d": 10, "s": 4}
_NEXT = {
    "": {"l": 0.60, "u": 0.20, "d": 0.15, "s": 0.05},
    "l": {"l": 0.955, "u": 0.010, "d": 0.010, "s": 0.025},
    "u": {"l": 0.40, "u": 0.50, "d": 0.03, "s": 0.07},
    "d": {"l": 0.03, "u": 0.02, "d": 0.85, "s": 0.10},
    "s": {"l": 0.55, "u": 0.20, "d": 0.20, "s": 0.05},
}
#: Least joint p-value of the battery with which a token still counts as random.
RANDOM_AT = 0.01
#: Share of false ones among the discoveries.
FALSE_SHARE = 1e-4
#: Bits from which on evidence counts as equal, which bounds the rows of its histogram.
MOST_BITS = 1000


def encoding_of(token: str) -> str:
    symbols = set(token)
    return next(name for name, (all_of, _) in _SETS.items() if symbols <= all_of)


def _two_sided(z: float) -> float:
    return max(1e-300, math.erfc(abs(z) / math.sqrt(2)))


def battery(token: str, encoding: str) -> float:
    """Joint p-value (Fisher's method) of the tests under random symbols of the encoding."""
    size, rank = len(ENCODINGS[encoding]), _SETS[encoding][1]
    values = [rank[c] for c in token]
    n = len(values)
    bins = max(2, min(size, n // 5))
    seen, expected = [0] * bins, [0.0] * bins
    for v in values:
        seen[v * bins // size] += 1
    for v in range(size):
        expected[v * bins // size] += n / size
    uniform = sum((s - e) ** 2 / e for s, e in zip(seen, expected))
    p_uniform = max(1e-300, 1 - chi2_share(bins - 1, uniform))

    high = [2 * v >= size for v in values]
    ups = sum(high)
    downs = n - ups
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean = 1 + 2 * ups * downs / n
    spread = (mean - 1) * (mean - 2) / (n - 1)
    p_runs = _two_sided((runs - mean) / math.sqrt(spread)) if spread > 0 else 2.0 ** (1 - n)

    centre = sum(values) / n
    total = sum((v - centre) ** 2 for v in values)
    serial = sum((a - centre) * (b - centre) for a, b in zip(values, values[1:]))
    p_serial = _two_sided((serial / total + 1 / n) * math.sqrt(n)) if total else 1e-300

    joint = -2 * (math.log(p_uniform) + math.log(p_runs) + math.log(p_serial))
    return max(0.0, 1 - chi2_share(6, joint))


def evidence(token: str, encoding: str) -> float:
    """Bits by which random symbols explain the token better than ordinary writing does.

    Ordinary writing reaches b bits with a chance of 2**-b at most (a likelihood ratio), so
    longer tokens can be told apart further.
    """
    bits, last = -len(token) * math.log2(len(ENCODINGS[encoding])), ""
    for c in token:
        kind = _CLASS[c]
        bits -= math.log2(_NEXT[last][kind] / _SIZE[kind])
        last = kind
    return bits


def scan(text: str) -> tuple[list, list, int]:
    """Spans of the fixed patterns, random-looking tokens with their bits, and tokens tested."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    random, tested = [], 0
    for m in TOKEN.finditer(text):
        tested += 1
        token = m[0].rstrip("=")
        if token[1:].islower() and token.isalpha():  # a word, which the letters alone can't tell from random ones
            continue
        if any(start < m.end() and m.start() < end for _, start, end in found):
            continue
        encoding = encoding_of(token)
        bits = evidence(token, encoding)
        if bits > 0 and battery(token, encoding) >= RANDOM_AT:
            random.append({"start": m.start(), "end": m.end(), "bits": bits})
    return found, random, tested


def discovery_limit(counts: dict[int, int], tested: int, false_share: float) -> float:
    """Benjamini-Hochberg over whole bits: least b with 2**-b <= false_share * (tokens of b bits or more) / tested."""
    limit, above = math.inf, 0
    for bits in sorted(counts, reverse=True):
        above += counts[bits]
        if 2.0 ** -bits <= false_share * above / tested:
            limit = bits
    return limit


def ordered(spans: Column, kinds: tuple[str, ...], by_kind_first: bool = False) -> Column:
    """Spans (kind, start, end) in reading order, ties in the order of ``kinds``; or kind by kind."""
    place = F.array(*map(F.lit, kinds))
    keyed = F.transform(spans, lambda s: (
        F.struct(F.array_position(place, s["kind"]).alias("p"), s["start"].alias("a"), s["end"].alias("end"), s["kind"].alias("kind"))
        if by_kind_first else
        F.struct(s["start"].alias("a"), F.array_position(place, s["kind"]).alias("p"), s["end"].alias("end"), s["kind"].alias("kind"))
    ))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["a"].alias("start"), s["end"].alias("end")))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


SPANS = "array<struct<kind:string,start:long,end:long>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_RANDOM = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))


def secret_scan(docs: DataFrame, key: str | Column = "doc_id", text: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``base`` and ``spans`` (kind, start, end; code points).

    ``base`` are the spans of the fixed patterns, ``spans`` also the tokens found random; both
    are sorted by start, then kind. Tokens overlapping a fixed span are left to it. A missing
    or empty text has no spans; repeated rows each get a row, an empty table gives none, and
    other columns are ignored. Of equal tokens all are found or none, as their evidence is equal.
    """
    rows = docs.select((F.col(key) if isinstance(key, str) else key).alias("key"), F.col(text).alias("text"))

    def make():
        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            base, random, tested = zip(*map(scan, texts(batch.column(1))))
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in found] for found in base]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, _SPAN), pa.array(random, _RANDOM), pa.array(tested, pa.int64())],
                ["key", "base", "random", "tested"],
            )
        return turn

    kind = rows.schema["key"].dataType.simpleString()
    found = cut(by_batch(rows, make, f"key {kind}, base {SPANS}, random array<struct<start:long,end:long,bits:double>>, tested long"))

    steps = found.select(F.explode("random").alias("r")).groupBy(F.least(F.floor("r.bits"), F.lit(MOST_BITS)).alias("b")).count()
    limit = discovery_limit(dict(steps.collect()), found.agg(F.sum("tested")).first()[0] or 0, false_share)
    taken = F.transform(
        F.filter("random", lambda r: r["bits"] >= limit),
        lambda r: F.struct(F.lit("random").alias("kind"), r["start"].alias("start"), r["end"].alias("end")),
    )
    name = key if isinstance(key, str) else "key"
    return found.select(F.col("key").alias(name), ordered(F.col("base"), KINDS).alias("base"), ordered(F.concat("base", taken), KINDS).alias("spans"))


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with each span, or run of overlapping spans, replaced by the mask; spans in reading order."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def put(done: Column, span: Column) -> Column:
        before = F.substring(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        return F.when(span["start"] >= done["at"], F.struct(F.concat(done["out"], before, F.lit(mask)).alias("out"), span["end"].alias("at"))).otherwise(
            F.struct(done["out"].alias("out"), F.greatest(done["at"], span["end"]).alias("at")))

    return F.aggregate(spans, start, put, lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))))


def mask_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every secret masked in the text, and ``n_chars``, where there is one, counted anew.

    Rows without secrets stay as they are, missing texts too. Spans depend on the text alone,
    so rows are matched by a digest of it, and each text is joined once however often it occurs.
    """
    digest = F.sha2(F.col(text), 256)
    found = secret_scan(docs, digest, text).where(F.size("spans") > 0).select(F.col("key").alias("_digest"), F.col("spans").alias("_spans"))
    rows = docs.withColumn("_own", digest).join(found.dropDuplicates(["_digest"]), F.col("_own") == F.col("_digest"), "left")
    changed = F.when(F.col("_spans").isNotNull(), masked(F.col(text), F.col("_spans"))).otherwise(F.col(text))
    out = rows.withColumn(text, changed)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_spans").isNotNull(), F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = secret_scan(documents(spark, sf_dir))
    return found.select(
        "doc_id", *(count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
    )
