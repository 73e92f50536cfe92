"""Benchmark decontamination by canonical templates.

Numbers, names and units become typed placeholders, in benchmark items and in documents. Windows
of the canonical words are hashed and joined; a pair of document and item with enough common
windows, in which each slot of the item is filled in one way, is a leak, also where the question
was given other parameters. Plain lower-case windows are looked up beside the canonical ones.
Only windows that pass a bitmap of the benchmark's leave a task; its size follows their number, to a bound.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import Words, cut, documents, hash64, raw_texts, small, windows
from parcelle.llm.grams import Filter, slices

WIDTH = 5
#: Share of an item's windows that have to be found in a document.
LEAST_SHARE = 0.5
#: Share of an item's slot values that may be filled in more than one way.
MOST_MIXED = 0.25
#: Words that are not placeholders in a canonical window; others are taken as they are written.
#: A window of placeholders alone says nothing of an item.
LEAST_PLAIN = 1
BITMAP_BITS = 23

# Words for numbers, and units.
NUMBERS = frozenset(
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen".split())
UNITS = frozenset(
    "mm cm m km inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces ton tons "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years kmh mph "
    "meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters dollar dollars cent cents euro euros percent "
    "degree degrees celsius fahrenheit kelvin joule joules watt watts volt volts newton newtons".split())
_EDGE = b"\"'`.,;:!?()[]{}<>|*#$%&=~^+-/\\_"
_NUMBER = re.compile(rb"[0-9]+(?:[.,:/][0-9]+)*")
_WITH_UNIT = re.compile(rb"[0-9]+(?:[.,][0-9]+)*([a-z]+)")
_NAME, _NUM, _UNIT = (np.uint64(hash64(b"<%s>" % kind)) for kind in (b"name", b"number", b"unit"))


_KINDS = {**dict.fromkeys((w.encode() for w in NUMBERS), int(_NUM)), **dict.fromkeys((w.encode() for w in UNITS), int(_UNIT))}
_AFTER_END = b"\"')]}*#$%&"


def facts(word: bytes) -> tuple:
    """Plain hash, canonical hash, whether canonical is a slot, may be a name, ends a sentence, is no word."""
    if word.isascii():
        inner, bare = word.lower().strip(_EDGE), word.strip(_EDGE)
    else:
        inner, bare = word.decode("utf-8", "replace").lower().encode().strip(_EDGE), word.strip(_EDGE).decode("utf-8", "replace")
    plain = xxhash.xxh3_64_intdigest(inner)
    if inner[:1].isdigit():
        if _NUMBER.fullmatch(inner):
            kind = int(_NUM)
        else:
            unit = _WITH_UNIT.fullmatch(inner)
            kind = int(_NUM ^ _UNIT) if unit and unit[1].decode() in UNITS else plain
    else:
        kind = _KINDS.get(inner, plain)
    title = bare[:1].isupper() and len(bare) > 1 and bare[1:].islower()
    ends = (word if word[-1:] not in _AFTER_END else word.rstrip(_AFTER_END))[-1:] in (b".", b"!", b"?")
    return plain, kind, kind != plain, title, ends, not inner


def word_table() -> Words:
    return Words(facts, [np.uint64, np.uint64, bool, bool, bool, bool])


def canonical(table: Words, text: bytes) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Hashes of the words as written, and two readings of them: canonical words, and which of these are slots.

    Capitalised words that begin a sentence are words in the first reading and names in the second,
    which is left out where there are none.
    """
    at = table.rows(text.split())
    plain, kind, slot, title, ends, empty = (c[at] for c in table.columns)
    first = np.ones(len(at), bool)
    first[1:] = ends[:-1]
    keep = ~empty
    title &= ~slot
    names = [title & ~first] + ([title] if (title & first & keep).any() else [])
    return plain[keep], [(np.where(name, _NAME, kind)[keep], (slot | name)[keep]) for name in names]


def window_forms(table: Words, text: bytes) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Hashes of the words and of the windows as written, and forms: a hash for each window, whether each word is a slot.

    The forms are the canonical windows of either reading, and last the windows as written.
    """
    plain, readings = canonical(table, text)
    width = min(WIDTH, len(plain))
    as_written = windows(plain, WIDTH)
    if not width:
        return plain, as_written, []
    forms = []
    for kind, slot in readings:
        fixed = np.convolve(~slot, np.ones(width, int), "valid")
        forms.append((np.where(fixed >= min(LEAST_PLAIN, width), windows(kind, WIDTH), as_written), slot))
    return plain, as_written, [*forms, (as_written, readings[0][1])]


def _slots(plain: np.ndarray, slot: np.ndarray, at: int) -> list[int]:
    """Fillings of the slots of a window."""
    part = slice(at, at + WIDTH)
    return plain[part][slot[part]].view(np.int64).tolist()


WINDOW = "hash long, place long, is_first boolean, slots array<long>"
_LIST = pa.list_(pa.int64())


def _hits(table: Words, texts: list[bytes], passes) -> list[tuple]:
    """Windows of the texts that ``passes`` lets through: text, hash, place, whether the first of that hash in the text, slot fillings.

    The forms of :func:`window_forms` for all texts at once, in its order.
    """
    split = [t.split() for t in texts]
    at = table.rows(list(chain.from_iterable(split)))
    text = np.repeat(np.arange(len(texts)), [len(words) for words in split])
    plain, kind, slot, title, ends, empty = (c[at] for c in table.columns)
    first = np.ones(len(at), bool)
    first[1:] = ends[:-1] | (text[1:] != text[:-1])
    keep = ~empty
    text, plain, kind, slot, title, first = (c[keep] for c in (text, plain, kind, slot, title & ~slot, first))
    out: list[tuple] = []
    sizes = np.bincount(text, minlength=len(texts))
    for short in np.flatnonzero((sizes > 0) & (sizes < WIDTH)).tolist():
        own, _, forms = window_forms(table, texts[short])
        seen = {}
        for found, slots in forms:
            if passes(found)[0]:
                seen.setdefault(int(found[0].astype(np.int64)), slots)
        out += [(short, value, 0, True, _slots(own, slots, 0)) for value, slots in seen.items()]
    n = len(plain) - WIDTH + 1
    if n <= 0:
        return out

    def many(flags: np.ndarray) -> np.ndarray:
        """How many of the words of each window."""
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[WIDTH:] - sums[:-WIDTH]

    whole = text[:n] == text[WIDTH - 1:]
    as_written = windows(plain, WIDTH)
    name = title & ~first
    slot_1 = slot | name
    form_1 = np.where(many(slot_1) <= WIDTH - LEAST_PLAIN, windows(np.where(name, _NAME, kind), WIDTH), as_written)
    # The second reading differs only in windows with a name at the beginning of a sentence.
    changed = np.flatnonzero(whole & (many(title & first) > 0))
    inside = changed[:, None] + np.arange(WIDTH)
    form_2 = as_written[changed]
    if len(changed):
        few = (slot | title)[inside].sum(1) <= WIDTH - LEAST_PLAIN
        form_2 = np.where(few, windows(np.where(title, _NAME, kind)[inside].ravel(), WIDTH)[::WIDTH], form_2)
    found = [(np.flatnonzero(whole & passes(form_1)), form_1, slot_1), None, (np.flatnonzero(whole & passes(as_written)), as_written, slot_1)]
    passing = np.flatnonzero(passes(form_2))
    places = np.concatenate([found[0][0], changed[passing], found[2][0]])
    if not len(places):
        return out
    values = np.concatenate([form_1[found[0][0]], form_2[passing], as_written[found[2][0]]]).view(np.int64)
    forms = np.repeat([0, 1, 2], [len(found[0][0]), len(passing), len(found[2][0])])
    begins = np.searchsorted(text, np.arange(len(texts)))
    both = slot | title
    seen, known = set(), set()
    for k in np.lexsort((places, forms, text[places])).tolist():
        place, value = int(places[k]), int(values[k])
        if (place, value) in seen:
            continue
        seen.add((place, value))
        own = int(text[place])
        out.append((own, value, place - int(begins[own]), (own, value) not in known, _slots(plain, both if forms[k] == 1 else slot_1, place)))
        known.add((own, value))
    return out


def _windows_of(rows: DataFrame, passes: Filter, schema_head: str) -> DataFrame:
    """Windows (hash, place, whether the first of that hash, slot fillings) of each row (a key, a text) that ``passes`` lets through."""
    shared = rows.sparkSession.sparkContext.broadcast(passes)

    def run(batches):
        table = word_table()
        for batch in batches:
            texts = raw_texts(batch.column(batch.num_columns - 1))
            found = [(a + text, *more) for a, b in slices(texts) for text, *more in _hits(table, texts[a:b], shared.value)]
            index, *made = ([f[k] for f in found] for k in range(5))
            index = pa.array(index, pa.int64())
            kinds = (pa.int64(), pa.int64(), pa.bool_(), _LIST)
            yield pa.RecordBatch.from_arrays(
                [*(c.take(index) for c in batch.columns[:-1]), *map(pa.array, made, kinds)],
                [*batch.schema.names[:-1], "hash", "place", "is_first", "slots"],
            )
    return rows.mapInArrow(run, f"{schema_head}, {WINDOW}")


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Places of each item with the hashes of its forms: item, ``hash``, ``at``, ``literal``, ``item_slots``, ``item_windows`` (places in all)."""
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text"))
    kind = rows.schema["item"].dataType.simpleString()

    def run(batches):
        table = word_table()
        for batch in batches:
            row, hashes, places, literal, slots, sizes = [], [], [], [], [], []
            for i, text in enumerate(raw_texts(batch.column(1))):
                plain, as_written, forms = window_forms(table, text)
                for at in range(len(as_written)):
                    for value, slot in {int(found[at].astype(np.int64)): slot for found, slot in reversed(forms)}.items():
                        row.append(i)
                        hashes.append(value)
                        places.append(at)
                        literal.append(value == int(as_written[at].astype(np.int64)))
                        slots.append(_slots(plain, slot, at))
                        sizes.append(len(as_written))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(hashes, pa.int64()), pa.array(places, pa.int64()), pa.array(literal, pa.bool_()), pa.array(slots, _LIST), pa.array(sizes, pa.int64())],
                ["item", "hash", "at", "literal", "item_slots", "item_windows"],
            )
    return rows.mapInArrow(run, f"item {kind}, hash long, at long, literal boolean, item_slots array<long>, item_windows long").dropDuplicates(["item", "hash", "at"])


def bitmap_of(hashes: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """Which of 2**bits numbers occur as the low bits of ``hash``: a fixed number of bytes, whatever the table."""
    low = hashes.select(F.col("hash").bitwiseAND(F.lit((1 << bits) - 1)).alias("low"))
    rows = low.groupBy(F.expr("bitmap_bucket_number(low)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(low))").alias("map"))
    # Buckets hold 32,768 numbers and are counted from 1; number 0 is in bucket 0.
    found = np.zeros((1 << bits) + (1 << 16), bool)
    for bucket, raw in rows.collect():
        on = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(raw), np.uint8), bitorder="little"))
        found[(bucket - 1) * 32768 + on + 1 if bucket > 0 else on] = True
    return found[:1 << bits]


def _fillings(found: DataFrame, by: list[str]) -> DataFrame:
    """Slot values of the item in each group: how many, how many filled in several ways, how many in one other way."""
    return (
        found.where(F.size("slots") == F.size("item_slots"))
        .select(*by, F.explode(F.arrays_zip("item_slots", "slots")).alias("s"))
        .groupBy(*by, F.col("s.item_slots").alias("of"))
        .agg(F.min("s.slots").alias("least"), F.max("s.slots").alias("most"))
        .groupBy(*by).agg(
            F.count("*").alias("n_slots"), F.count_if(F.col("least") != F.col("most")).alias("mixed"),
            F.count_if((F.col("least") == F.col("most")) & (F.col("least") != F.col("of"))).alias("n_reparameterised"),
        )
    )


def leaks(docs: DataFrame, benchmark: DataFrame, key="doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", least_share: float = LEAST_SHARE) -> DataFrame:
    """A row for each document row and benchmark item that it leaks: key, item, and figures.

    ``n_windows`` are the item's windows, ``n_matched`` those found in the document, ``coverage``
    their share (``least_share`` at least), ``n_reparameterised`` the slot values of the item
    filled in another way. A pair is left out if too many slot values are filled in several ways,
    unless its windows as written are enough alone, or those of one occurrence (at one distance
    from the item's places) are enough and filled consistently.
    Items and documents with fewer words than a window are one window; without words they match
    nothing, as do missing texts. Repeated rows, of either table, each give their rows; empty
    tables give an empty result; other columns are ignored.
    """
    keys = F.col(key) if isinstance(key, str) else key
    index = cut(item_windows(benchmark, item, item_text))
    rows = docs.select(keys.alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    hits = _windows_of(rows, Filter(index, "hash", index.count()), f"key {kind}, row long")
    found = cut(hits.join(small(index, 100_000), "hash"))
    found = found.withColumn("shift", F.col("place") - F.col("at"))
    share = lambda n: F.col(n) / F.col("n_windows") >= least_share
    matched = (
        found.groupBy("row", "item").agg(
            F.first("key").alias("key"), F.first("item_windows").alias("n_windows"), F.countDistinct("at").alias("n_matched"),
            F.countDistinct(F.when(F.col("literal"), F.col("at"))).alias("n_literal"))
        .withColumn("coverage", F.col("n_matched") / F.col("n_windows")).where(share("n_matched"))
    )
    within = found.groupBy("row", "item", "shift").agg(F.countDistinct("at").alias("n_here"), F.first("item_windows").alias("n_windows")).where(share("n_here"))
    consistent = F.coalesce(F.col("mixed") <= MOST_MIXED * F.col("n_slots"), F.lit(True))
    changed = F.coalesce("n_reparameterised", F.lit(0))
    # The occurrence with the most windows, and of these the one with the fewest changes.
    best = (
        within.join(_fillings(found, ["row", "item", "shift"]), ["row", "item", "shift"], "left").where(consistent)
        .groupBy("row", "item").agg((-F.max(F.struct("n_here", (-changed).alias("less")))["less"]).alias("n_best"))
    )
    pairs = matched.join(best, ["row", "item"], "left").join(_fillings(found.where("is_first"), ["row", "item"]), ["row", "item"], "left")
    pairs = pairs.where(share("n_literal") | F.col("n_best").isNotNull() | consistent)
    changed = F.coalesce("n_best", F.when(share("n_literal"), F.lit(0)), changed)
    name = key if isinstance(key, str) else "key"
    return pairs.select(
        F.col("key").alias(name), F.col("item").alias(item), "n_windows", "n_matched", F.round("coverage", 6).alias("coverage"),
        changed.cast("long").alias("n_reparameterised"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item. Leaks depend on the text alone, so rows go by a digest of it; missing texts stay."""
    digest = F.sha2(F.col(text), 256)
    found = leaks(docs, benchmark, digest, text).select(F.col("key").alias("_digest")).distinct()
    rows = docs.withColumn("_own", digest)
    return rows.join(found, F.col("_own") == F.col("_digest"), "left_anti").select(*docs.columns)


def op10_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
