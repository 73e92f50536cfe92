"""Phrase collocations by Rabin-Karp fingerprints.

Prefix polynomials over the word numbers of a slice of texts give every run of words its
fingerprint. Runs are counted by fingerprint, from single words to long ones: a run is counted
only if both runs that are one word shorter may be frequent. The texts are then read once more,
and only runs with a frequent fingerprint become text. There they are told apart by their words,
byte by byte, so that different runs with one fingerprint are counted apart; each has a pointer to
a document that holds it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelle.llm.common import cut, documents, hash64, mixed, raw_texts
from parcelle.llm.grams import Filter, Runs, Splitter, slices

LONGEST = 3
LEAST = 10
TOP = 2000
#: A candidate goes if a longer one that holds it has so many hundredths of its occurrences.
INSIDE = 50
NO_LANG = "und"
SCALE = 1_000_000
#: Different runs that a task keeps at hand; then they leave it, to be summed up after the shuffle.
MOST_KEPT = 300_000
_ENDS = np.zeros(256, bool)
_ENDS[np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)] = True
_SEPARATORS = b" \t.,;:!?\n\x0b\x0c\r"
_LAST = (1 << 63) - 1


class _Slice:
    """Words of some texts: place, number, piece and language of each."""

    def __init__(self, splitter: Splitter, texts: list[bytes], langs: np.ndarray):
        self.data = np.frombuffer(b"\n".join(texts), np.uint8)
        self.starts, self.ends, self.hashes = splitter.words(self.data)
        self.piece = np.searchsorted(np.flatnonzero(_ENDS[self.data]), self.starts)
        self.text = np.searchsorted(np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]), self.starts, "right") - 1
        self.lang = langs[self.text]

    def fingerprints(self, runs: Runs, size: int) -> np.ndarray:
        n = max(0, len(self.starts) - size + 1)
        return mixed(runs.all(size) ^ self.lang[:n]) if n else np.zeros(0, np.uint64)

    def within(self, size: int) -> np.ndarray:
        """Whether the run of ``size`` words from each word on is in one piece."""
        n = max(0, len(self.starts) - size + 1)
        return self.piece[:n] == self.piece[size - 1:size - 1 + n]

    def joined(self) -> None:
        """Lays the words one after the other, A-Z as a-z and one space after each, so that a run is one stretch of bytes."""
        sizes = self.ends - self.starts
        at = _stretches(self.starts, sizes)
        self.starts = np.cumsum(sizes + 1) - (sizes + 1)
        self.ends = self.starts + sizes
        data = np.full(int(sizes.sum()) + len(sizes), 32, np.uint8)
        data[_stretches(self.starts, sizes)] = _LOWER[self.data[at]]
        self.data = data

    def words(self) -> np.ndarray:
        """A number for each of the joined words, the same for the same bytes."""
        _, first, of = np.unique(self.hashes, return_index=True, return_inverse=True)
        sizes, same = self.ends - self.starts, first[of]
        if (sizes == sizes[same]).all() and (self.data[_stretches(self.starts, sizes)] == self.data[_stretches(self.starts[same], sizes)]).all():
            return of
        seen: dict[bytes, int] = {}  # two words have one number
        raw = self.data.tobytes()
        return np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(self.starts, self.ends)], np.int64)

    def phrases(self, places: np.ndarray, size: int) -> pa.Array:
        """The texts of the runs of ``size`` joined words at some places."""
        sizes = self.ends[places + size - 1] - self.starts[places]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.Array.from_buffers(pa.string(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[_stretches(self.starts[places], sizes)])])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of stretches of bytes, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _rows(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    return docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(key).cast("long").alias("key"))


def _sliced(batch: pa.RecordBatch, splitter: Splitter):
    """The slices of a batch, with the first of their rows."""
    texts, langs = raw_texts(batch.column(0)), batch.column(1).to_pylist()
    numbers = {name: hash64(name.encode()) for name in set(langs)}
    hashes = np.array([numbers[name] for name in langs], np.uint64)
    for a, b in slices(texts):
        yield a, _Slice(splitter, texts[a:b], hashes[a:b])


def counted(docs: DataFrame, size: int, shorter: Filter | None, key: str, text: str, lang: str) -> DataFrame:
    """``fingerprint`` and ``n`` of the runs of ``size`` words whose runs of one word less pass ``shorter``."""
    shared = docs.sparkSession.sparkContext.broadcast(shorter)

    def run(batches):
        splitter, passes = Splitter(_SEPARATORS, lower=True), shared.value
        kept, counts, size_of = [], [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            found, at = np.unique(np.concatenate(kept), return_inverse=True)
            return found, np.bincount(at, np.concatenate(counts)).astype(np.int64)

        def row(found, n) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["fingerprint", "n"])

        for batch in batches:
            for _, part in _sliced(batch, splitter):
                runs = Runs(part.hashes)
                prints, within = part.fingerprints(runs, size), part.within(size)
                if passes is not None and len(prints):
                    whole = passes(part.fingerprints(runs, size - 1))
                    within &= whole[:-1] & whole[1:]
                found, n = np.unique(prints[within], return_counts=True)
                kept.append(found)
                counts.append(n)
                size_of += len(found)
                if size_of > 2 * MOST_KEPT:
                    found, n = summed()
                    kept, counts, size_of = [found], [n], len(found)
                    if size_of > MOST_KEPT:
                        yield row(found, n)
                        kept, counts, size_of = [], [], 0
        if size_of:
            yield row(*summed())

    rows = _rows(docs, key, text, lang).mapInArrow(run, "fingerprint long, n long")
    return rows.groupBy("fingerprint").agg(F.sum("n").alias("n"))


def materialised(docs: DataFrame, frequent: list[Filter], key: str, text: str, lang: str) -> DataFrame:
    """``lang``, ``phrase``, ``size``, ``n`` and ``seen_in`` of the runs of each size that pass its filter; words alone (size 0) only as their number."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        splitter, passes = Splitter(_SEPARATORS, lower=True), shared.value

        def rows(langs: pa.Array, phrases_: pa.Array, size: int, counts: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                langs, phrases_, pa.array(np.full(len(counts), size, np.int32)), pa.array(counts.astype(np.int64)), pa.array(seen, mask=seen == _LAST),
            ], ["lang", "phrase", "size", "n", "seen_in"])

        for batch in batches:
            keys = batch.column(2).fill_null(_LAST).to_numpy(zero_copy_only=False)
            for a, part in _sliced(batch, splitter):
                if not len(part.starts):
                    continue
                part.joined()
                runs, of = Runs(part.hashes), part.words()
                kinds = int(of.max()) + 1
                _, first, in_lang, counts = np.unique(part.lang, return_index=True, return_inverse=True, return_counts=True)
                lang_of = batch.column(1).take(pa.array(part.text[first] + a))
                doc = keys[part.text + a]
                yield rows(lang_of, pa.array([""] * len(first)), 0, counts, np.full(len(first), _LAST))
                same = in_lang.astype(np.int64)  # a number for each run, the same for the same words
                for size, passes_size in enumerate(passes, 1):
                    n = len(of) - size + 1
                    if n <= 0:
                        break
                    at = np.flatnonzero(part.within(size) & passes_size(part.fingerprints(runs, size)))
                    # Of all runs, as longer ones build on them.
                    _, same = np.unique(same[:n] * kinds + of[size - 1:], return_inverse=True)
                    _, place, group, counts = np.unique(same[at], return_index=True, return_inverse=True, return_counts=True)
                    seen = np.full(len(place), _LAST)
                    np.minimum.at(seen, group, doc[at])
                    there = at[place]
                    yield rows(lang_of.take(pa.array(in_lang[there])), part.phrases(there, size), size, counts, seen)

    found = _rows(docs, key, text, lang).mapInArrow(run, "lang string, phrase string, size int, n long, seen_in long")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"), F.min("seen_in").alias("seen_in"))


def phrases(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``lang``, ``phrase``, ``size``, ``n`` and ``seen_in`` of all runs of at most ``longest`` words that occur ``least`` times; size 0 counts all words."""
    filters: list[Filter] = []
    for size in range(1, longest + 1):
        frequent = cut(counted(docs, size, filters[-1] if filters else None, key, text, lang).where(F.col("n") >= least).select("fingerprint"))
        filters.append(Filter(frequent, "fingerprint", frequent.count()))
    return cut(materialised(docs, filters, key, text, lang).where((F.col("n") >= least) | (F.col("size") == 0)))


def _part(first, count):
    """Some words of ``phrase``."""
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def collocations(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    longest: int = LONGEST, least: int = LEAST, top: int = TOP, inside: int = INSIDE,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` and ``seen_in``.

    Texts are split at ``. , ; : ! ?`` and line ends (line feed to carriage return) into pieces
    and these at spaces and tabs into words, A-Z as a-z. ``n`` is the words of the language, ``a``
    the occurrences of the phrase, ``l`` and ``r`` those of its parts at the cut with the least
    score (of equal ones the first), the score the whole part of 1,000,000 a a / (l r) in exact
    decimals. Phrases have 2 to ``longest`` words and ``least`` occurrences; one that lies in a
    longer phrase with ``inside`` hundredths of its occurrences is left out. Ranks go by score
    and occurrences, both falling, then by bytes. ``seen_in`` is the least key of a text with it.

    A missing language is ``und``, missing and empty texts have no words, repeated rows count
    each, and a language without such a phrase has no row. An empty table gives an empty result;
    other columns are ignored. Counts below 10**13 are exact.
    """
    found = phrases(docs, key, text, lang, longest, least)
    counts = found.where("size > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("of_part"))
    candidates = found.where("size > 1")
    cuts = candidates.select("lang", "phrase", F.col("n").alias("a"), "size", "seen_in", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("size")).alias("right"))
    parts = cuts.join(counts.select("lang", F.col("part").alias("left"), F.col("of_part").alias("l")), ["lang", "left"])
    parts = parts.join(counts.select("lang", F.col("part").alias("right"), F.col("of_part").alias("r")), ["lang", "right"])
    scored = parts.withColumn("score", F.expr(
        f"(cast({SCALE} as decimal(7,0)) * cast(a as decimal(13,0)) * cast(a as decimal(13,0))) div (cast(l as decimal(13,0)) * cast(r as decimal(13,0)))"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "seen_in")).alias("s")).select("lang", "phrase", "s.*")

    longer = candidates.where("size > 2").select("lang", "phrase", F.col("n").alias("of_longer"), "size")
    longer = longer.select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("words"))
    longer = longer.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("words") + 1)).alias("first"))
    holders = longer.select("lang", _part(F.col("first"), F.col("words")).alias("phrase"), "of_longer").groupBy("lang", "phrase").agg(F.max("of_longer").alias("of_longer"))
    held = (F.col("of_longer").isNotNull()) & (100 * F.col("of_longer") >= inside * F.col("a"))
    left = lowest.join(holders, ["lang", "phrase"], "left").where(~held)

    # First among parts of a language, so that a large one is not ranked in one task.
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    some = left.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    words = found.where("size = 0").select("lang", F.col("n"))
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "seen_in")


def op12_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir)).drop("seen_in")


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^ \x09]+') AS words FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM split GROUP BY lang
), runs AS (
  SELECT lang, size, array_to_string(words[s:s + size - 1], ' ') AS phrase
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS s
        FROM split, (SELECT unnest([1, 2, 3]) AS size) WHERE len(words) >= size)
), counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
  SELECT lang, size, phrase, f AS a, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS w FROM counts WHERE size > 1
), scored AS (
  SELECT c.lang, c.phrase, c.size, a, k, x.f AS l, y.f AS r,
         CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held AS (
  SELECT lang, pair AS phrase, max(f) AS f
  FROM (SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS pair
        FROM counts WHERE size = 3)
  GROUP BY ALL
), ranked AS (
  SELECT o.*, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, encode(o.phrase)) AS rank
  FROM lowest o LEFT JOIN held h ON h.lang = o.lang AND h.phrase = o.phrase AND o.size = 2
  WHERE h.f IS NULL OR 100 * h.f < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
