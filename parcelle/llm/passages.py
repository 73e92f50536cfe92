"""Passages that occur again, by de Bruijn compaction.

Runs of k words are the edges of a de Bruijn graph, a text is a walk along them. Each walk is cut
where the least short run (the mark) inside its edges changes, so that equal edges lie in pieces
with equal marks, and only pieces whose mark occurs again leave a task. Pieces that occur again
as a whole are compacted: a piece that always follows another one, which it always follows, is
joined to it, and the joined pieces of one source become a path. The paths occur wherever their
first piece does. Edges of pieces that occur once, but share their mark, are counted one by one.
A second reading of the texts compares the words at all places of a path or edge; only what
equals the words of another place counts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelle.llm.common import BLANKS, cut, documents, mixed, raw_texts
from parcelle.llm.grams import Filter, Runs, Splitter, slices

#: Words of an edge.
WIDTH = 35
#: Words of a mark. Each edge holds WIDTH - MARK + 1 of them, so a piece has so many edges at most.
MARK = 8
_LOW = np.uint64(0xFFFFFFFF)
_SEPARATORS = BLANKS.encode()


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` consecutive ones."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


class _Cutter:
    """The pieces of texts of a slice, as columns."""

    def __init__(self, width: int, mark: int):
        self.splitter, self.width, self.mark = Splitter(_SEPARATORS, lower=False), width, mark

    def __call__(self, texts: list[bytes]) -> dict[str, np.ndarray] | None:
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        starts, _, hashes = self.splitter.words(data)
        n = len(hashes) - self.width + 1
        if n <= 0:
            return None
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        text = np.searchsorted(begins, starts, "right") - 1
        edges = np.flatnonzero(text[:n] == text[self.width - 1:])
        if not len(edges):
            return None
        runs = Runs(hashes)
        marks = runs.all(self.mark)
        # High bits of the number, then the place, so that the first of equal ones is the least.
        order = (marks & ~_LOW) | np.arange(len(marks), dtype=np.uint64)
        at = (_least(order, self.width - self.mark + 1) & _LOW).astype(np.int64)[edges]
        follows = (np.diff(edges) == 1) & (text[edges[1:]] == text[edges[:-1]])
        first = np.concatenate([[0], np.flatnonzero(~follows | (np.diff(at) != 0)) + 1])
        count = np.diff(np.append(first, len(edges)))
        begin, shift = edges[first], at[first] - edges[first]
        piece = mixed(runs.of(begin, begin + count + self.width - 1) + (shift + 64 * count).astype(np.uint64))
        linked = follows[first[1:] - 1]  # whether a piece follows the one before it
        zero = np.zeros(1, np.uint64)  # the end of a text
        word = np.searchsorted(text, text[begin])  # first word of the text
        return {
            "text": text[begin], "start": begin - word, "count": count, "shift": shift, "mark": marks[at[first]], "piece": piece,
            "next": np.concatenate([np.where(linked, piece[1:], 0), zero]), "last": np.concatenate([zero, np.where(linked, piece[:-1], 0)]),
            "first": first, "edges": (runs.all(self.width)[edges] >> np.uint64(32)).astype(np.uint32),
        }


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A text goes by its key and its number; only equal rows share both."""
    return docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("print"), F.col(text).alias("text"))


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def marks(docs: DataFrame, text: str = "text", width: int = WIDTH, mark: int = MARK) -> DataFrame:
    """``mark`` of each piece."""
    def run(batches):
        cutter = _Cutter(width, mark)
        for batch in batches:
            texts = raw_texts(batch.column(0))
            for a, b in slices(texts):
                if (found := cutter(texts[a:b])) is not None:
                    yield pa.RecordBatch.from_arrays([_longs(found["mark"])], ["mark"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "mark long")


_KINDS = {"start": "int", "count": "int", "shift": "int", "mark": "long", "piece": "long", "next": "long", "last": "long", "edges": "binary"}


def pieces(docs: DataFrame, column: str, passes: Filter, wanted: list[str], key: str, text: str, width: int, mark: int) -> DataFrame:
    """Pieces of which a column, ``mark`` or ``piece``, passes a filter; of them the wanted columns.

    ``key``, ``print``, ``start`` (in words), ``count`` (edges), ``mark``, ``shift`` (place of the
    mark in the first edge), ``piece`` (a number for its words), ``next`` and ``last`` (the pieces
    after and before it, 0 at the end of the text) and ``edges`` (32 bits for each).
    """
    rows = _rows(docs, key, text)
    kinds = {"key": rows.schema["key"].dataType.simpleString(), "print": "long", **_KINDS}
    shared = docs.sparkSession.sparkContext.broadcast(passes)

    def run(batches):
        cutter, passes = _Cutter(width, mark), shared.value
        for batch in batches:
            texts = raw_texts(batch.column(2))
            for a, b in slices(texts):
                found = cutter(texts[a:b])
                if found is None:
                    continue
                kept = np.flatnonzero(passes(found[column]))
                at = pa.array(found["text"][kept] + a)

                def made(name: str) -> pa.Array:
                    if name in ("key", "print"):
                        return batch.column(name).take(at)
                    if name == "edges":
                        ends = np.append(found["first"], len(found["edges"])).astype(np.int32) * 4
                        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(found["edges"])]).take(pa.array(kept))
                    return pa.array(found[name][kept].astype(np.int32)) if kinds[name] == "int" else _longs(found[name][kept])

                yield pa.RecordBatch.from_arrays([made(name) for name in wanted], wanted)

    return rows.mapInArrow(run, ", ".join(f"{name} {kinds[name]}" for name in wanted))


def paths(contents: DataFrame) -> DataFrame:
    """Nonbranching paths of pieces that occur again: ``mark`` and ``piece`` of the first one, ``count`` edges.

    If a piece is always followed by one that it always precedes, both occur equally often and
    their first places are in one text, so a path lies in the text of its source.
    """
    again = contents.where("n > 1")
    out = again.where("next IS NOT NULL").select(F.col("piece").alias("_piece"), F.col("next").alias("_next"))
    into = again.where("last IS NOT NULL").select("piece", "last")
    joined = into.join(out, (F.col("last") == F.col("_piece")) & (F.col("piece") == F.col("_next"))).select("piece", F.lit(1).alias("joined")).distinct()
    along = Window.partitionBy("place.key", "place.print").orderBy("place.start")
    numbered = again.join(joined, "piece", "left").withColumn("path", F.sum(1 - F.coalesce("joined", F.lit(0))).over(along))
    return (
        numbered.groupBy("place.key", "place.print", "path")
        .agg(F.min(F.struct("place.start", "mark", "piece")).alias("head"), F.sum("count").cast("int").alias("count"))
        .select("head.mark", "head.piece", "count")
    )


def _edges(shapes: DataFrame) -> DataFrame:
    """A number for each edge of the pieces (``edge``), with the piece's ``n`` and ``piece``, and its ``bit`` there."""
    def run(batches):
        for batch in batches:
            mark, piece, n, shift = (batch.column(k).to_numpy().astype(np.int64) for k in range(4))
            raw = batch.column(4).to_pylist()
            sizes = np.array([len(x) // 4 for x in raw], np.int64)
            at = np.repeat(np.arange(len(sizes)), sizes)
            number = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            edges = np.frombuffer(b"".join(raw), np.uint32).astype(np.uint64)
            place = (shift[at] - number).astype(np.uint64) << np.uint64(32)  # of the mark in the edge
            yield pa.RecordBatch.from_arrays(
                [_longs(mixed(mixed(place | edges) + mark[at].view(np.uint64))), pa.array(n[at]), pa.array(piece[at]), pa.array(np.int64(1) << number)],
                ["edge", "n", "piece", "bit"])

    return shapes.select("mark", "piece", "n", "shift", "edges").mapInArrow(run, "edge long, n long, piece long, bit long")


def _stretches(masked: DataFrame) -> DataFrame:
    """The consecutive edges of a mask as spans."""
    kind = masked.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            at, start, count = [], [], []
            for row, (first, mask) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                while mask:
                    skipped = (mask & -mask).bit_length() - 1
                    mask >>= skipped
                    first += skipped
                    size = (~mask & mask + 1).bit_length() - 1
                    at.append(row)
                    start.append(first)
                    count.append(size)
                    mask >>= size
                    first += size
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(start, pa.int32()), pa.array(count, pa.int32()), pa.array([True] * len(at))],
                ["key", "print", "start", "count", "each"])

    return masked.select("key", "print", "start", "mask").mapInArrow(run, f"key {kind}, print long, start int, count int, each boolean")


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, mark: int = MARK) -> DataFrame:
    """Places of edges that occur again, if equal numbers are equal words: ``key``, ``print``, ``start`` and ``count``.

    Either the edges from there on occur again as a whole, or ``each`` of them for itself.
    """
    if not 0 <= width - mark < 63:
        raise ValueError("a mark is no longer than an edge and at most 62 words shorter")
    given = (key, text, width, mark)
    counted = marks(docs, text, width, mark).groupBy("mark").count().where("count > 1")
    again = cut(counted.select("mark"))
    found = pieces(docs, "mark", Filter(again, "mark", again.count()), ["key", "print", "start", "count", "mark", "piece", "next", "last"], *given)
    only = {c: F.when((F.min(c) == F.max(c)) & (F.min(c) != 0), F.min(c)).alias(c) for c in ("next", "last")}
    contents = cut(found.groupBy("mark", "piece").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "print", "start")).alias("place"), F.max("count").alias("count"), only["next"], only["last"]))
    path = cut(paths(contents))
    heads = pieces(docs, "piece", Filter(path, "piece", path.count()), ["key", "print", "start", "mark", "piece"], *given)
    whole = heads.join(path, ["mark", "piece"]).select("key", "print", "start", "count", F.lit(False).alias("each"))

    # Marks with several pieces, of which one occurs once: its edges may be in another one.
    common = cut(contents.groupBy("mark").agg(F.count("*").alias("pieces"), F.min("n").alias("least")).where("pieces > 1 AND least = 1").select("mark"))
    shared = pieces(docs, "mark", Filter(common, "mark", common.count()), ["mark", "piece", "shift", "edges"], *given)
    # One row for each piece, with the edges of any of its places.
    shapes = cut(shared.groupBy("mark", "piece").agg(F.count("*").alias("n"), F.first("shift").alias("shift"), F.first("edges").alias("edges")))
    edges = _edges(shapes)
    repeated = edges.groupBy("edge").agg(F.sum("n").alias("total"), F.min("n").alias("least")).where("total > 1 AND least = 1").select("edge")
    # Also of pieces that occur again, at their first place, for the words to be compared with.
    masks = edges.select("edge", "piece", "bit").join(repeated, "edge").groupBy("piece").agg(F.bit_or("bit").alias("mask"))
    masked = contents.select("piece", "place").join(masks, "piece").select("place.*", "mask")
    return whole.unionByName(_stretches(masked))


def _applied(docs: DataFrame, spans: DataFrame, key: str, text: str, width: int, texts: bool) -> DataFrame:
    """Each row's words without those of its spans, and a number for the words of each span."""
    per_text = cut(spans.groupBy("key", "print").agg(F.collect_set(F.struct("start", "count", "each")).alias("spans")).select(
        F.col("key").alias("_key"), F.col("print").alias("_print"), "spans"))
    affected = Filter(per_text.select(F.xxhash64("_key", "_print").alias("hash")), "hash", per_text.count())
    rows = _rows(docs, key, text).select("key", "print", F.xxhash64("key", "print").alias("hash"), "text")
    kind = rows.schema["key"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(affected)

    def facts(words: list[bytes], n: int) -> tuple:
        kept = b" ".join(words)
        return n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None

    def first(batches):
        passes = shared.value
        for batch in batches:
            wanted = passes(batch.column(2).to_numpy().view(np.uint64))
            out = [(None, None, None, None) if w else facts(words := raw.split(), len(words)) for raw, w in zip(raw_texts(batch.column(3)), wanted)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pc.if_else(pa.array(wanted), batch.column(3), pa.scalar(None, pa.string())), *_columns(out)],
                ["key", "print", "text", *_FACTS])

    # Texts without a span are done; only the others are shuffled as a whole.
    done = rows.mapInArrow(first, f"key {kind}, print long, text string, {_FACT_KINDS}")
    joined = done.join(per_text, F.col("key").eqNullSafe(F.col("_key")) & (F.col("print") == F.col("_print")), "left").select("key", "print", "text", *_FACTS, "spans")
    span = pa.struct([("start", pa.int32()), ("count", pa.int32()), ("each", pa.bool_()), ("words", pa.list_(pa.int64()))])

    def number(words: list[bytes]) -> int:
        return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True)

    def second(batches):
        for batch in batches:
            out, checks = [], []
            for row, (raw, n) in enumerate(zip(raw_texts(batch.column(2)), batch.column(3).to_pylist())):
                found = batch.column(7)[row].as_py() or []
                checks.append(found)
                if n is not None:
                    out.append(tuple(c[row].as_py() for c in batch.columns[3:7]))
                    continue
                words = raw.split()
                depth = np.zeros(len(words) + 1, np.int64)
                for s in found:
                    end = s["start"] + s["count"] + width - 1
                    single = range(s["start"], s["start"] + s["count"]) if s["each"] else ()
                    s["words"] = [number(words[k:k + width]) for k in single] or [number(words[s["start"]:end])]
                    depth[s["start"]] += 1
                    depth[min(end, len(words))] -= 1
                out.append(facts([words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()], len(words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *_columns(out), pa.array(checks, pa.list_(span))], ["key", "print", *_FACTS, "spans"])

    return joined.mapInArrow(second, f"key {kind}, print long, {_FACT_KINDS}, spans array<struct<start: int, count: int, each: boolean, words: array<bigint>>>")


_FACTS = ["n_words", "n_removed", "kept_sha256", "kept_text"]
_FACT_KINDS = "n_words long, n_removed long, kept_sha256 string, kept_text string"


def _columns(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))]


def repeated_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, mark: int = MARK, texts: bool = False,
) -> DataFrame:
    """One row for each row of ``docs``: key, ``n_words``, ``n_removed``, ``kept_sha256``, ``spans`` and, with ``texts``, ``kept_text``.

    Words are what blanks (space, tab to carriage return) part; a window is ``width`` consecutive
    words of a text. All words of a window that starts anywhere else, too, are removed, whether
    in another text, in the same one or in a repeated row. ``kept_text`` is the words left,
    joined by spaces, and ``kept_sha256`` its SHA-256. ``spans`` are the verified places:
    ``start`` in words and ``count`` windows from there on, which occur again as a whole or,
    with ``each``, one by one; ``words`` numbers their words, the same for the same words. A
    missing, empty or shorter text than a window loses nothing. A missing key is a key like any
    other. An empty table gives an empty result; other columns are ignored.
    """
    spans = candidates(docs, key, text, width, mark)
    while True:
        found = cut(_applied(docs, spans, key, text, width, texts))
        seen = found.select("key", "print", F.explode("spans").alias("s")).select("key", "print", "s.*")
        seen = seen.select("key", "print", "start", "count", "each", F.posexplode("words").alias("at", "word"))
        alone = cut(seen.groupBy("word").agg(F.count("*").alias("places")).where("places = 1").select("word"))
        if alone.isEmpty():
            break
        # Equal numbers of different words: what has no equal goes, and the rows are read again.
        spans = seen.join(alone, "word", "left_anti").select(
            "key", "print", F.when(F.col("each"), F.col("start") + F.col("at")).otherwise(F.col("start")).alias("start"),
            F.when(F.col("each"), 1).otherwise(F.col("count")).alias("count"), "each")
    return found.select(F.col("key").alias(key), "n_words", "n_removed", "kept_sha256", "spans", *["kept_text"] * texts)


def op13_repeated_passages(spark, sf_dir: str) -> DataFrame:
    found = repeated_passages(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP13_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT r, s, md5(array_to_string(words[s:s + 34], ' ')) AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS s FROM texts WHERE len(words) >= 35)
), again AS (
  SELECT r, s FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)
), gone AS (
  SELECT DISTINCT r, unnest(range(s, s + 35)) AS place FROM again
), placed AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text FROM placed ANTI JOIN gone USING (r, place) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""
