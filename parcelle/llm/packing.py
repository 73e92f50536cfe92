"""Packing documents into token sequences by best fit, long pieces first.

Pieces go by size from long to short, each into the smallest gap that still holds it; a gap
takes pieces of a size until it holds no more, and only what no gap holds opens new sequences.
Which piece of a size goes where does not matter, so the rule is worked out on counts: how many
pieces have each size, and runs of sequences with one history and so with one gap. Neither is
larger than the capacity allows, whatever the table. Each piece then finds its place by its
number among those of its size; these numbers follow from a range-sort and sums over its tasks,
so that one frequent size is spread over tasks.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelle.llm.common import cut, documents, raw_texts

CAPACITY = 4096
END = 1
TOKENIZER = "word_bpe_49k.json"
#: Rows (two numbers each) that a task of the sort takes; it has as many tasks as the pieces need.
ROWS_OF_A_TASK = 50_000
_MOST_WORDS = 1_200_000


class Ids(dict):
    """Token ids of a word between blanks, as little-endian unsigned 32-bit numbers.

    The tokenizer drops blanks and joins nothing across them, so words can be looked up one by
    one. A full stop or comma after a letter or digit is a token of its own and looked up apart.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        low = word.lower()
        head = low.rstrip(b".,")
        if low != word:
            ids = self[low]
        elif head != low and head[-1:].isalnum():
            ids = self[head] + self[low[len(head):]]
        else:
            ids = self.direct(word.decode())
        self[word] = ids
        return ids

    def of(self, text: bytes) -> bytes:
        if b"<|" in text:  # may hold a special token, which the tokenizer finds before anything else
            return self.direct(text.decode())
        if len(self) > _MOST_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, text.split()))


_LOADED: dict[str, Ids] = {}


def ids_of(tokenizer: str) -> Ids:
    """The tokenizer's ids, kept by the worker; ``tokenizer`` is a file or the name of a public one."""
    if tokenizer not in _LOADED:
        from tokenizers import Tokenizer

        path = tokenizer
        if not os.path.isabs(tokenizer):
            import public_tokenizers

            path = public_tokenizers.path(tokenizer)
        _LOADED[tokenizer] = Ids(Tokenizer.from_file(path))
    return _LOADED[tokenizer]


def token_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` ids: key, ``piece``, ``start``, ``length``, ``ids_crc32``. A missing text is empty."""
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("text"))
    last = np.array([end], "<u4").tobytes()

    def run(batches):
        ids = ids_of(tokenizer)
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for row, raw in enumerate(raw_texts(batch.column(1))):
                data = ids.of(raw) + last
                for number, first in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[first:first + 4 * capacity]
                    at.append(row)
                    piece.append(number)
                    start.append(first // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))],
                [key, "piece", "start", "length", "ids_crc32"],
            )

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long")


def _summed(batches):
    """Events in order, with the sum of gaps (1) and items (-1) so far in this task and the task's place in the order."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        if batch.num_rows:
            inside = before + np.cumsum(1 - 2 * batch.column(2).to_numpy().astype(np.int64))
            before = int(inside[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(inside), pa.array(np.full(batch.num_rows, part), pa.int64())], ["id", "size", "kind", "inside", "part"])


def sweep(items: DataFrame, gaps: DataFrame, tasks: int = 1) -> DataFrame:
    """Items (id, size) matched with gaps (id, size), each with one at most: the smallest that holds it, large items first.

    One step of the rule on rows, where :func:`plan` works on counts; the packing needs it no more.
    All rows with ``kind`` (0 a gap, 1 an item), ``level`` and, where matched, ``other`` and
    ``other_size``. The items that no gap holds are on the levels 0, -1, -2, ... in order of size.
    """
    order = [F.desc("size"), F.col("kind"), F.col("id")]
    events = gaps.select("id", "size", F.lit(0).alias("kind")).unionByName(items.select("id", "size", F.lit(1).alias("kind")))
    ordered = events.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    summed = cut(ordered.mapInArrow(_summed, "id long, size long, kind int, inside long, part long"))
    # A row for each task of the sort; what is before a task is the sum of those before it.
    tasks = summed.groupBy("part").agg(F.sum(1 - 2 * F.col("kind")).alias("own"))
    before = tasks.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("before"))
    placed = summed.join(F.broadcast(before), "part").withColumn("level", F.col("before") + F.col("inside") + F.col("kind"))
    # From one size and kind a level has one row at most, so it has two for each size.
    there = Window.partitionBy("level").orderBy(F.desc("size"), "kind")
    seen = placed.select(
        "id", "size", "kind", "level", *(F.lag(c).over(there).alias(f"last_{c}") for c in ("id", "size", "kind")),
        *(F.lead(c).over(there).alias(f"next_{c}") for c in ("id", "size", "kind")),
    )
    taken = (F.col("kind") == 1) & (F.col("last_kind") == 0)
    given = (F.col("kind") == 0) & (F.col("next_kind") == 1)
    other = [F.when(taken, F.col(f"last_{c}")).when(given, F.col(f"next_{c}")).alias(name) for c, name in (("id", "other"), ("size", "other_size"))]
    return seen.select("id", "size", "kind", "level", *other)


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Places for ``counts`` pieces of each size: rows (size, first, first sequence, pieces in each, offset), sorted.

    A row puts the pieces of a size from number ``first`` on into sequences from the given one on,
    so many into each, up to the first piece of the next row. Sequences are numbered from 0.
    """
    runs = defaultdict(list)  # gap: runs (first sequence, sequences)
    gaps: list[int] = []  # those with runs, sorted
    rows, sequences = [], 0

    def keep(gap: int, first: int, n: int) -> None:
        if gap and n:
            if not runs[gap]:
                insort(gaps, gap)
            runs[gap].append((first, n))

    for size in sorted((s for s in counts if counts[s]), reverse=True):
        left, done = counts[size], 0

        def fill(gap: int, first: int, n: int) -> None:
            """Of n sequences with a gap as many as the pieces left need take what they hold; the others stay."""
            nonlocal left, done
            each = gap // size
            full = min(n, left // each)
            if full:
                rows.append((size, done, first, each, capacity - gap))
                keep(gap - each * size, first, full)
                left, done = left - full * each, done + full * each
            if full < n and left:  # fewer than one sequence takes
                rows.append((size, done, first + full, left, capacity - gap))
                keep(gap - left * size, first + full, 1)
                done, left, full = done + left, 0, full + 1
            keep(gap, first + full, n - full)

        while left and (at := bisect_left(gaps, size)) < len(gaps):
            gap = gaps.pop(at)
            for first, n in runs.pop(gap):
                if left:
                    fill(gap, first, n)
                else:
                    keep(gap, first, n)
        if left:
            n = -(-left // (capacity // size))
            first, sequences = sequences, sequences + n
            fill(capacity, first, n)
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def best_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``id``, ``sequence_id`` (from 0 on) and ``offset`` of pieces (id, size), sizes from 1 to ``capacity``; ids must differ."""
    pieces = pieces.select(F.col("id").cast("long").alias("id"), F.col("size").cast("long").alias("size"))
    spark = pieces.sparkSession
    tasks = max(1, -(-pieces.count() // ROWS_OF_A_TASK))
    order = [F.desc("size"), F.col("id")]

    def placed(batches):
        part = TaskContext.get().partitionId()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part), pa.int64())], ["id", "size", "part"])

    # As files, so that tasks find the same rows in the same parts again.
    ordered = cut(pieces.repartitionByRange(tasks, *order).mapInArrow(placed, "id long, size long, part long"))
    # Parts follow each other in order of size: a row for each part and one more for each size at most.
    sums, totals = {}, defaultdict(int)
    for part, size, n in sorted(ordered.groupBy("part", "size").count().collect()):
        sums[part, size] = totals[size]
        totals[size] += n
    rows = plan(totals, capacity)
    shared = spark.sparkContext.broadcast((sums, rows))

    def run(batches):
        before, rows = shared.value
        seen: dict[tuple[int, int], int] = {}
        firsts = rows[:, 1]
        starts, ends = (np.searchsorted(rows[:, 0], np.arange(capacity + 2), side) for side in ("left", "right"))
        for batch in batches:
            ids, sizes, parts = (batch.column(k).to_numpy() for k in range(3))
            sequence, offset = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
            by_size = np.lexsort((sizes, parts))
            cuts = np.flatnonzero((np.diff(sizes[by_size]) != 0) | (np.diff(parts[by_size]) != 0)) + 1
            for at in np.split(by_size, cuts):
                if not len(at):
                    continue
                group = (int(parts[at[0]]), int(sizes[at[0]]))
                first = seen.get(group, before[group])
                seen[group] = first + len(at)
                number = np.arange(first, first + len(at))
                low, high = starts[group[1]], ends[group[1]]
                row = low + np.searchsorted(firsts[low:high], number, "right") - 1
                _, start, run_first, each, begin = rows[row].T
                sequence[at] = run_first + (number - start) // each
                offset[at] = begin + (number - start) % each * group[1]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sequence), pa.array(offset)], ["id", "sequence_id", "offset"])

    return ordered.mapInArrow(run, "id long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: key, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A document's ids end with ``end``; only longer ones than ``capacity`` are cut. A missing or
    empty text is the end alone. Repeated rows are packed each, ties of size by a row number,
    an empty table gives an empty result, and other columns are ignored.
    """
    pieces = cut(token_pieces(docs, key, text, tokenizer, end, capacity).withColumn("id", F.monotonically_increasing_id()))
    placed = best_fit(pieces.select("id", F.col("length").alias("size")), capacity)
    return pieces.join(placed, "id").select(key, "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset").cast("long").alias("offset"))


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
