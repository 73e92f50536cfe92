"""Ranked search as exact maximum inner product search in sparse ball trees.

A document is a sparse vector: for each term of the queries its share of the score. A query is
the set of its terms, so that a score is the sum of a document's values there. Documents are
range-sorted by their strongest terms and cut into trees of bounded size. A node has a centroid
and a radius; by Cauchy and Schwarz no document below it scores more than the centroid plus
the radius times the root of the number of terms that occur there, rounded up. Trees are searched
best-first, subtrees that cannot reach the tenth place are left out, and leaves are scored in
64-bit integers. A first round visits one leaf of each tree, which gives all tasks a common limit
for the second.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelle.llm.common import cut, documents, raw_texts
from parcelle.llm.grams import Splitter, slices

TOP = 10
#: Terms and queries that are searched for at once; more are searched for in further blocks.
BLOCK_TERMS = 1 << 16
BLOCK_ITEMS = 2048
#: Documents and values of a tree at most, and documents of a leaf.
TREE_DOCUMENTS = 4096
TREE_VALUES = 1 << 21
LEAF = 64
_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: What counts as the key of a document without one: last among equals.
_LAST = (1 << 63) - 1
_TREE = "keys binary, starts binary, columns binary, values binary, terms binary, centroids binary, radii binary"


def terms_of(text: str | None) -> list[bytes]:
    return _TERM.findall((text or "").encode().lower())


class Vocabulary:
    """Terms with numbers from 0 on, found by their hash and confirmed by their bytes."""

    def __init__(self, terms: list[bytes]):
        data = b" ".join(terms)
        self.data = np.frombuffer(data, np.uint8)
        starts, ends, hashes = splitter().words(self.data)
        order = np.argsort(hashes)
        self.hashes, self.starts, self.sizes = hashes[order], starts[order], (ends - starts)[order]
        self.number = order

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are terms, and which."""
        row = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        at = np.flatnonzero((self.hashes[row] == hashes) & (self.sizes[row] == ends - starts))
        if not len(at):
            return at, at
        row, sizes = row[at], self.sizes[row[at]]
        begin = np.cumsum(sizes) - sizes
        within = np.arange(sizes.sum()) - np.repeat(begin, sizes)
        same = _LOWER[data[np.repeat(starts[at], sizes) + within]] == self.data[np.repeat(self.starts[row], sizes) + within]
        equal = np.logical_and.reduceat(same, begin)
        return at[equal], self.number[row[equal]]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def splitter() -> Splitter:
    return Splitter(_SEPARATORS, lower=True)


def blocks(items: DataFrame, key: str, text: str, most_terms: int, most_items: int) -> Iterator[tuple[list[tuple], list[bytes], list[list[int]]]]:
    """Queries by blocks: their rows (number, key), the terms of the block and the term numbers of each query."""
    rows, terms, of_items = [], {}, []
    for k, t in items.select(F.col(key), F.col(text)).distinct().toLocalIterator():
        own = sorted(set(terms_of(t)))
        if not own:
            continue
        if rows and (len(rows) >= most_items or len(terms) + len(own) > most_terms):
            yield rows, list(terms), of_items
            rows, terms, of_items = [], {}, []
        rows.append((len(rows), k))
        of_items.append([terms.setdefault(x, len(terms)) for x in own])
    if rows:
        yield rows, list(terms), of_items


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """32-bit numbers as one binary value for each row."""
    offsets = np.concatenate([[0], ends]).astype(np.int32) * 4
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values, np.int32))])


def term_vectors(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str) -> DataFrame:
    """``key``, ``n``, ``terms`` and ``counts`` of documents with a term; and sums of each task.

    Sums have a ``number``: that of a term, for the documents that hold it, -1 for documents with
    any word and -2 for their words.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["key", "n", "terms", "counts", "number", "amount"]

    def run(batches):
        words, known = splitter(), shared.value
        size = len(known.hashes)
        holders, with_words, all_words = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            texts = raw_texts(batch.column(1))
            for a, b in slices(texts):
                data = np.frombuffer(b"\n".join(texts[a:b]), np.uint8)
                starts, ends, hashes = words.words(data)
                text = np.searchsorted(np.cumsum([0] + [len(t) + 1 for t in texts[a:b - 1]]), starts, "right") - 1
                n = np.bincount(text, minlength=b - a)
                with_words, all_words = with_words + int(np.count_nonzero(n)), all_words + len(starts)
                at, term = known.numbers(data, starts, ends, hashes)
                pairs, counts = np.unique(text[at] * size + term, return_counts=True)
                if not len(pairs):
                    continue
                text, term = pairs // size, (pairs % size).astype(np.int32)
                holders += np.bincount(term, minlength=size)
                own, first = np.unique(text, return_index=True)
                cuts = np.append(first[1:], len(pairs))
                none = pa.nulls(len(own), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own + a)), pa.array(n[own]), _packed(term, cuts), _packed(counts, cuts), none, none], names)
        held = np.flatnonzero(holders)
        number, amount = np.concatenate([held, [-1, -2]]), np.concatenate([holders[held], [with_words, all_words]])
        none = pa.nulls(len(number), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.nulls(len(number), pa.binary()), pa.nulls(len(number), pa.binary()), pa.array(number), pa.array(amount)], names)

    return rows.mapInArrow(run, "key long, n long, terms binary, counts binary, number long, amount long")


def weights_of(sums: dict[int, int], size: int) -> np.ndarray:
    n = sums.get(-1, 0)
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * sums.get(k, 0) + 1))) for k in range(size)], np.int64)


def impacts_of(counts: np.ndarray, n: int, sums: dict[int, int]) -> np.ndarray:
    """A term's share of the score before its weight, by its occurrences in a document of n words."""
    m = 10 + 90 * n * sums[-1] // sums[-2]
    counts = counts.astype(np.int64)
    return 1_000_000_000 * counts // (1000 * counts + 8 * m)


def _tree(keys: np.ndarray, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weights: np.ndarray, leaf: int) -> tuple:
    """A balanced tree over the documents (rows of a sparse matrix), in order of its leaves; its node k has the children 2 k + 1 and 2 k + 2."""
    n = len(keys)
    own, columns = np.unique(terms, return_inverse=True)
    values = (weights[terms] * impacts).astype(np.float64)
    row = np.repeat(np.arange(n), np.diff(starts))
    norms = np.add.reduceat(values * values, starts[:-1])
    width, levels = len(own), max(0, math.ceil(math.log2(n / leaf))) if n > leaf else 0
    node = np.zeros(n, np.int64)
    centroids, radii = [], []

    def dot(with_rows: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values * with_rows[node[row], columns], starts[:-1])

    def farthest(distance: np.ndarray, nodes: int) -> np.ndarray:
        order = np.lexsort((distance, node))
        return order[np.searchsorted(node[order], np.arange(nodes), "right") - 1]

    def dense(rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), width))
        for k, r in enumerate(rows):
            out[k, columns[starts[r]:starts[r + 1]]] = values[starts[r]:starts[r + 1]]
        return out

    for level in range(levels + 1):
        nodes = 1 << level
        sums = np.bincount(node[row] * width + columns, values, nodes * width).reshape(nodes, width)
        center = (sums / np.bincount(node, minlength=nodes)[:, None]).astype(np.float32)
        size = (center.astype(np.float64) ** 2).sum(1)
        distance = norms - 2 * dot(center.astype(np.float64)) + size[node]
        # Rounded up by more than the sums can be wrong.
        safe = np.maximum(distance, 0) + 1e-9 * (norms + size[node])
        most = np.zeros(nodes)
        np.maximum.at(most, node, safe)
        centroids.append(center)
        radii.append(np.sqrt(most) * (1 + 1e-9))
        if level < levels:
            one = dense(farthest(distance, nodes))
            other = dense(farthest(norms - 2 * dot(one), nodes))
            order = np.lexsort((dot(one - other), node))
            begin = np.searchsorted(node[order], np.arange(nodes))
            count = np.diff(np.append(begin, n))
            half = np.arange(n) - begin[node[order]] >= (count[node[order]] + 1) // 2
            node[order] = 2 * node[order] + half
    order = np.argsort(node, kind="stable")
    sizes = np.diff(starts)[order]
    new = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(new[-1]) - np.repeat(new[:-1], sizes) + np.repeat(starts[:-1][order], sizes)
    ends = np.searchsorted(node[order], np.arange((1 << levels) + 1))
    # By term, then by node: a query reads its terms' rows.
    return keys[order], new, columns[at], impacts[at], own, np.concatenate(centroids).T, np.concatenate(radii), ends


def trees(vectors: DataFrame, sums: dict[int, int], weights: np.ndarray, most: int = TREE_DOCUMENTS, leaf: int = LEAF) -> DataFrame:
    """A row for each tree. Documents with the same strongest terms are put together."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast((sums, weights))
    strongest = "key long, n long, terms binary, counts binary, first int, second int"

    def ranked(batches):
        sums_, weight = shared.value
        for batch in batches:
            first, second = [], []
            for t, c, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(1).to_pylist()):
                terms = np.frombuffer(t, np.int32)
                z = weight[terms] * impacts_of(np.frombuffer(c, np.int32), n, sums_)
                best = np.argsort(-z, kind="stable")[:2]
                first.append(int(terms[best[0]]))
                second.append(int(terms[best[-1]]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.int32()), pa.array(second, pa.int32())], ["key", "n", "terms", "counts", "first", "second"])

    def build(batches):
        sums_, weight = shared.value
        keys, terms, impacts, size = [], [], [], 0

        def row() -> pa.RecordBatch:
            starts = np.concatenate([[0], np.cumsum([len(t) for t in terms])])
            tree = _tree(np.array(keys, np.int64), starts, np.concatenate(terms), np.concatenate(impacts), weight, leaf)
            kinds = (np.int64, np.int32, np.int32, np.int32, np.int32, np.float32, np.float64, np.int32)
            raw = [np.ascontiguousarray(x, kind).tobytes() for x, kind in zip(tree, kinds)]
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in raw], [*names, "ends"])

        for batch in batches:
            for k, n, t, c in zip(batch.column(0).to_pylist(), *(batch.column(i).to_pylist() for i in (1, 2, 3))):
                keys.append(_LAST if k is None else k)
                terms.append(np.frombuffer(t, np.int32))
                impacts.append(impacts_of(np.frombuffer(c, np.int32), n, sums_))
                size += len(terms[-1])
                if len(keys) >= most or size >= TREE_VALUES:
                    yield row()
                    keys, terms, impacts, size = [], [], [], 0
        if keys:
            yield row()

    names = [c.split()[0] for c in _TREE.split(", ")]
    order = ["first", "second", "key"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = vectors.select("key", "n", "terms", "counts").mapInArrow(ranked, strongest).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return near.select("key", "n", "terms", "counts").mapInArrow(build, _TREE + ", ends binary")


class _Search:
    """The best documents of each query in the trees it is shown, one after the other."""

    def __init__(self, queries: list[np.ndarray], limits: np.ndarray, weights: np.ndarray, top: int):
        self.queries, self.limits, self.weights, self.top = queries, limits, weights, top
        self.best: list[list[tuple[int, int]]] = [[] for _ in queries]  # heaps of (score, -key)
        self.leaves = self.scored = 0

    def limit(self, q: int) -> int:
        """Least score that may still count."""
        best = self.best[q]
        return max(int(self.limits[q]), best[0][0] if len(best) == self.top else 1)

    def tree(self, raw: list[bytes], most_leaves: int | None = None) -> None:
        keys, starts, columns, impacts, terms, centroids, radii, ends = (
            np.frombuffer(x, kind) for x, kind in zip(raw, (np.int64, np.int32, np.int32, np.int32, np.int32, np.float32, np.float64, np.int32)))
        nodes, inner = len(radii), len(radii) // 2
        centroids = centroids.reshape(len(terms), nodes)
        values = self.weights[terms[columns]] * impacts
        local = np.full(len(self.weights), -1)
        local[terms] = np.arange(len(terms))
        chosen = np.zeros(len(terms), np.int64)
        self.leaves += (nodes + 1) // 2 * len(self.queries)
        for q, query in enumerate(self.queries):
            own = local[query]
            own = own[own >= 0]
            if not len(own):
                continue
            there = centroids[own].astype(np.float64)
            bounds = ((there.sum(0) + np.sqrt((there > 0).sum(0)) * radii) * (1 + 1e-9) + 1).tolist()
            chosen[own] = 1
            heap, visited = [(-bounds[0], 0)], 0
            while heap and -heap[0][0] >= self.limit(q) and visited != most_leaves:
                _, node = heapq.heappop(heap)
                if node < inner:
                    for child in (2 * node + 1, 2 * node + 2):
                        if bounds[child] >= self.limit(q):
                            heapq.heappush(heap, (-bounds[child], child))
                    continue
                visited += 1
                self.leaf(q, node - inner, keys, starts, columns, values, ends, chosen)
            chosen[own] = 0

    def leaf(self, q, at, keys, starts, columns, values, ends, chosen) -> None:
        first, last = ends[at], ends[at + 1]
        if first == last:
            return
        self.scored += 1
        begin = starts[first:last]
        a, b = starts[first], starts[last]
        scores = np.add.reduceat(values[a:b] * chosen[columns[a:b]], begin - a)
        best, limit = self.best[q], self.limit(q)
        for d in np.flatnonzero(scores >= limit).tolist():
            found = (int(scores[d]), -int(keys[first + d]))
            if len(best) < self.top:
                heapq.heappush(best, found)
            elif found > best[0]:
                heapq.heapreplace(best, found)


def first_limits(index: DataFrame, queries: list[np.ndarray], weights: np.ndarray, top: int) -> np.ndarray:
    """A score for each query that at least ``top`` documents reach, or 0: what the best leaf of each tree has."""
    shared = index.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches):
        asked, weight = shared.value
        found = _Search(asked, np.zeros(len(asked), np.int64), weight, top)
        for batch in batches:
            for row in range(batch.num_rows):
                found.tree([c[row].as_py() for c in batch.columns], most_leaves=1)
        q, scores = (np.array([x[k] for x in ((q, score) for q, best in enumerate(found.best) for score, _ in best)], np.int64) for k in range(2))
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(scores)], ["query", "reached"])

    order = Window.partitionBy("query").orderBy(F.desc("reached"))
    best = index.mapInArrow(run, "query long, reached long").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    limits = np.zeros(len(queries), np.int64)
    for q, score in best.where(F.col("rank") == top).select("query", "reached").collect():  # a row for each query of the block
        limits[q] = score
    return limits


def search(index: DataFrame, queries: list[np.ndarray], weights: np.ndarray, limits: np.ndarray, top: int) -> DataFrame:
    """``query``, ``key`` and ``score`` of the best documents of each task, without those below a query's limit."""
    shared = index.sparkSession.sparkContext.broadcast((queries, weights, limits))

    def run(batches):
        found = _Search(*(shared.value[k] for k in (0, 2, 1)), top)
        for batch in batches:
            for row in range(batch.num_rows):
                found.tree([c[row].as_py() for c in batch.columns])
        rows = [(q, -key, score) for q, best in enumerate(found.best) for score, key in best]
        q, keys, scores = (np.array([r[k] for r in rows], np.int64) for k in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(keys, mask=keys == _LAST), pa.array(scores)], ["query", "key", "score"])

    return index.mapInArrow(run, "query long, key long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked_documents(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    top: int = TOP, most_terms: int = BLOCK_TERMS, most_items: int = BLOCK_ITEMS, leaf: int = LEAF,
) -> DataFrame:
    """The ``top`` documents of each item: item key, ``rank`` from 1, document key and ``score``.

    Terms are runs of letters and digits of ASCII and of all other characters, A-Z as a-z. An
    item scores a document by its different terms: a term's weight is by how rare it is among
    documents with any term, its share falls with the length of the document. Only scores above 0
    count; of equal ones the smaller key is first, a missing one last. Missing and empty texts have no
    terms: such documents are found and counted nowhere, such items have no rows. Repeated rows
    of documents count each; equal rows of items are one item, and items that share a key are
    ranked each. Empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    kind = items.schema[item_key].dataType.simpleString()
    out = spark.createDataFrame([], f"item {kind}, rank int, key long, score long")
    for rows, terms, of_items in blocks(items, item_key, item_text, most_terms, most_items):
        vectors = cut(term_vectors(docs, Vocabulary(terms), key, text))
        # A number for each term of the block at most.
        sums = {r[0]: r[1] for r in vectors.where("number IS NOT NULL").groupBy("number").agg(F.sum("amount")).collect()}
        if not sums.get(-1):
            break
        weights = weights_of(sums, len(terms))
        index = cut(trees(vectors.where("number IS NULL"), sums, weights, leaf=leaf))
        queries = [np.array(x) for x in of_items]
        limits = first_limits(index, queries, weights, top)
        found = cut(_ranked(search(index, queries, weights, limits, top), top))
        names = spark.createDataFrame(rows, f"query long, item {kind}")
        out = out.unionByName(found.join(F.broadcast(names), "query").select("item", "rank", "key", "score"))
    return out.select(F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score")


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    return ranked_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""
WITH words AS (
  SELECT r, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents WHERE text IS NOT NULL)
), sizes AS (
  SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY r
), totals AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sizes
), counts AS (
  SELECT r, term, count(*) AS tf FROM words GROUP BY r, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM counts, totals GROUP BY term
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (r), totals
  GROUP BY item_id, doc_id, r
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""
