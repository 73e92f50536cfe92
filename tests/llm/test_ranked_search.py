"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from parcelle.llm import ranked_search
from parcelle.llm.ranked_search import _Search, _tree, ranked_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, top=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, words = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = lambda t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
    out = []
    for item, text in set(items):
        found = []
        for i, c in counts:
            m = 10 + 90 * c.total() * n // words
            score = sum(weight(t) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, rank, i, -score) for rank, (score, _, i) in enumerate(found[:top], 1)]
    return sorted(out, key=str)


def made(rng, n, words=400):
    word = lambda: f"W{int(rng.paretovariate(0.7)) % words}{'é' * (rng.random() < 0.1)}"
    return [rng.choice([" ", ", ", "_"]).join(word() for _ in range(rng.randrange(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("given", [{}, {"leaf": 4, "top": 3}, {"most_terms": 30, "leaf": 8}, {"most_items": 3, "top": 500}])
def test_same_rows(spark, given):
    rng = random.Random(7)
    texts = made(rng, 400)
    items = [(k, t) for k, t in enumerate(made(rng, 15) + ["w1", "zzz", "", None, "W1 w1 été", texts[3], texts[8] + " w2"])]
    items += [items[0], (0, "w5 w6"), (None, "w7")]
    docs = texts + texts[:40] + [texts[3]] * 60 + ["", None, "...", "w " * 3000]
    docs = [(k * 3 if k % 50 else None, t) for k, t in enumerate(docs)]
    docs += [docs[5], docs[6]]
    rng.shuffle(docs)
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, key string, score long").repartition(6)
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, query string")
    found = ranked_documents(d, i, **given)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(docs, items, given.get("top", 10))


def test_bounds_hold_and_prune():
    """No document scores above the bound of any node over it, and groups of like documents are left out."""
    rng = np.random.default_rng(3)
    weights = rng.integers(1, 20_000, 300)
    rows = []
    for k in range(1000):
        base = np.random.default_rng(k % 20)
        own = np.unique(base.integers(0, 300, 25))
        own = np.unique(np.append(own, rng.integers(0, 300, 3)))
        rows.append((own.astype(np.int32), rng.integers(1, 900_000, len(own))))
    starts = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])])
    tree = _tree(np.arange(1000), starts, np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), weights, 16)
    keys, starts, columns, impacts, terms_, centroids, radii, ends = tree
    values = weights[terms_[columns]] * impacts
    queries = [rows[k][0] for k in range(0, 1000, 100)]
    leaves = len(ends) - 1
    for query in queries:
        local = np.searchsorted(terms_, query)
        own = centroids[local].astype(float)
        bound = own.sum(0) + np.sqrt((own > 0).sum(0)) * radii
        inside = np.isin(columns, local)
        scores = np.add.reduceat(values * inside, starts[:-1])
        for leaf in range(leaves):
            node = len(radii) // 2 + leaf
            while True:
                assert (scores[ends[leaf]:ends[leaf + 1]] <= bound[node] * (1 + 1e-9) + 1).all()
                if node == 0:
                    break
                node = (node - 1) // 2
    kinds = (np.int64, np.int32, np.int32, np.int32, np.int32, np.float32, np.float64, np.int32)
    search = _Search(queries, np.zeros(len(queries), np.int64), weights, 10)
    search.tree([np.ascontiguousarray(x, kind).tobytes() for x, kind in zip(tree, kinds)])
    for query, best in zip(queries, search.best):
        scores = np.add.reduceat(values * np.isin(columns, np.searchsorted(terms_, query)), starts[:-1])
        assert sorted(best, reverse=True) == sorted(((int(s), -int(k)) for s, k in zip(scores, keys)), reverse=True)[:10]
    assert search.scored < 0.5 * search.leaves


def test_very_long_texts(spark):
    docs = [(1, "one " * 300_000), (2, "x" * 200_000 + " two"), (3, " ".join(f"w{k}" for k in range(100_000))), (4, "one two w5")]
    items = [(1, "ONE two"), (2, " ".join(f"W{k}" for k in range(0, 100_000, 7)))]
    found = ranked_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    assert ranked_documents(docs, items).collect() == []
    assert ranked_documents(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).collect() == []
    assert dict(ranked_documents(docs, items).dtypes)["item_id"] == "int"


def test_words_are_confirmed_by_their_bytes():
    known = ranked_search.Vocabulary([b"one", b"two"])
    known.hashes[:] = np.sort(known.hashes)
    words = ranked_search.splitter()
    data = np.frombuffer(b"TWO one tw0", np.uint8)
    starts, ends, hashes = words.words(data)
    hashes[2] = hashes[0]  # as if a third word had the number of the first
    at, number = known.numbers(data, starts, ends, hashes)
    assert at.tolist() == [0, 1] and number.tolist() == [1, 0]
