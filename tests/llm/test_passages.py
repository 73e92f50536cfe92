"""Repeated passages against windows counted by brute force."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark import cloudpickle

from parcelle.llm import grams, passages
from parcelle.llm.passages import repeated_passages


def brute_force(docs, width):
    words = [(i, (t or "").encode().split()) for i, t in docs]
    windows = Counter(tuple(w[k:k + width]) for _, w in words for k in range(len(w) - width + 1))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - width + 1):
            if windows[tuple(w[k:k + width])] > 1:
                gone.update(range(k, k + width))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def drawn(rng, n, words):
    return [f"{'é' * (k % 3)}w{k}" for k in (rng.randrange(words) for _ in range(n))]


@pytest.mark.parametrize("width, mark, words", [(6, 3, 4), (6, 3, 40), (9, 2, 400), (35, 8, 3000)])
def test_same_rows(spark, width, mark, words):
    rng = random.Random(width * words)
    docs = [drawn(rng, rng.randrange(0, 90), words) for _ in range(120)]
    passage = drawn(rng, width + 20, words)
    for k in range(60):  # parts of one passage with other words around it
        a = rng.randrange(0, 20)
        docs.append([*drawn(rng, rng.randrange(30), words), *passage[a:a + width + rng.randrange(-1, 3)], *drawn(rng, rng.randrange(30), words)])
    docs += [docs[k] for k in (0, 1, 1, 2)] + [docs[3] * 3, ["same"] * 100, ["one", "two"] * 50, ["one", "two", "x"] * 3]
    rows = [(k, rng.choice([" ", "\n", " \t"]).join(d)) for k, d in enumerate(docs)]
    rows += [rows[-1], rows[5], (None, rows[7][1]), (None, None), (3, rows[9][1]), (1000, ""), (1001, " \n")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, key string, start int").repartition(5)
    got = [tuple(r)[:4] for r in repeated_passages(df, width=width, mark=mark).collect()]
    assert sorted(got, key=str) == brute_force(rows, width)


def test_filters_that_let_all_through(spark, monkeypatch):
    """A filter that is full costs time and changes nothing."""
    monkeypatch.setattr(grams.Filter.__init__, "__defaults__", (4,))
    rng = random.Random(8)
    rows = [(k, " ".join(drawn(rng, 60, 30))) for k in range(40)]
    rows += [(50 + k, " ".join(rows[k][1].split()[5:40]) + f" end{k}") for k in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r)[:4] for r in repeated_passages(df, width=8, mark=3).collect()]
    assert sorted(got, key=str) == brute_force(rows, 8)


def test_very_long_texts(spark):
    rows = [(1, "x" * 300_000 + " " + "a b " * 3000), (2, " ".join(f"w{k}" for k in range(200_000))), (3, " ".join(f"w{k}" for k in range(70_000, 70_100)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = [tuple(r)[:4] for r in repeated_passages(df).collect()]
    assert sorted(got, key=str) == brute_force(rows, 35)


def test_kept_text_and_spans(spark):
    shared = " ".join(f"s{k}" for k in range(50))
    df = spark.createDataFrame([(1, f"a b {shared} c"), (2, f"{shared} d\ne"), (3, "other words")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in repeated_passages(df, texts=True).collect()}
    assert {i: r["kept_text"] for i, r in got.items()} == {1: "a b c", 2: "d e", 3: "other words"}
    covered = {i: {w for s in r["spans"] for w in range(s["start"], s["start"] + s["count"] + 34)} for i, r in got.items()}
    assert covered == {1: set(range(2, 52)), 2: set(range(50)), 3: set()}


def test_long_copies_are_one_path(spark):
    text = " ".join(f"w{k}" for k in range(5000))
    df = spark.createDataFrame([(k, f"{text} end{k % 2}") for k in range(6)] + [(9, f"x {text}")], "doc_id long, text string").repartition(3)
    rows = repeated_passages(df).collect()
    assert all(r["n_words"] - r["n_removed"] == (r["doc_id"] == 9) for r in rows)
    assert max(len(r["spans"]) for r in rows) < 60  # not thousands of windows


def test_equal_numbers_of_different_words_are_told_apart(spark, monkeypatch):
    """All words count as one word for the numbers: only the comparison of words is left to tell."""
    real = grams.Splitter.words
    monkeypatch.setattr(grams.Splitter, "words", lambda self, data: (*(found := real(self, data))[:2], found[2] % grams.np.uint64(3)))
    for module in (grams, passages):  # so that tasks get the patched class
        cloudpickle.register_pickle_by_value(module)
    rng = random.Random(4)
    rows = [(k, " ".join(drawn(rng, 12, 50))) for k in range(30)]
    rows += [(40, rows[0][1]), (41, rows[1][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r["n_removed"] for r in repeated_passages(df, width=10, mark=4).collect()}
    for module in (grams, passages):
        cloudpickle.unregister_pickle_by_value(module)
    assert got == {k: 12 * (k in (0, 1, 40, 41)) for k in got}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    found = repeated_passages(df)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"] and found.collect() == []
