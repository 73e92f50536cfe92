"""Collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark import cloudpickle

from parcelle.llm import collocations as module
from parcelle.llm import grams
from parcelle.llm.collocations import collocations


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_force(rows, longest=3, least=10, top=2000, inside=50):
    counts, words = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^ \t]+", piece)
            words[lang] += len(w)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(w[k:k + size]) for k in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for k in range(len(p) - size + 1):
                    held[p[k:k + size]] = max(held[p[k:k + size]], a)
        ranked = []
        for p, a in candidates.items():
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            if not held[p] or 100 * held[p] < inside * a:
                ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, words[lang], -score))
    return sorted(out)


def texts(n, seed):
    rng = random.Random(seed)
    names = [f"W{k}" for k in range(12)] + ["Été", "été", "\U0001F600", "naïve", "x'y", "the"]
    phrases = [" ".join(rng.choice(names) for _ in range(rng.randrange(2, 6))) for _ in range(12)]
    make = lambda: rng.choice(phrases) if rng.random() < 0.5 else rng.choice(names)
    rows = [("".join(make() + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!? "]) for _ in range(rng.randrange(40))), rng.choice(["en", "fr", None, "und", ""])) for _ in range(n)]
    return rows + [(None, "en"), ("", "xx"), ("  ...", None), rows[0], rows[0]]


def spark_rows(spark, rows, **given):
    df = spark.createDataFrame([(k if k % 7 else None, t, lang, "k", 1) for k, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, n long").repartition(4)
    return collocations(df, **given)


@pytest.mark.parametrize("given", [{}, {"longest": 4, "least": 4, "top": 15, "inside": 80}, {"longest": 2, "least": 1}])
def test_same_rows(spark, given):
    rows = texts(300, 3)
    got = spark_rows(spark, rows, **given)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "seen_in"]
    assert sorted(tuple(r)[:8] for r in got.collect()) == brute_force(rows, **given)


def test_pointers_lead_to_the_phrase(spark):
    rows = texts(100, 5)
    for r in spark_rows(spark, rows).collect():
        if r["seen_in"] is not None:
            assert r["phrase"] in re.sub(r"[ \t]+", " ", lower(rows[r["seen_in"]][0]))


def test_one_fingerprint_for_many_runs(spark, monkeypatch):
    """All words have one of two numbers: only their text tells them apart."""
    real = grams.Splitter.words
    monkeypatch.setattr(grams.Splitter, "words", lambda self, data: (*(found := real(self, data))[:2], found[2] % grams.np.uint64(2)))
    for m in (grams, module):
        cloudpickle.register_pickle_by_value(m)
    rows = texts(120, 8)
    got = sorted(tuple(r)[:8] for r in spark_rows(spark, rows).collect())
    for m in (grams, module):
        cloudpickle.unregister_pickle_by_value(m)
    assert got == brute_force(rows)


def test_filters_that_let_all_through(spark, monkeypatch):
    monkeypatch.setattr(grams.Filter.__init__, "__defaults__", (4,))
    rows = texts(120, 10)
    assert sorted(tuple(r)[:8] for r in spark_rows(spark, rows).collect()) == brute_force(rows)


def test_small_buffers(spark, monkeypatch):
    """Tasks that keep and slice less give the same."""
    monkeypatch.setattr(module, "MOST_KEPT", 20)
    monkeypatch.setattr(grams.slices, "__defaults__", (200,))
    for m in (grams, module):
        cloudpickle.register_pickle_by_value(m)
    rows = texts(120, 9)
    got = sorted(tuple(r)[:8] for r in spark_rows(spark, rows).collect())
    for m in (grams, module):
        cloudpickle.unregister_pickle_by_value(m)
    assert got == brute_force(rows)


def test_long_text_and_large_counts(spark):
    rows = [("the cat sat " * 60_000, "en"), ("x" * 100_000 + " y", "en"), ("a b. " * 12, "fr")]
    assert sorted(tuple(r)[:8] for r in spark_rows(spark, rows).collect()) == brute_force(rows)


def test_empty_table(spark):
    assert collocations(spark.createDataFrame([], "doc_id long, text string, lang string")).collect() == []
