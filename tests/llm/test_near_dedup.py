"""Near-duplicates against all pairs by brute force."""

import random
from collections import Counter

import pytest

from parcelle.llm.near_dedup import near_duplicates, shingle_sets, sketches, without_duplicates


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_force(docs):
    """Set sizes and smallest reachable ids."""
    sets = {i: shingles(t) for i, t in docs}
    holders, parent = {}, {i: i for i in sets}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, s in sets.items():
        common = Counter(j for g in s for j in holders[g] if j > i)
        for j, m in common.items():
            if 100 * m >= 75 * (len(s) + len(sets[j]) - m):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def edited(rng, base, changes):
    words = list(base)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10_000)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(3000)}"
    docs = [" ".join(word() for _ in range(rng.randrange(1, 120))) for _ in range(300)]
    base = [word() for _ in range(150)]
    docs += [edited(rng, base, rng.randrange(0, 9)) for _ in range(150)]  # similarities on both sides of the limit
    line = " ".join(word() for _ in range(40))
    docs += [f"{line}\n{' '.join(word() for _ in range(30))}" for _ in range(150)]  # a common passage, no copies
    docs += [docs[5]] * 40 + [docs[6].upper()] * 3 + ["a b c"] * 3 + ["A b\tc", "a b c d", "", "  "]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("block", [512, 16])
def test_same_components(spark, groups, block):
    df = spark.createDataFrame(groups, "doc_id long, text string").repartition(5)
    got = {r[0]: tuple(r[1:]) for r in near_duplicates(df, block=block).collect()}
    assert got == brute_force(groups)


def test_given_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = df.select("doc_id", "text").collect()
    found = brute_force(docs)
    assert {r[0]: tuple(r[1:]) for r in near_duplicates(df).collect()} == found
    kept = without_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, _, k) in found.items() if k)


def test_sets_are_one_row_for_each_class(spark):
    texts = ["a b c d e f g", "a b c d e f h", "k l m n o p q"]
    rows = [(k % 40, texts[0]) for k in range(400)] + [(50, texts[1])] * 300 + [(60, texts[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    wanted = sketches(df).where("key < 60").select("cls", "key")
    classes = [bytes(r["cls"]) for r in shingle_sets(df, wanted, "doc_id", "text").collect()]
    assert len(classes) == 2 and set(classes) == {bytes(r["cls"]) for r in wanted.distinct().collect()}
