"""Quality rules: robust multivariate outliers among documents of one language and source.

A document is described by transformed statistics of its whole text. For each language and
source a minimum-covariance-determinant estimate of centre and spread is found by
concentration steps, and documents too far from it by Mahalanobis distance are rejected.
A step is one aggregation: moments by group and by step of distance, so no group has to fit
into a task and the same rows are chosen whatever the partitions.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelle.llm.common import BLANKS, by_batch, cut, documents, small, texts

SYMBOLS = "#*$%&|<>"
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Each transformed statistic with the least spread that counts as a deviation. Statistics that
#: are zero in most documents would otherwise have no spread at all.
FEATURES = {"log_words": 1.0, "word_length": 0.8, "symbols": 0.045, "dup_lines": 0.25, "repeats": 0.2, "variety": 0.12, "letters": 0.08}
KEEP_SHARE = 0.75
#: Rows from which on a group has an estimate of its own; smaller ones take that of all sources of their language.
LEAST_ROWS = 50
STEPS = 3
ALL = "\0all"
#: Chance that a document of a normal group is rejected.
TAIL = 1e-7


def repeated_words(words: list) -> int:
    """Words inside a five-word window that occurs twice or more."""
    runs = list(zip(*(words[k:] for k in range(WINDOW))))
    if len(set(runs)) == len(runs):
        return 0
    found = Counter(runs)
    total = end = 0
    for at, run in enumerate(runs):
        if found[run] > 1:
            total += at + WINDOW - max(at, end)
            end = at + WINDOW
    return total


def describe(text: str) -> tuple:
    """The counts and the transformed statistics of one text."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    same_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    letters = sum(map(str.isalpha, text))
    return (
        n, chars, symbols, same_lines, repeats,
        math.log1p(n), chars / n if n else 0.0, math.sqrt(symbols / chars) if chars else 0.0,
        math.sqrt(same_lines / len(lines)) if lines else 0.0, math.sqrt(repeats / n) if n else 0.0,
        math.log1p(len(set(words))) / math.log1p(n) if n else 0.0, letters / chars if chars else 0.0,
    )


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", groups: tuple = ("lang", "source")) -> DataFrame:
    """Key, groups, counts, transformed statistics and ``base_failed`` of each row."""
    names = (*COUNTS, *FEATURES)
    kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(FEATURES)
    rows = docs.select(F.col(key).alias("key"), *(F.col(g).cast("string").alias(f"group_{i}") for i, g in enumerate(groups)), F.col(text).alias("text"))
    head = rows.schema.names[:-1]

    def make():
        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = zip(*map(describe, texts(batch.column(len(head)))))
            arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays([*batch.columns[:len(head)], *arrays], [*head, *names])
        return turn

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    fields += [f"{c} long" for c in COUNTS] + [f"{c} double" for c in FEATURES]
    found = by_batch(rows, make, ", ".join(fields))
    return found.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def chi2_quantile(p: int, share: float) -> float:
    """Quantile of the chi-squared distribution with ``p`` degrees, by bisection."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_share(p, middle) < share else (low, middle)
    return high


def chi2_share(p: int, x: float) -> float:
    """Share of the chi-squared distribution with ``p`` degrees up to ``x``, by its power series."""
    if x <= 0:
        return 0.0
    a, half = p / 2, x / 2
    term = total = 1 / a
    k = 0
    while term > total * 1e-17:
        k += 1
        term *= half / (a + k)
        total += term
    return min(1.0, math.exp(a * math.log(half) - half - math.lgamma(a)) * total)


def _distance(shape: str = "shape", centre: str = "centre"):
    """Squared Mahalanobis distance, with the rows of the inverse Cholesky factor in ``shape``."""
    names, total, at = list(FEATURES), F.lit(0.0), 0
    for i in range(len(names)):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.col(shape)[at] * (F.col(names[j]) - F.col(centre)[j])
            at += 1
        total = total + part * part
    return total


def _estimates(moments: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Centre and shape from sums; one row for each group, solved batch by batch."""
    p = len(FEATURES)
    floor = np.diag(np.square(list(FEATURES.values())))
    low = np.tril_indices(p)

    def solve(frames):
        for frame in frames:
            centres, shapes = [], []
            for n, first, second in zip(frame["n"], frame["first"], frame["second"]):
                mean = np.asarray(first) / n
                spread = np.zeros((p, p))
                spread[low] = second
                spread = (spread + np.tril(spread, -1).T) / n - np.outer(mean, mean)
                lower = np.linalg.cholesky(factor * spread + floor)
                centres.append(mean)
                shapes.append(np.linalg.inv(lower)[low])
            yield pd.DataFrame({**{k: frame[k] for k in keys}, "centre": centres, "shape": shapes, "n": frame["n"]})

    schema = ", ".join([*(f"`{k}` string" for k in keys), "centre array<double>", "shape array<double>", "n long"])
    return moments.mapInPandas(solve, schema)


def _with(rows: DataFrame, estimates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the estimate of their group; a missing language or source is a group too."""
    right = small(estimates.select(*(F.col(k).alias(f"{k}_of") for k in keys), "centre", "shape", *(["n"] if "n" in estimates.columns else [])))
    same = [F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys]
    return rows.join(right, same, "left")


def robust_estimates(rows: DataFrame, keys: list[str], share: float = KEEP_SHARE, steps: int = STEPS) -> DataFrame:
    """Minimum-covariance-determinant centre and shape of each group.

    Starts from medians and quartiles; each concentration step takes the ``share`` of rows
    nearest to the last estimate (whole steps of distance, an eighth of a power of two), and
    a last step takes all rows that the estimate finds usual.
    """
    names, p = list(FEATURES), len(FEATURES)
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    quartiles = rows.groupBy(*keys).agg(*(F.percentile_approx(c, [0.25, 0.5, 0.75], 1000).alias(c) for c in names))
    shape = [
        1 / F.sqrt(F.pow((F.col(names[i])[2] - F.col(names[i])[0]) / 1.349, 2) + FEATURES[names[i]] ** 2) if i == j else F.lit(0.0)
        for i, j in pairs
    ]
    estimates = cut(quartiles.select(*keys, F.array(*(F.col(c)[1] for c in names)).alias("centre"), F.array(*shape).alias("shape")))
    cutoff = chi2_quantile(p, share)
    nearest = share / chi2_share(p + 2, cutoff)
    usual = chi2_quantile(p, 0.975)
    for step in range(steps + 1):
        last = step == steps
        far = F.floor(8 * F.log2(_distance() + 1e-9))
        sums = (
            _with(rows, estimates, keys).groupBy(*keys, far.alias("far"))
            .agg(F.count("*").alias("n"), *(F.sum(c).alias(f"a{i}") for i, c in enumerate(names)),
                 *(F.sum(F.col(names[i]) * F.col(names[j])).alias(f"b{at}") for at, (i, j) in enumerate(pairs)))
        )
        nearer = Window.partitionBy(*keys).orderBy("far")
        before = F.sum("n").over(nearer) - F.col("n")
        of_group = F.sum("n").over(Window.partitionBy(*keys))
        taken = F.col("far") <= math.floor(8 * math.log2(usual)) if last else F.col("before") < share * F.col("of_group")
        # The nearest step always counts, so a group never has nothing.
        chosen = sums.withColumns({"before": before, "of_group": of_group}).where(taken | (F.col("before") == 0))
        moments = chosen.groupBy(*keys).agg(
            F.sum("n").alias("n"), F.array(*(F.sum(f"a{i}") for i in range(p))).alias("first"),
            F.array(*(F.sum(f"b{at}") for at in range(len(pairs)))).alias("second"),
        )
        factor = 0.975 / chi2_share(p + 2, usual) if last else nearest
        estimates = cut(_estimates(moments, keys, factor))
    return estimates


def quality_rules(
    docs: DataFrame, key: str = "doc_id", text: str = "text", groups: tuple = ("lang", "source"), tail: float = TAIL,
) -> DataFrame:
    """One row for each row of ``docs``: key, the counts, ``base_failed``, ``distance`` and ``kept``.

    ``kept`` is false where the fixed rules fail or where the squared distance from the robust
    estimate of the row's language and source is beyond the ``tail`` of the chi-squared
    distribution. Only rows that pass the fixed rules shape the estimates, and groups of few
    rows take the estimate of their language. A missing or empty text has no words and fails; a
    missing language or source is a group of its own; a row alone in its language is its centre
    and kept; repeated rows each get a row. An empty table
    gives an empty result. Other columns are ignored.
    """
    keys = ["group_of", *(f"group_{i}" for i in range(len(groups)))]
    rows = cut(statistics(docs, key, text, groups)).withColumn("group_of", F.lit(""))
    # Each row counts in its group and among all that share all but the last column of it.
    both = rows.where(~F.col("base_failed")).withColumn(keys[-1], F.explode(F.array(F.col(keys[-1]), F.lit(ALL))))
    estimates = robust_estimates(both, keys)
    own = estimates.where((F.col("n") >= LEAST_ROWS) & ~F.col(keys[-1]).eqNullSafe(ALL))
    wider = estimates.where(F.col(keys[-1]) == ALL).select(*(F.col(k).alias(f"wide_{k}") for k in keys[:-1]), F.col("centre").alias("wide_centre"), F.col("shape").alias("wide_shape"))
    near = _with(rows, own, keys).join(small(wider), [F.col(k).eqNullSafe(F.col(f"wide_{k}")) for k in keys[:-1]] , "left")
    chosen = near.withColumn("centre", F.coalesce("centre", "wide_centre")).withColumn("shape", F.coalesce("shape", "wide_shape"))
    far = chosen.withColumn("distance", _distance())
    limit = chi2_quantile(len(FEATURES), 1 - tail)
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)
    return far.select(F.col("key").alias(key), *COUNTS, "base_failed", kept.alias("kept"), "distance")


def without_outliers(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, with all their columns; rows with one key go together."""
    gone = quality_rules(docs, key, **options).where("NOT kept").select(F.col(key).alias("_gone")).distinct()
    return docs.join(gone, F.col(key).eqNullSafe(F.col("_gone")), "left_anti")


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))
