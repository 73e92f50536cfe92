"""Language-model scores: a hashed maximum-entropy model beside smoothed word frequencies.

A word's probability is that of its class in context times its share of the class. The class is
predicted by a softmax over hashed features: the word before, the two words before, and the word
before that skipped. Weights are trained by distributed gradient updates: in each round tasks
take gradient steps over their part of the round's documents, from weights all share, and the
changes are averaged by the words they were learned from. Scoring is batches of sparse rows:
each word picks its features' rows of the weights.

Classes and rows of the weights follow the number of different words, up to bounds, and go to all
tasks, as do the counts of frequent words. Counts of all other words stay a table that is joined,
so nothing grows without bound on the driver. Texts are read in slices of bounded size, words
are numbers from prefix polynomials, and no task keeps words. A part of the training holds so many
tokens, whatever the cluster.
"""

from __future__ import annotations

from copy import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import BLANKS, cut, documents, mixed, raw_texts
from parcelle.llm.grams import Splitter, slices

SMOOTH = 0.1
#: Words that are a class each; all others fall into classes by their endings.
OWN_CLASSES = 15
#: Classes of a small vocabulary, and at most: four more for each doubling above 2**20 words.
CLASSES, MOST_CLASSES = 32, 64
#: Words whose counts every task has at hand.
FREQUENT = 1 << 18
#: Rows of the weights as a power of two: a 64th of the different words, between these.
FEATURE_BITS, MOST_FEATURE_BITS = 14, 17
FEATURES = 3
ROUNDS = 3
RATE = 0.5
BATCH = 4096
#: Tokens of a part of the training, about; its task sends one change of the weights.
TOKENS_OF_A_PART = 8_000_000
#: Different words that a task counts before they leave it.
MOST_KEPT = 300_000
_ROWS_SENT = 1 << 11
#: Rows of a group that are added together with those of other groups; logits whose exp is far inside single precision.
_ROWS_AT_ONCE, _LARGE = 16, 60.0
_START, _END = np.uint64(0x9E6C63D0876A9A4B), np.uint64(0xC2B2AE3D27D4EB4F)
_SEPARATORS = BLANKS.encode()
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_SIGN = np.isin(np.arange(256), np.frombuffer(b".,;:!?", np.uint8))


def splitter() -> Splitter:
    return Splitter(_SEPARATORS, lower=True)


def classes_for(words: int) -> int:
    return min(MOST_CLASSES, CLASSES + 4 * max(0, words.bit_length() - 20))


def bits_for(words: int) -> int:
    return min(MOST_FEATURE_BITS, max(FEATURE_BITS, words.bit_length() - 6))


class Tokens:
    """The tokens of some texts, one text after the other: a number and an ending for each.

    A text is its words, then one end; two starts stand before it. ``places`` are those of the
    tokens, ``sizes`` how many each text has. The ending is a number made of a word's last two
    bytes, without a sign at its end.
    """

    def __init__(self, split: Splitter, texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        starts, ends, hashes = split.words(data)
        text = np.searchsorted(np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]), starts, "right") - 1
        words = np.bincount(text, minlength=len(texts))
        self.sizes = words + 1
        self.numbers = np.full(len(starts) + 3 * len(texts), _START)
        self.endings = np.zeros(len(self.numbers), np.uint64)
        self.ends = np.cumsum(self.sizes + 2) - 1
        at = np.arange(len(starts)) + 3 * text + 2
        self.numbers[at], self.numbers[self.ends] = hashes, _END
        if len(starts):
            last = ends - 1
            last = last - (_SIGN[data[last]] & (last > starts))
            before = np.maximum(last - 1, starts)
            self.endings[at] = _LOWER[data[before]] << np.uint64(8) | _LOWER[data[last]]
        self.places = np.arange(int(self.sizes.sum())) + np.repeat(2 * np.arange(1, len(texts) + 1), self.sizes)


def token_slices(batch_texts: list[bytes], split: Splitter):
    """Ranges of texts and their tokens."""
    for a, b in slices(batch_texts):
        yield a, b, Tokens(split, batch_texts[a:b])


def _is_held_out(key):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` (its number), ``ending`` and count ``n`` of each token of the texts, their ends included."""
    def run(batches):
        split = splitter()
        kept: list[tuple] = []
        held = 0

        def summed() -> tuple:
            words, endings, counts = (np.concatenate(x) for x in zip(*kept))
            found, first, of = np.unique(words, return_index=True, return_inverse=True)
            return found, endings[first], np.bincount(of, counts).astype(np.int64)

        def row(words, endings, counts) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(endings.astype(np.int64)), pa.array(counts)], ["word", "ending", "n"])

        for batch in batches:
            for _, _, part in token_slices(raw_texts(batch.column(0)), split):
                found, first, counts = np.unique(part.numbers[part.places], return_index=True, return_counts=True)
                kept.append((found, part.endings[part.places[first]], counts))
                held += len(found)
                if held > 2 * MOST_KEPT:
                    kept = [summed()]
                    held = len(kept[0][0])
                    if held > MOST_KEPT:
                        yield row(*kept[0])
                        kept, held = [], 0
        if held:
            yield row(*summed())

    return texts.mapInArrow(run, "word long, ending long, n long").groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """Words of the highest counts, ``most`` of them at most: all that have more than some count."""
    steps = counts.groupBy(F.floor(8 * F.log2("n")).alias("step")).agg(F.count("*").alias("words"))
    taken, least = 0, None
    for step, words in steps.orderBy(F.desc("step")).collect():  # eight rows for each doubling of the largest count
        taken += words
        if taken > most:
            break
        least = step
    rows = counts.select("word", "n")
    return rows.limit(0) if least is None else rows.where(F.floor(8 * F.log2("n")) >= least)


class Model:
    """Classes and weights; what tasks need to train and to score."""

    def __init__(self, own: list[int], prior: np.ndarray, bits: int = FEATURE_BITS):
        self.own = np.array(sorted(own), np.int64)
        self.own_class = np.array([own.index(h) for h in self.own.tolist()], np.int32)
        self.prior, self.bits = prior.astype(np.float32), bits
        self.weights = np.zeros((1 << bits, len(prior)), np.float32)
        self.squares = np.zeros(1 << bits, np.float32)

    def classes(self, numbers: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = class_of_ending(endings, len(self.prior))
        if len(self.own):
            signed = numbers.view(np.int64)
            at = np.minimum(np.searchsorted(self.own, signed), len(self.own) - 1)
            found = self.own[at] == signed
            out[found] = self.own_class[at[found]]
        return out

    def features(self, numbers: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows of the weights, feature by feature, for the tokens at the places ``at`` of a sequence of words."""
        last, before = numbers[at - 1], numbers[at - 2]
        right = np.uint64(64 - self.bits)
        return np.stack([(mixed(x) >> right).astype(np.int32) for x in (
            last, last * np.uint64(3) + before, before ^ np.uint64(0x5851F42D4C957F2D))])


def class_of_ending(endings: np.ndarray, classes: int) -> np.ndarray:
    return (OWN_CLASSES + mixed(endings + np.uint64(1)) % np.uint64(classes - OWN_CLASSES)).astype(np.int32)


def logits(model: Model, rows: np.ndarray) -> np.ndarray:
    """Of each token the logits of its classes, less a number of its own where they might leave the range of exp."""
    total = model.weights.take(rows[0], axis=0)
    for more in rows[1:]:
        total += model.weights.take(more, axis=0)
    total += model.prior
    if total.size and not -_LARGE < total.min() <= total.max() < _LARGE:
        total -= total.max(axis=1, keepdims=True)
    return total


def log_chances(model: Model, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each token's class."""
    total = logits(model, rows)
    own = total[np.arange(len(classes)), classes]
    return own - np.log(_row_sums(np.exp(total, out=total)))


def _row_sums(values: np.ndarray) -> np.ndarray:
    return np.einsum("ij->i", values)


def group_sums(values: np.ndarray, order: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of rows by group, the groups from large to small: ``sizes`` places of ``order``, from ``first`` on.

    Most groups have a row or two, and a few very many: the k-th rows of all groups that have so many
    are added at once, and what is left of the largest group by group.
    """
    sums, least = values.take(order[first], axis=0), -sizes
    for k in range(1, _ROWS_AT_ONCE):
        longer = int(np.searchsorted(least, -k))  # groups of more than k rows
        if not longer:
            return sums
        sums[:longer] += values.take(order[first[:longer] + k], axis=0)
    for g in range(int(np.searchsorted(least, -_ROWS_AT_ONCE))):
        sums[g] += values.take(order[first[g] + _ROWS_AT_ONCE:first[g] + sizes[g]], axis=0).sum(axis=0)
    return sums


def step(model: Model, rows: np.ndarray, classes: np.ndarray) -> None:
    """One gradient step over a batch of tokens, each row at a rate that falls with its past gradients."""
    gradient = logits(model, rows)
    np.exp(gradient, out=gradient)
    gradient /= _row_sums(gradient)[:, None]
    n = len(classes)
    gradient[np.arange(n), classes] -= 1
    # A row of the weights and a place in one number, which sort faster than places by rows.
    keys = rows.ravel().astype(np.int64) << 32 | np.tile(np.arange(n), len(rows))
    keys.sort()
    ordered, order = keys >> 32, keys & 0xFFFFFFFF
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sizes = np.diff(first, append=len(ordered))
    by_size = np.argsort(-sizes)
    first, sizes = first[by_size], sizes[by_size]
    touched = ordered[first]
    sums = group_sums(gradient, order, first, sizes)
    squares = model.squares[touched] + np.einsum("ij,ij->i", sums, sums)
    model.squares[touched] = squares
    sums *= (-RATE / np.sqrt(squares + 1))[:, None]
    sums += model.weights.take(touched, axis=0)
    model.weights[touched] = sums


def train(texts: DataFrame, model: Model, parts: int) -> Model:
    """The model after one round over the texts, which are taken together to so many parts."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def learn(batches):
        model, split = shared.value, splitter()
        own = copy(model)
        own.weights, own.squares = model.weights.copy(), model.squares.copy()
        seen = 0
        for batch in batches:
            for _, _, part in token_slices(raw_texts(batch.column(0)), split):
                classes = own.classes(part.numbers, part.endings)
                for k in range(0, len(part.places), BATCH):
                    at = part.places[k:k + BATCH]
                    step(own, own.features(part.numbers, at), classes[at])
                seen += len(part.places)
        if seen:
            change = np.concatenate([own.weights - model.weights, (own.squares - model.squares)[:, None]], axis=1)
            blocks = [change[k:k + _ROWS_SENT].tobytes() for k in range(0, len(change), _ROWS_SENT)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int64()), pa.array([seen] * len(blocks), pa.int64()), pa.array(blocks, pa.binary())], ["block", "seen", "change"])

    def average(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for block, seen, change in zip(*(c.to_pylist() for c in batch.columns)):
                held = sums.setdefault(block, [0, 0.0])
                held[0] += seen
                held[1] = held[1] + seen * np.frombuffer(change, np.float32).astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array([s for s, _ in sums.values()], pa.int64()), pa.array([(c / s).astype(np.float32).tobytes() for s, c in sums.values()], pa.binary())],
                ["block", "seen", "change"])

    schema = "block long, seen long, change binary"
    # Each part sends a change of the size of the weights.
    texts = texts.coalesce(parts)
    # The sums of a block pass through one task as a stream; there are as many rows as the weights have blocks.
    changes = texts.mapInArrow(learn, schema).repartition(len(model.weights) // _ROWS_SENT, "block").mapInArrow(average, schema)
    for block, _, change in changes.toLocalIterator():
        found = np.frombuffer(bytes(change), np.float32).reshape(-1, model.weights.shape[1] + 1)
        part = slice(block * _ROWS_SENT, block * _ROWS_SENT + len(found))
        model.weights[part] += found[:, :-1]
        model.squares[part] += found[:, -1]
    return model


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """One row for each row of ``docs``: key, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learns from the rows whose key's checksum is not divisible by ten; the others, and none with a
    missing key, are held out. Scores are log10 probabilities of the text and its end. A missing
    or empty text is its end alone. Repeated rows each count and get a row; without training
    rows every token is unknown, and an empty table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(key).alias("key"), _is_held_out(key).alias("held_out"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    learned = rows.where("NOT held_out")
    counts = cut(word_counts(learned.select("text")))
    tokens, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    known = most_frequent(counts, frequent).toPandas().sort_values(["n", "word"], ascending=[False, True])  # of a fixed size
    own = known["word"].head(OWN_CLASSES).tolist()
    classes, bits = classes_for(vocabulary), bits_for(vocabulary)
    of_ending = counts.where(~F.col("word").isin(own)).groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("types"))
    totals, types = np.zeros(classes), np.ones(classes)
    for ending, n, kinds in of_ending.toLocalIterator():  # a row for each two bytes at most
        at = class_of_ending(np.array([ending], np.int64).view(np.uint64), classes)[0]
        totals[at] += n
        types[at] += kinds
    totals[:len(own)] = known["n"].head(OWN_CLASSES)
    inside = totals + SMOOTH * types
    prior = np.log((totals + SMOOTH) / (totals + SMOOTH).sum())
    model = Model(own, prior, bits)
    part = F.pmod(F.xxhash64("key", "text"), F.lit(rounds))
    for k in range(rounds):
        model = train(learned.where(part == k).select("text"), model, max(1, tokens // (rounds * TOKENS_OF_A_PART)))

    by_word = known.sort_values("word")
    shared = docs.sparkSession.sparkContext.broadcast((
        model, by_word["word"].to_numpy(np.int64), np.log10(by_word["n"].to_numpy(np.float64) + SMOOTH), np.log10(inside)))

    def score(part: Tokens, model: Model, frequent_words, frequent_logs, inside_logs) -> list[pa.Array]:
        at = part.places
        classes = model.classes(part.numbers, part.endings)
        logs = np.empty(len(at))
        for k in range(0, len(at), BATCH):
            place = at[k:k + BATCH]
            logs[k:k + BATCH] = log_chances(model, model.features(part.numbers, place), classes[place]) / np.log(10) - inside_logs[classes[place]]
        signed = part.numbers[at].view(np.int64)
        is_known, words = np.zeros(len(at), bool), np.zeros(len(at))
        if len(frequent_words):
            near = np.minimum(np.searchsorted(frequent_words, signed), len(frequent_words) - 1)
            is_known = frequent_words[near] == signed
            words[is_known] = frequent_logs[near[is_known]]
        sizes = part.sizes
        first = np.cumsum(sizes) - sizes
        text_of, rare = np.repeat(np.arange(len(sizes)), sizes)[~is_known], signed[~is_known]
        order = np.lexsort((rare, text_of))
        rare, text_of = rare[order], text_of[order]
        new = np.ones(len(rare), bool)
        new[1:] = (rare[1:] != rare[:-1]) | (text_of[1:] != text_of[:-1])
        begins = np.flatnonzero(new)
        times = np.diff(np.append(begins, len(rare)))
        offsets = pa.array(np.searchsorted(text_of[begins], np.arange(len(sizes) + 1)), pa.int32())
        sums = [np.add.reduceat(x, first) for x in (is_known.astype(np.int64), words, logs)]
        return [
            pa.array(sizes), *map(pa.array, sums), pa.ListArray.from_arrays(offsets, pa.array(rare[begins])),
            pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))]

    def run(batches):
        split, given = splitter(), shared.value
        for batch in batches:
            for a, b, part in token_slices(raw_texts(batch.column(2)), split):
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), rows.column(3), *score(part, *given)],
                    ["key", "held_out", "row", "n_tokens", "n_known", "words", "classes", "rare", "times"])

    kind = rows.schema["key"].dataType.simpleString()
    scored = cut(rows.select("key", "held_out", "text", "row").mapInArrow(
        run, f"key {kind}, held_out boolean, row long, n_tokens long, n_known long, words double, classes double, rare array<long>, times array<int>"))
    # What is not among the frequent words: the counts of the others are joined word by word, once for each text.
    others = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    joined = others.join(counts.select("word", "n"), "word", "left")
    more = joined.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("more"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("found"))
    whole = scored.drop("rare", "times").join(more, "row", "left")
    of_words = F.col("words") + F.coalesce("more", F.lit(0.0))
    norm = float(np.log10(tokens + SMOOTH * (vocabulary + 1)))
    return whole.select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), (of_words - F.col("n_tokens") * norm).alias("base_score"),
        (of_words + F.col("classes")).alias("score"))


def op6_maxent_score(spark, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir))
