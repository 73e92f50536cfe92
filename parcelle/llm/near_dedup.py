"""Near-duplicates by an inverted join over signature coordinates.

A document's five-word shingles give a MinHash signature. Documents are posted under their
(coordinate, value) pairs. Two documents match if enough coordinates agree, so of the pairs that
a document shares with any other, in order of rarity, only a prefix has to be posted: matching
documents meet in it. Postings with the same smallest member are merged into one group, so that
documents which meet many times are compared once. In a group, sizes that can't reach the
similarity, pairs with too few collisions and pairs that are connected already are skipped, and
what is left is confirmed on the full shingle sets. Groups of any size are cut into blocks, and
only links that connect something leave a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import Words, by_batch, cut, documents, raw_texts, windows
from parcelle.llm.decontaminate import BITMAP_BITS, bitmap_of

WIDTH = 5
#: Least similarity in hundredths.
SIMILARITY = 75
#: Coordinates of a signature, and how many have to agree. With 75 % of shingles in common 36
#: agree on average; fewer than 22 do in about one of 100,000 such pairs.
COORDINATES = 48
LEAST_COLLISIONS = 22
#: Members of a block; a task holds the shingle sets of two blocks.
BLOCK = 512

_SEED = np.random.default_rng(5)
_FACTORS = _SEED.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _SEED.integers(0, 2**63, COORDINATES, dtype=np.uint64)
_PLACES = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(48)


def word_table() -> Words:
    return Words(lambda word: (np.uint64(xxhash.xxh3_64_intdigest(word)),), [np.uint64])


def shingle_set(table: Words, text: bytes) -> np.ndarray:
    """Different shingles of a text, sorted, as 64-bit hashes. A-Z count as a-z."""
    at = table.rows(text.lower().split())
    return np.unique(windows(table.columns[0][at], WIDTH))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least value of the shingles under each coordinate's order (48 bits)."""
    low = [(shingles * a + b).min() for a, b in zip(_FACTORS, _SHIFTS)]
    return np.array(low, np.uint64) >> np.uint64(16)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``n_shingles``, ``cls`` (a digest of the shingle set, NULL if empty) and its ``tokens``, one for each coordinate."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))

    def make():
        table = word_table()

        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, classes, tokens = [], [], []
            for raw in raw_texts(batch.column(1)):
                found = shingle_set(table, raw)
                sizes.append(len(found))
                classes.append(_digest(found) if len(found) else None)
                tokens.append((signature(found) | _PLACES).view(np.int64) if len(found) else None)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))],
                ["key", "n_shingles", "cls", "tokens"],
            )
        return turn

    return by_batch(rows, make, "key long, n_shingles long, cls binary, tokens array<long>")


def memberships(classes: DataFrame, coordinates: int = COORDINATES, least: int = LEAST_COLLISIONS) -> DataFrame:
    """Groups (``hub``, ``cls``) in which any two classes with ``least`` common tokens meet.

    A class with m tokens that others have, too, is posted under the m - least + 1 rarest of
    them: of the least common tokens one is always among these, for both.
    """
    tokens = classes.select("cls", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("holders")).where("holders > 1")
    # At most one row for each coordinate in a list.
    of_class = (
        tokens.join(shared, "token").groupBy("cls")
        .agg(F.sort_array(F.collect_list(F.struct("holders", "token"))).alias("held")).where(F.size("held") >= least)
    )
    prefix = F.slice("held", 1, F.size("held") - (least - 1))
    posted = cut(of_class.select("cls", F.explode(prefix).alias("p")).select("cls", F.col("p.token").alias("token")))
    hubs = posted.groupBy("token").agg(F.min("cls").alias("hub"), F.count("*").alias("n")).where("n > 1")
    return cut(posted.join(hubs, "token").select("hub", "cls").distinct())


def shingle_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """``cls``, ``signature`` and ``shingles`` (bytes) of the wanted classes (cls, key), from a second reading of their documents.

    One row for each class, however many documents pass: copies fall away inside batches, then
    before the shuffle and after it.
    """
    hashed = wanted.select(F.xxhash64("key").alias("hash"))
    known = np.packbits(bitmap_of(hashed), bitorder="little")  # of a fixed size; lets some others through
    mask = (1 << BITMAP_BITS) - 1
    rows = docs.select(F.xxhash64(F.col(key).cast("long")).alias("hash"), F.col(text).alias("text"))

    def run(batches):
        table = word_table()
        for batch in batches:
            low = batch.column(0).to_numpy(zero_copy_only=False) & mask
            batch = batch.take(pa.array(np.flatnonzero((known[low >> 3] >> (low & 7).astype(np.uint8)) & 1)))
            if batch.num_rows:
                sets = [s for s in (shingle_set(table, raw) for raw in raw_texts(batch.column(1))) if len(s)]
                by_class = {_digest(s): s for s in sets}
                sets = by_class.values()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(by_class), pa.binary()), pa.array([signature(s).astype(np.uint32).tobytes() for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["cls", "signature", "shingles"],
                )

    found = rows.mapInArrow(run, "cls binary, signature binary, shingles binary")
    return cut(found.dropDuplicates(["cls"]).join(wanted.select("cls"), "cls", "left_semi"))


def links_of(ids: list[bytes], sides: np.ndarray, signatures: np.ndarray, sets: list[np.ndarray], similarity: int, least: int) -> list[tuple]:
    """Similar pairs that connect the members of a group, of which each has a member on either side or all are on one."""
    n = len(ids)
    sizes = np.array([len(s) for s in sets])
    label = np.arange(n)
    across = sides.min() != sides.max()
    starts = np.concatenate([[0], np.cumsum(sizes)])
    at = mark = None
    out = []
    for i in range(n - 1):
        js = np.arange(i + 1, n)
        js = js[label[js] != label[i]]
        if across:
            js = js[sides[js] != sides[i]]
        js = js[100 * np.minimum(sizes[js], sizes[i]) >= similarity * np.maximum(sizes[js], sizes[i])]
        js = js[(signatures[js] == signatures[i]).sum(1) >= least]
        if not len(js):
            continue
        if at is None:
            at = np.unique(np.concatenate(sets), return_inverse=True)[1]
            mark = np.zeros(int(at.max()) + 1, bool)
        mine = at[starts[i]:starts[i + 1]]
        mark[mine] = True
        common = np.array([np.count_nonzero(mark[at[starts[j]:starts[j + 1]]]) for j in js])
        mark[mine] = False
        for j in js[100 * common >= similarity * (sizes[js] + sizes[i] - common)]:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                out.append((ids[i], ids[j]))
    return out


def links(groups: DataFrame, sets: DataFrame, similarity: int = SIMILARITY, least: int = LEAST_COLLISIONS, block: int = BLOCK) -> DataFrame:
    """Links (``a``, ``b``) between classes of a group, enough to connect all that are similar."""
    sizes = groups.groupBy("hub").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / block).cast("int")
    placed = groups.join(sizes, "hub").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    meets = placed.select("hub", "cls", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = meets.join(sets, "cls").select("hub", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "cls", "signature", "shingles")

    def run(batches):
        now, ids, sides, signatures, members = None, [], [], [], []

        def found() -> pa.RecordBatch:
            pairs = links_of(ids, np.array(sides), np.stack(signatures), members, similarity, least) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            hubs, lows, highs, owns, classes = (batch.column(k).to_pylist() for k in range(5))
            for k, (hub, low, high) in enumerate(zip(hubs, lows, highs)):
                if (hub, low, high) != now:
                    if len(ids) > 1:
                        yield found()
                    now, ids, sides, signatures, members = (hub, low, high), [], [], [], []
                ids.append(classes[k])
                sides.append(owns[k])
                signatures.append(np.frombuffer(batch.column(5)[k].as_py(), np.uint32))
                members.append(np.frombuffer(batch.column(6)[k].as_py(), np.uint64))
        if len(ids) > 1:
            yield found()

    keys = ["hub", "low", "high"]
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys, "cls").mapInArrow(run, "a binary, b binary").distinct()


def components(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """``cls`` and ``label`` (the least (name, cls) reachable) of each class in a link, from links (a, b) and names (cls, name).

    Each round takes the least label around a class, then that of the class it names, until
    nothing changes.
    """
    edges = cut(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = cut(edges.select(F.col("a").alias("cls")).distinct().join(names, "cls").select("cls", F.struct("name", "cls").alias("label")))
    while True:
        near = edges.join(labels, edges["b"] == labels["cls"]).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(near, labels["cls"] == near["a"]).select("cls", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        named = labels.select(F.col("cls").alias("named"), F.col("label").alias("its"))
        jumped = nearer.join(named, F.col("label.cls") == F.col("named"))
        fresh = cut(jumped.select("cls", F.least("label", "its").alias("label"), (F.least("label", "its") != F.col("was")).alias("changed")))
        labels = fresh.select("cls", "label")
        if fresh.where("changed").isEmpty():
            return labels


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: int = SIMILARITY, least: int = LEAST_COLLISIONS, block: int = BLOCK,
) -> DataFrame:
    """One row for each row of ``docs``: key, ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the least key that links reach, ``kept`` whether it is the row's own. A
    text with fewer than five words is one shingle. Missing and empty texts have none and are
    linked with nothing: their component is their own. Equal sets, and so repeated rows, are in
    one component; a missing key is no name for a component unless nothing else is in it. An
    empty table gives an empty result; other columns are ignored.
    """
    found = cut(sketches(docs, key, text))
    last = (1 << 63) - 1
    classes = cut(
        found.where("cls IS NOT NULL").groupBy("cls")
        .agg(F.coalesce(F.min("key"), F.lit(last)).alias("name"), F.first("tokens").alias("tokens"))
    )
    groups = memberships(classes, COORDINATES, least)
    wanted = groups.select("cls").distinct().join(classes.select("cls", F.col("name").alias("key")), "cls")
    sets = shingle_sets(docs, wanted.withColumn("key", F.when(F.col("key") != last, F.col("key"))), key, text)
    labels = components(links(groups, sets, similarity, least, block), classes.select("cls", "name"))
    named = (
        classes.select("cls", "name").join(labels, "cls", "left")
        .select("cls", F.coalesce("label.name", "name").alias("name"))
    )
    named = named.select("cls", F.when(F.col("name") != last, F.col("name")).alias("component"))
    out = found.select("key", "n_shingles", "cls").join(named, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("key")).otherwise(F.col("component"))
    return out.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"))


def without_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is kept by :func:`near_duplicates`, with all their columns.

    A document goes by its key; of equal rows (key and text) one stays.
    """
    gone = near_duplicates(docs, key, text).where("NOT kept").select(F.col(key).alias("_gone")).distinct()
    rows = docs.join(gone, F.col(key).eqNullSafe(F.col("_gone")), "left_anti")
    repeated = docs.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("n")).where("n > 1").select("_key")
    if repeated.isEmpty():
        return rows
    same = F.col(key).eqNullSafe(F.col("_key"))
    again = rows.join(repeated, same, "left_semi").dropDuplicates([key, text])
    return rows.join(repeated, same, "left_anti").unionByName(again)


def op1_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
