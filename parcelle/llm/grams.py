"""Words and runs of words of many texts as numbers, by prefix polynomials in numpy.

Texts are taken in slices of bounded size, joined by line feeds. A prefix polynomial over the
bytes gives a 64-bit number for each word; one over these numbers gives a number for any run of
words by a subtraction, wherever it starts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import mixed

#: Bytes of a slice; a longer text is a slice of its own.
SLICE = 1 << 20
#: Most bits of a filter (32 MB). A larger set fills it further, which lets more through and loses nothing.
MOST_BITS = 28
_BYTES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)


def slices(texts: list[bytes], most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``most`` bytes."""
    first = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, k
            first, size = k, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were asked for."""

    def __init__(self, base: int):
        self.bases = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.rows = [np.ones(1, np.uint64)] * 2

    def __call__(self, n: int) -> list[np.ndarray]:
        if len(self.rows[0]) < n:
            size = 1 << (n - 1).bit_length()
            self.rows = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base)])) for base in self.bases]
        return [row[:n] for row in self.rows]

    def kept(self, most: int) -> None:
        """Lets go of more powers than ``most``, as after one very long text."""
        self.rows = [row[:most].copy() if len(row) > most else row for row in self.rows]


_OF_BYTES = Powers(0xD6E8FEB86659FD93)
_OF_WORDS = Powers(0xA0761D6478BD642F)


class Splitter:
    """Maximal runs of bytes that are no separators, and a number for each; ``lower`` takes A-Z for a-z."""

    def __init__(self, separators: bytes, lower: bool):
        self.inside = np.ones(256, bool)
        self.inside[np.frombuffer(separators, np.uint8)] = False
        self.values = _BYTES.copy()
        if lower:
            self.values[65:91] = self.values[97:123]

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and numbers of the words in bytes that begin or end anywhere."""
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = self.inside[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        hashes = np.empty(len(starts), np.uint64)
        low = 0
        while low < len(starts):  # a text of any length takes bounded memory here
            high = max(low + 1, int(np.searchsorted(ends, starts[low] + SLICE, "right")))
            begin, end = int(starts[low]), int(ends[high - 1])
            up, down = _OF_BYTES(end - begin + 1)
            sums = np.zeros(end - begin + 1, np.uint64)
            np.cumsum(self.values[data[begin:end]] * up[:-1], out=sums[1:])
            s, e = starts[low:high] - begin, ends[low:high] - begin
            hashes[low:high] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
            low = high
        _OF_BYTES.kept(4 * SLICE)
        return starts, ends, hashes


class Runs:
    """Numbers of runs of words."""

    def __init__(self, hashes: np.ndarray):
        self.down = _OF_WORDS(len(hashes) + 1)[1]
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * _OF_WORDS(len(hashes) + 1)[0][:-1], out=self.sums[1:])
        _OF_WORDS.kept(SLICE)

    def all(self, width: int) -> np.ndarray:
        """Of the run of ``width`` words from each word on that has so many after it."""
        n = max(0, len(self.sums) - width)
        return mixed((self.sums[width:] - self.sums[:n]) * self.down[:n]) if n else np.zeros(0, np.uint64)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


class Filter:
    """Which numbers may be in a set: all that are, and some others. Bits by the size of the set, up to MOST_BITS."""

    def __init__(self, numbers: DataFrame, column: str, count: int, most_bits: int = MOST_BITS):
        bits = min(most_bits, max(16, (16 * count).bit_length()))
        low = numbers.select((F.col(column).bitwiseAND(F.lit((1 << bits) - 1)) + 1).alias("low"))
        maps = low.groupBy(F.expr("bitmap_bucket_number(low)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(low))").alias("map"))
        self.map = np.zeros(1 << (bits - 3), np.uint8)
        for bucket, raw in maps.toLocalIterator():  # buckets of 4 kB, counted from 1
            at = (bucket - 1) * 4096
            self.map[at:at + 4096] = np.frombuffer(bytes(raw), np.uint8)[:len(self.map) - at]
        self.mask = np.uint64((1 << bits) - 1)

    def __call__(self, numbers: np.ndarray) -> np.ndarray:
        low = (numbers & self.mask).astype(np.int64)
        return ((self.map[low >> 3] >> (low & 7).astype(np.uint8)) & 1).astype(bool)
