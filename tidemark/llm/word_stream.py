"""Words of whole texts as numbers: rolling fingerprints of bytes and of word sequences, and bitmaps of fingerprints."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U64 = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which every bit hangs on all of them."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


class Rolling:
    """Rabin-Karp fingerprints modulo 2**64: windows of a sequence by differences of prefix polynomials."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.base = U64(int(rng.integers(1 << 62, 1 << 63)) | 5)
        #: A random number for each byte; capitals A-Z count as their small letters.
        self.bytes = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
        self.bytes[ord("A"):ord("Z") + 1] = self.bytes[ord("a"):ord("z") + 1]
        self._up = self._down = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if len(self._up) < n:
            size = 1 << (n - 1).bit_length()
            inverse = U64(pow(int(self.base), -1, 1 << 64))
            for name, base in (("_up", self.base), ("_down", inverse)):
                steps = np.full(size, base, U64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Prefix polynomials of a sequence of 64-bit numbers, one more than it has."""
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, U64)
        np.cumsum(values * self._up[:len(values)], out=out[1:])
        return out

    def windows(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The polynomial of each window, moved to the beginning; equal windows have equal ones."""
        return (sums[ends] - sums[starts]) * self._down[starts]


@dataclass
class Words:
    """The words of several texts in a row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    #: The text of each word, and the byte at which each text begins.
    text: np.ndarray
    text_starts: np.ndarray
    #: Fingerprints of the words' bytes, a row for each polynomial.
    prints: list[np.ndarray]


def words_of(values: list[bytes], blank: np.ndarray, rolling: list[Rolling], segment: int = 1 << 20) -> Words:
    """Words are what stands between bytes of the table ``blank``, which holds the line feed.

    Long data go through in segments that end at blanks, so that working memory
    beside the words' own numbers is bounded.
    """
    data = np.frombuffer(b"\n".join(values) + b"\n", np.uint8)
    starts, ends, prints, at = [], [], [[] for _ in rolling], 0
    while at < len(data):
        stop = min(at + segment, len(data))
        while not blank[data[stop - 1]]:
            stop += 1
        part = data[at:stop]
        gap = blank[part]
        before = np.concatenate([[True], gap[:-1]])
        first, last = np.flatnonzero(before & ~gap), np.flatnonzero(~before & gap)
        for r, found in zip(rolling, prints):
            found.append(mixed(r.windows(r.sums(r.bytes[part]), first, last)))
        starts.append(first + at)
        ends.append(last + at)
        at = stop
    sizes = np.fromiter(map(len, values), np.int64, len(values)) + 1
    text_ends = np.cumsum(sizes)
    begun = np.concatenate(starts)
    return Words(data, begun, np.concatenate(ends), np.searchsorted(text_ends, begun, side="right"), text_ends - sizes, [np.concatenate(p) for p in prints])


#: Bits of a bitmap: at least, at most (32 MB) and for each print, rounded up to a power of two.
LEAST_BITS, MOST_BITS, BITS_A_PRINT = 18, 28, 16


@dataclass
class PrintFilter:
    """A bitmap of fingerprints of bounded size: it knows all of a set, and with more of them lets others through more often."""

    bits: int
    bitmap: np.ndarray

    def holds(self, prints: np.ndarray) -> np.ndarray:
        out = np.ones(len(prints), bool)
        for at in (prints & U64((1 << self.bits) - 1), prints >> U64(64 - self.bits)):
            out &= (self.bitmap[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8)) & 1 == 1
        return out


def print_filter(df: DataFrame, column: str, most_bits: int = MOST_BITS) -> PrintFilter:
    """The bitmap of a column of fingerprints, built by tasks; at most 2**most_bits bits reach the driver."""
    bits = min(max((max(df.count(), 1) * BITS_A_PRINT - 1).bit_length(), LEAST_BITS), most_bits)
    low: Column = F.col(column).bitwiseAND((1 << bits) - 1)
    high: Column = F.shiftrightunsigned(column, 64 - bits)
    at = F.explode(F.array(low + 1, high + 1))
    parts = df.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map"))
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for part, found in parts.collect():
        # a short bitmap takes the head of its only part
        bitmap[(part - 1) * len(found):part * len(found)] = np.frombuffer(bytes(found), np.uint8)[:len(bitmap)]
    return PrintFilter(bits, bitmap)
