"""Grouping of spelling variants: words that differ in one letter, by pivotal grams.

Bigrams of all words have one order, rare ones first. The prefix of a word is its
first three bigrams in that order, and from these a dynamic program picks two
that don't overlap and are rarest together: its pivots. One inserted, deleted or
replaced letter touches at most one of them. So of two near words, that whose
prefix ends earlier in the order has a pivot that is in the prefix of the other
one, and on the side of it that was not touched everything is the same: the
pivot has the same place counted from that end (position limit). Beyond a pivot
one half of what is left is also untouched. An entry of the index therefore stands
for a bigram, the untouched side up to it and one half of the other side; words that
meet in an entry are compared, each pair once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import byte_slices, materialize

MIN_LENGTH = 7
MIN_COUNT = 2
#: How many times more frequent a word's form is at least.
RATIO = 10
#: What a task holds of counted words before it passes them on.
HELD = 500_000

#: Fixed values of the typing noise: one run in NOISE (by checksum) loses a letter.
NOISE = 31


def noisy(word: str, checksum: int) -> str:
    """The run without one letter, if its checksum says so."""
    if checksum % NOISE:
        return word
    at = checksum % len(word)
    return word[:at] + word[at + 1:]


def word_counts(docs: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """(word, n) of the words of at least ``least`` letters after the noise, counted over all texts."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % max(least, 1)).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in byte_slices(batches):
            for name, raw in zip(batch.column("name").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                begun = zlib.crc32(name.encode())
                # bytes.lower changes A-Z only
                for word, n in Counter(runs((raw or b"").lower().decode())).items():
                    checksum = zlib.crc32(word.encode(), begun)
                    if checksum % NOISE == 0:
                        word = noisy(word, checksum)
                        if len(word) < least:
                            continue
                    held[word] += n
            if len(held) > HELD:
                yield batch_of()
                held.clear()
        yield batch_of()

    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    parts = docs.where("text is not null").select(name.alias("name"), "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def prefix_of(word: str, ranks: dict[str, int]) -> list[int]:
    """Places of the word's bigrams in its prefix: the three first ones in the order, and all equal to the last of them."""
    order = sorted((ranks[word[i:i + 2]], i) for i in range(len(word) - 1))
    last = order[min(2, len(order) - 1)][0]
    return [i for rank, i in order if rank <= last]


def pivots_of(word: str, prefix: list[int], ranks: dict[str, int]) -> tuple[int, int]:
    """Two places of the prefix that don't overlap, with the least sum of ranks.

    From left to right: the best single place so far, and the best pair that ends here.
    """
    places = sorted(prefix)
    best: tuple[int, int, int] | None = None
    single: tuple[int, int] | None = None
    behind = 0
    for at in places:
        while places[behind] + 2 <= at:
            cost = ranks[word[places[behind]:places[behind] + 2]]
            if single is None or cost < single[0]:
                single = (cost, places[behind])
            behind += 1
        if single is not None:
            cost = single[0] + ranks[word[at:at + 2]]
            if best is None or cost < best[0]:
                best = (cost, single[1], at)
    # three places, two apart at most neighbours, always hold two without overlap
    return best[1], best[2]


def _entry(*parts: object) -> int:
    return xxhash.xxh3_64_intdigest("\t".join(map(str, parts))) - (1 << 63)


def _halves(side: str, kept: str, rest: str, length: int, other: int) -> Iterator[int]:
    """Entries for a kept side and either half of the rest, as a word of ``other`` letters divides its own rest.

    ``side`` is L if the kept side is the left one. A half of the rest is untouched
    from its outer end; the other word's rest has ``other - length`` letters more.
    """
    theirs = len(rest) + other - length
    first = theirs // 2
    second = theirs - first
    if len(rest) >= first:
        yield _entry(side, other, kept, "1", rest[:first])
    if len(rest) >= second:
        yield _entry(side, other, kept, "2", rest[len(rest) - second:])


def entries(word: str, ranks: dict[str, int]) -> tuple[list[int], list[int], int]:
    """Entries under which others find the word, those it looks up by its pivots, and the rank its prefix ends with."""
    prefix, size = prefix_of(word, ranks), len(word)
    held = {e for i in prefix for side, kept, rest in (("L", word[:i + 2], word[i + 2:]), ("R", word[i:], word[:i])) for e in _halves(side, kept, rest, size, size)}
    left, right = pivots_of(word, prefix, ranks)
    sought = {e for other in (size - 1, size, size + 1) for side, kept, rest in (("L", word[:left + 2], word[left + 2:]), ("R", word[right:], word[:right])) for e in _halves(side, kept, rest, size, other)}
    return list(held), list(sought), max(ranks[word[i:i + 2]] for i in prefix)


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """The order of bigrams, rare ones first; letters are 90, so there are at most 8,100 of them."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, 2))
    counts = words.select(F.explode(grams).alias("gram")).groupBy("gram").count().collect()
    return {r["gram"]: k for k, r in enumerate(sorted(counts, key=lambda r: (r["count"], r["gram"])))}


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b) with a < b of the words (at least four letters each, unique) with one letter inserted, deleted or replaced."""
    ranks = words.sparkSession.sparkContext.broadcast(gram_ranks(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.column("word").slice(at, 4000)
                key, row, role, last = [], [], [], []
                for k, word in enumerate(part.to_pylist()):
                    held, sought, end = entries(word, ranks.value)
                    key += held + sought
                    role += [True] * len(held) + [False] * len(sought)
                    n = len(held) + len(sought)
                    row += [k] * n
                    last += [end] * n
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), part.take(pa.array(row, pa.int64())), pa.array(role, pa.bool_()), pa.array(last, pa.int32())], ["key", "word", "held", "last"])

    found = words.select("word").mapInArrow(run, "key long, word string, held boolean, last int")
    found = materialize(found)
    held = found.where("held").select("key", F.col("word").alias("b"), F.col("last").alias("b_last"))
    sought = found.where("not held").select("key", F.col("word").alias("a"), F.col("last").alias("a_last"))
    met = sought.join(held, "key").where("a != b and b_last >= a_last and abs(length(a) - length(b)) <= 1")
    near = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return near.where(F.levenshtein("a", "b", 1) == 1)


def spelling_variants(docs: DataFrame, least: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n for each word of at least ``least`` letters and ``min_count`` occurrences.

    ``form`` is the near word with the most occurrences (of several, the first in
    code-point order) if it has at least ``ratio`` times as many as the word,
    ``root`` where following the forms ends. A chain of forms has fewer than
    twenty steps, as each one multiplies the occurrences by ``ratio``.

    Null and empty texts have no words, very long ones are taken whole; repeated
    rows count each, with the noise of their doc_id; a null doc_id stands as an
    empty text before the colon. ``least`` is four at least. Empty tables give no
    rows; columns beside doc_id and text play no part.
    """
    if least < 4:
        raise ValueError("words of fewer than four letters have no two bigrams apart in every prefix")
    words = materialize(word_counts(docs, least).where(F.col("n") >= min_count))
    pairs = materialize(near_pairs(words))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    valued = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    # the least of (-n, word) is the most frequent and then the first
    best = valued.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), "b")).alias("best"))
    joined = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    has = -F.col("best.less") >= ratio * F.col("n")
    formed = materialize(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("best.b")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")))
    steps = formed.where("form is not null").select("word", F.col("form").alias("to"))
    # each round follows twice as many steps
    while True:
        further = materialize(steps.join(steps.select(F.col("word").alias("to"), F.col("to").alias("further")), "to", "left"))
        if further.where("further is not null").isEmpty():
            break
        steps = further.select("word", F.coalesce("further", "to").alias("to"))
    roots = steps.select("word", F.col("to").alias("root"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
