"""Exact Jaccard self-join on word n-grams by rare-first prefix filtering.

Two documents link when their sets of word shingles have a Jaccard similarity
of at least ``percent``/100. Each document's shingles are put in one global
order, rare ones first; linked documents must then share a shingle within their
prefixes. The join runs on prefix shingles only, and length, positional and
suffix filters drop pairs before their texts are compared, once each.

Documents with equal sets are one class from the start. The result is whole but
does not spell out all pairs of a large group of near copies: every class is
first compared with the leaders of its shingles, the classes with the fewest
rarer shingles before them: with the one that leads most of its shingles, then
with those in other components. Only then the members that are in another
component than a leader are compared with those who share the shingle and whose sizes its own
size and place allow; sizes are part of that join's key. A pair that shares a
prefix shingle is thus either ruled out, compared or known to be in one component
already.

Shingles and sets are 64-bit fingerprints of the words' bytes; equal sets are one
class if 128 bits of theirs agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._common import FEW_KEYS, as_row, byte_slices, materialize, of_row, with_keys, without_keys

N = 5
PERCENT = 75

U64 = np.uint64
_RNG = np.random.default_rng(20240229)
#: A random odd number for each byte value, and the base of the polynomial.
BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = U64(0x9E3779B97F4A7C15)
BLANK = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
BYTE[ord("A"):ord("Z") + 1] = BYTE[ord("a"):ord("z") + 1]

_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n, kept by each worker."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        inverse = U64(pow(int(BASE), -1, 1 << 64))
        for at, base in enumerate((BASE, inverse)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[at] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_prints(data: np.ndarray, segment: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and first byte of each word; ``data`` ends in a blank.

    A word's fingerprint is a difference of prefix sums of a polynomial over
    its bytes, shifted to the word's start. Long data go through in segments
    that end at blanks.
    """
    prints, places, at = [], [], 0
    while at < len(data):
        stop = min(at + segment, len(data))
        while not BLANK[data[stop - 1]]:
            stop += 1
        part = data[at:stop]
        blank = BLANK[part]
        before = np.concatenate([[True], blank[:-1]])
        starts, ends = np.flatnonzero(before & ~blank), np.flatnonzero(~before & blank)
        up, down = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum(BYTE[part] * up[:len(part)], out=sums[1:])
        prints.append(mix((sums[ends] - sums[starts]) * down[starts]))
        places.append(starts + at)
        at = stop
    return np.concatenate(prints), np.concatenate(places)


#: Odd multipliers for the places of a word in a shingle.
PLACE = 0xD6E8FEB86659FD93


def shingle_sets(values: list[bytes], n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle fingerprints of each text, in a row, and their numbers.

    A text with fewer than ``n`` words has its whole sequence as one shingle, a
    text without words none.
    """
    words, starts = word_prints(np.frombuffer(b"\n".join(values) + b"\n", np.uint8))
    sizes = np.fromiter(map(len, values), np.int64, len(values)) + 1
    doc = np.searchsorted(np.cumsum(sizes), starts, side="right")
    n_words = np.bincount(doc, minlength=len(values))
    first = np.cumsum(n_words) - n_words
    full = max(len(words) - n + 1, 0)
    shingles = np.zeros(full, U64)
    for k in range(n):
        shingles += words[k:k + full] * U64(pow(PLACE, k + 1, 1 << 64))
    inside = doc[:full] == doc[n - 1:n - 1 + full]
    owner, shingles = doc[:full][inside], shingles[inside]
    short = np.flatnonzero((n_words > 0) & (n_words < n))
    if len(short):
        own = n_words[short].astype(U64)
        for k in range(n - 1):
            has = n_words[short] > k
            own[has] += words[first[short[has]] + k] * U64(pow(PLACE, k + 1, 1 << 64))
        owner, shingles = np.concatenate([owner, short]), np.concatenate([shingles, own])
    shingles = mix(shingles)
    order = np.lexsort((shingles, owner))
    owner, shingles = owner[order], shingles[order]
    if len(owner):
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (shingles[1:] != shingles[:-1])])
        owner, shingles = owner[new], shingles[new]
    return shingles, np.bincount(owner, minlength=len(values)).astype(np.int64)


def set_prints(shingles: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints for each set: equal sets have equal ones, 0 without words."""
    if not len(shingles):
        return np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    ends, out = np.cumsum(sizes), []
    for other in (U64(0x5851F42D4C957F2D), U64(0x2545F4914F6CDD1D)):
        sums = np.concatenate([[U64(0)], np.cumsum(mix(shingles ^ other))])
        prints = mix((sums[ends] - sums[ends - sizes]) + sizes.astype(U64) * BASE)
        out.append(np.where(sizes > 0, prints, U64(0)).view(np.int64))
    return out[0], out[1]


def set_keys(shingles: np.ndarray, sizes: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """The key of each set's class: its first fingerprint, or both where different sets share the first (``shared``, sorted)."""
    keys, checks = set_prints(shingles, sizes)
    if len(shared):
        at = np.minimum(np.searchsorted(shared, keys), len(shared) - 1)
        keys = np.where(shared[at] == keys, keys ^ checks, keys)
    return keys


#: Bits of a parity sketch.
SKETCH = 2048


def parity_sketches(shingles: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A bit for each 11-bit prefix of fingerprints: whether the set holds an odd number of them.

    An element in one of two sets only changes one bit between their sketches,
    so the sets differ in at least as many elements as the sketches in bits.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = owner * SKETCH + (shingles >> U64(53)).astype(np.int64)
    bits = np.bincount(at, minlength=len(sizes) * SKETCH) & 1
    words = np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")
    offsets = np.arange(0, len(words) + 1, SKETCH // 64, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(words))


def _binary(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _array(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values))


# ---- passes over the texts ------------------------------------------------

def row_print() -> Column:
    """What a row is known by inside: rows without a doc_id have one too, and texts of one doc_id have their own."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def measured(docs: DataFrame, n: int) -> DataFrame:
    """A row per row of ``docs`` (kind 0: doc_id, print, key, check, size) and counts of recurring shingles.

    Each task reports the shingles that several of its own documents hold, with
    their number (kind 1: key, size). Summed over tasks these are lower bounds
    of document frequencies, near for frequent shingles; the counting is lossy
    for the others and keeps a task's memory bounded. They order shingles only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "doc_id", "print", "key", "check", "size"]
        kept, counts, pending, waiting = np.empty(0, U64), np.empty(0, np.int64), [], 0

        def folded() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([kept, *pending])
            weight = np.concatenate([counts, np.ones(waiting, np.int64)])
            order = np.argsort(every, kind="stable")
            every, weight = every[order], weight[order]
            heads = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, np.int64)
            total = np.add.reduceat(weight, heads) if len(every) else weight
            return every[heads][total > 1], total[total > 1]

        for batch in byte_slices(batches):
            shingles, sizes = shingle_sets(_binary(batch), n)
            pending.append(shingles)
            waiting += len(shingles)
            if waiting > 4_000_000:
                kept, counts = folded()
                pending, waiting = [], 0
            keys, checks = set_prints(shingles, sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(sizes), np.int32)), batch.column("doc_id"), batch.column("print"), _array(keys), _array(checks), _array(sizes)], names)
        kept, counts = folded()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(kept), np.int32)), *[pa.nulls(len(kept), pa.int64())] * 2, _array(kept.view(np.int64)), pa.nulls(len(kept), pa.int64()), _array(counts)], names)

    return docs.select(F.col("doc_id").cast("long"), row_print().alias("print"), "text").mapInArrow(
        run, "kind int, doc_id long, print long, key long, check long, size long")


def required_overlap(a: Column, b: Column, percent: int) -> Column:
    """The least overlap of linked sets of these sizes: ceil(p / (100 + p) * (a + b))."""
    return F.ceil((a + b) * percent / F.lit(100 + percent))


def prefixes(docs: DataFrame, n: int, percent: int, ranked: np.ndarray, shared: np.ndarray) -> DataFrame:
    """Prefix shingles (shingle, key, size, at) of each distinct set of a task.

    An entry's shingle has 49 bits of the fingerprint, which at worst names a few
    pairs more, and a last bit for frequent ones. ``ranked`` are the frequent shingles, most frequent last; all others come
    before them in the order of their fingerprints. A prefix has size minus
    ceil(percent/100 * size) plus one shingles.
    """
    by_value = np.sort(ranked)
    rank_of = np.argsort(ranked, kind="stable")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in byte_slices(batches):
            shingles, sizes = shingle_sets(_binary(batch), n)
            keys = set_keys(shingles, sizes, shared)
            fresh = np.zeros(len(sizes), bool)
            for i, k in enumerate(keys.tolist()):  # copies in one task give one entry
                if k and k not in seen:
                    seen.add(k)
                    fresh[i] = True
            owner = np.repeat(np.arange(len(sizes)), sizes)
            use = fresh[owner]
            owner, shingles = owner[use], shingles[use]
            frequent = np.zeros(len(shingles), np.int64)
            if len(by_value) and len(shingles):
                at = np.minimum(np.searchsorted(by_value, shingles), len(by_value) - 1)
                frequent = np.where(by_value[at] == shingles, rank_of[at] + 1, 0)
                order = np.lexsort((shingles, frequent, owner))
                owner, shingles, frequent = owner[order], shingles[order], frequent[order]
            sizes = np.where(fresh, sizes, 0)
            first = np.cumsum(sizes) - sizes
            place = np.arange(len(owner)) - first[owner]
            own = sizes[owner]
            take = place < own - -(-own * percent // 100) + 1
            yield pa.RecordBatch.from_arrays(
                [_array((shingles[take] >> U64(15)).view(np.int64) * 2 + (frequent[take] > 0)), _array(keys[owner[take]]), _array((own[take] << 32) | place[take])],
                ["shingle", "key", "size_at"])

    return docs.select("text").mapInArrow(run, "shingle long, key long, size_at long")


#: More sharers of a shingle than these meet by classes of sizes.
MANY = 64


def size_of(size_at: Column) -> Column:
    return F.shiftright(size_at, 32).cast("int")


def at_of(size_at: Column) -> Column:
    """The place of a shingle in its set's order."""
    return size_at.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def of_many(size_at: Column) -> Column:
    """Whether the shingle has more than ``MANY`` sharers, the bit between size and place."""
    return size_at.bitwiseAND(F.lit(1 << 31)) != 0


def sharers(entries: DataFrame, many: int = MANY) -> DataFrame:
    """(shingle, key, size_at, leader_key, leader_size_at) of the entries whose shingle several sets share.

    The leader has the shingle at the least place: fewest of its shingles are
    rarer, as for a text that others are copies of. Frequent shingles get their
    leader from a pre-aggregated table and a join that can be split; the others
    from a window, in one shuffle: no task holds them twice within 4,000,000
    shingles, so their groups are no larger than the number of such runs.
    """
    # two small numbers make smaller shuffles than one large one
    entries = entries.select("shingle", "key", size_of(F.col("size_at")).alias("size"), at_of(F.col("size_at")).alias("at"))
    frequent = F.col("shingle") % 2 == 1
    least = F.min(F.struct("at", "size", "key"))

    def split(df: DataFrame) -> DataFrame:
        def packed(size: str, at: str) -> Column:
            return F.shiftleft(F.col(size).cast("long"), 32).bitwiseOR(F.col(at).cast("long"))

        marked = packed("size", "at").bitwiseOR(F.when(F.col("n") > many, F.lit(1 << 31)).otherwise(F.lit(0).cast("long")))
        return df.select("shingle", "key", marked.alias("size_at"), F.col("first.key").alias("leader_key"), packed("first.size", "first.at").alias("leader_size_at"))

    own = Window.partitionBy("shingle")
    rare = entries.where(~frequent).withColumns({"first": least.over(own), "low": F.min("key").over(own), "high": F.max("key").over(own), "n": F.count(F.lit(1)).over(own)})
    rare = split(rare.where("low != high")).dropDuplicates(["shingle", "key"])
    # tables, so that the texts are read once for both and the join can be split
    often = materialize(entries.where(frequent).dropDuplicates(["shingle", "key"]))
    leaders = materialize(often.groupBy("shingle").agg(least.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    return rare.unionByName(split(often.join(leaders, "shingle")))


# ---- pairs ----------------------------------------------------------------

def may_link(size_a: Column, at_a: Column, size_b: Column, at_b: Column, percent: int) -> Column:
    """Length and positional filter for a shared shingle at these places."""
    short, long = F.least(size_a, size_b), F.greatest(size_a, size_b)
    within = F.least(size_a - at_a, size_b - at_b)
    return (short * 100 >= long * percent) & (within >= required_overlap(size_a, size_b, percent))


def size_limits(size: Column, at: Column, percent: int) -> tuple[Column, Column]:
    """The least and greatest size of a set that may link over a shared shingle at this place (see ``may_link``)."""
    return F.ceil(size * percent / F.lit(100)), F.least(F.floor(size * 100 / F.lit(percent)), F.floor((size - at) * (100 + percent) / F.lit(percent)) - size)


def size_class(size: Column) -> Column:
    """Classes of similar sizes: single ones up to 16, then steps of about 6 %."""
    return F.when(size <= 16, size).otherwise(F.floor(F.log2(size.cast("double")) * 12) - 32).cast("int")


def repair_pairs(rooted: DataFrame, percent: int) -> DataFrame:
    """(a, b, a_size, b_size): pairs of sharers in different components of which one is apart from its leader.

    Partners meet by shingle, and where it has many sharers by class of sizes
    too, in the classes that an entry's size and place allow; entries that allow
    none meet nobody.
    """
    size, at = size_of(F.col("size_at")), at_of(F.col("size_at"))
    low, high = size_limits(size, at, percent)
    entries = rooted.where("key != leader_key or root != leader_root").withColumns({"low": low, "high": high}).where("low <= high")
    entries = entries.withColumn("apart", F.col("root") != F.col("leader_root"))
    by_class = of_many(F.col("size_at"))
    a, b = (df.select("shingle", *extra, *(F.col(c).alias(f"{side}_{c}") for c in ("key", "size_at", "root"))) for side, df, extra in (
        ("a", entries.where("apart"), [F.explode(F.when(by_class, F.sequence(size_class(F.col("low")), size_class(F.col("high")))).otherwise(F.array(F.lit(0)))).alias("size_class")]),
        ("b", entries, [F.when(by_class, size_class(size)).otherwise(0).alias("size_class"), "apart"])))
    # a pair of two entries apart meets twice
    met = a.join(b, ["shingle", "size_class"]).where(~F.col("apart") | (F.col("a_key") < F.col("b_key")))
    (a_size, a_at), (b_size, b_at) = ((size_of(F.col(c)), at_of(F.col(c))) for c in ("a_size_at", "b_size_at"))
    met = met.where((F.col("a_root") != F.col("b_root")) & may_link(a_size, a_at, b_size, b_at, percent))
    turn = F.col("a_key") < F.col("b_key")
    return met.select(
        F.greatest("a_key", "b_key").alias("a"), F.least("a_key", "b_key").alias("b"),
        F.when(turn, b_size).otherwise(a_size).alias("a_size"), F.when(turn, a_size).otherwise(b_size).alias("b_size"))


def close_sketches(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Suffix filter: (a, b, n) of the pairs (a, b, a_size, b_size, n) whose sketches differ in no more bits than linked sets may."""
    both = pairs.join(sketches.select(F.col("key").alias("a"), F.col("sketch").alias("_sa")), "a").join(
        sketches.select(F.col("key").alias("b"), F.col("sketch").alias("_sb")), "b")
    apart = F.aggregate(F.zip_with("_sa", "_sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, m: n + m)
    size = F.col("a_size") + F.col("b_size")
    return both.where(apart <= size - 2 * required_overlap(F.col("a_size"), F.col("b_size"), percent)).select("a", "b", "n")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link: suffix filter, then the whole intersection."""
    need = -(-(len(a) + len(b)) * percent // (100 + percent))
    spare = len(a) + len(b) - 2 * need  # most elements that may be in one set only
    for cut in (a[len(a) // 4], a[len(a) // 2], a[3 * len(a) // 4]):
        i, j = np.searchsorted(a, cut), np.searchsorted(b, cut)
        if abs(i - j) + abs((len(a) - i) - (len(b) - j)) > spare:
            return False
    return len(np.intersect1d(a, b, assume_unique=True)) >= need


def verified(pairs: DataFrame, class_texts: DataFrame, n: int, percent: int, spread: int = 16) -> DataFrame:
    """The pairs (a, b) of classes that link, compared on their whole texts.

    The pairs of one ``b`` are compared together, its text once for up to
    ``spread`` partners: a text goes to the groups it takes part in, as ``b`` at
    the group's head or as ``a``; the groups of a ``b`` with many partners are
    several.
    """
    pairs = pairs.withColumn("part", F.pmod(F.xxhash64("a"), F.lit(1 << 20)))
    counts = materialize(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n_partners")))
    pairs = pairs.join(counts, "b").withColumn("part", F.col("part") % F.ceil(F.col("n_partners") / spread))
    members = pairs.select(F.col("a").alias("key"), "b", "part", F.lit(1).alias("role"))
    heads = pairs.select(F.col("b").alias("key"), "b", "part", F.lit(0).alias("role")).distinct()
    places = materialize(heads.unionByName(members))
    # few places go to the texts, so that only texts with a partner are moved, once
    placed = class_texts.select("key", "text").join(F.broadcast(places) if places.count() <= FEW_KEYS else places, "key")
    grouped = placed.repartition("b", "part").sortWithinPartitions("b", "part", "role", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, None
        for batch in byte_slices(batches):
            shingles, sizes = shingle_sets(_binary(batch), n)
            ends = np.cumsum(sizes)
            a, b = [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("key", "b", "part", "role")), (ends - sizes).tolist(), ends.tolist())
            for key, group, part, role, start, end in rows:
                if role == 0:
                    head, own = (group, part), shingles[start:end].copy()
                elif head == (group, part) and _linked(shingles[start:end], own, percent):
                    a.append(key)
                    b.append(group)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return grouped.select("key", "b", "part", "role", "text").mapInArrow(run, "a long, b long")


def components(links: DataFrame, hub: int = 1_000_000) -> DataFrame:
    """(key, component): the smallest key reachable over links (a, b).

    Alternates the large-star and small-star steps, which are each a minimum by
    key and a join, until nothing changes. Keys without links are not returned.
    Where a key has more than ``hub`` neighbours, the minima are written first:
    the joins are then of two tables, and Spark splits the hub's rows.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    def has_hub(df: DataFrame) -> bool:
        return df.groupBy("v").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] > hub

    before = state(edges)
    while before[0]:
        kept = materialize if before[0] > hub and has_hub(edges) else lambda df: df
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = kept(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = kept(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("key"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("key"), F.col("v").alias("component")).distinct())


def sharing_texts(docs: DataFrame, named: DataFrame, n: int, shared: np.ndarray) -> DataFrame:
    """(key, text, sketch) of the classes of ``named`` (print, key), a row each or more.

    A text that has the print of a class but another set is left out; rows that
    repeat one come once a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in byte_slices(batches):
            shingles, sizes = shingle_sets(_binary(batch), n)
            own = []
            for key, found in zip(batch.column("key").to_pylist(), set_keys(shingles, sizes, shared).tolist()):
                own.append(key == found and key not in seen)
                if own[-1]:
                    seen.add(key)
            columns = [batch.column("key"), batch.column("text"), parity_sketches(shingles, sizes)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(own, pa.bool_())) for c in columns], ["key", "text", "sketch"])

    texts = with_keys(docs.select(row_print().alias("print"), "text"), named, "print")
    return texts.select("key", "text").mapInArrow(run, "key long, text string, sketch array<long>")


def class_keys(rows: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, print, key, size) with a key for each distinct set, and the sorted fingerprints that different sets share.

    Of n sets about n * n / 2**65 pairs share a fingerprint, so these are few.
    """
    shared = rows.groupBy("key").agg(F.min("check").alias("p"), F.max("check").alias("q")).where("p != q").select("key")
    found = np.sort(shared.toArrow().column("key").to_numpy())
    if len(found):
        doubled = rows.sparkSession.createDataFrame([(int(k),) for k in found], "key long").withColumn("doubled", F.lit(True))
        rows = rows.join(F.broadcast(doubled), "key", "left").withColumn("key", F.when(F.col("doubled"), F.col("key").bitwiseXOR(F.col("check"))).otherwise(F.col("key")))
    return rows.select("doc_id", "print", "key", "size"), found


def frequent_shingles(counts: DataFrame, most: int) -> np.ndarray:
    """The most frequent shingles of (key, size), most frequent last, about ``most`` at most.

    The least frequency follows from a histogram, so that nothing is sorted or
    limited in one task.
    """
    often = materialize(counts.groupBy("key").agg(F.sum("size").alias("df")))
    step = F.floor(F.log2(F.col("df").cast("double")) * 16).cast("int").alias("step")
    chosen, held = F.lit(False), 0
    for r in sorted(often.groupBy(step).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):  # 16 rows for each power of two
        share = min(1.0, (most - held) / r["n"])
        # of the last step, a share by fingerprint
        chosen |= (step == r["step"]) & (F.pmod("key", F.lit(1 << 20)) < int(share * (1 << 20)))
        held += r["n"]
        if held >= most:
            break
    found = often.where(chosen).toArrow()  # about ``most`` at most
    keys, df = found.column("key").to_numpy(), found.column("df").to_numpy()
    return keys[np.lexsort((-keys, df))].view(U64)


def classes_and_components(docs: DataFrame, n: int = N, percent: int = PERCENT, most_frequent: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """(doc_id, print, key, size) of each row and (key, root) of each linked class.

    ``most_frequent`` bounds how many shingles are ordered by frequency, behind
    all others; it affects speed only, as any order gives the same links.
    """
    first = materialize(measured(docs, n))
    rows, prints = class_keys(first.where("kind = 0").select("doc_id", "print", "key", "check", "size"))
    ranked = frequent_shingles(first.where("kind = 1"), most_frequent)
    shared = materialize(sharers(prefixes(docs, n, percent, ranked, prints)))

    named = rows.where("size > 0").groupBy("key").agg(F.min("print").alias("print"))
    named = materialize(named.join(shared.select("key").distinct(), "key", "left_semi"))
    texts = materialize(sharing_texts(docs, named, n, prints), "zstd")
    sketches = texts.groupBy("key").agg(F.first("sketch").alias("sketch"))

    def close(pairs: DataFrame) -> DataFrame:
        counted = pairs.groupBy("a", "b", "a_size", "b_size").agg(F.count(F.lit(1)).alias("n"))
        return materialize(close_sketches(counted, sketches, percent))

    def with_roots(df: DataFrame, roots: DataFrame, *columns: str) -> DataFrame:
        """Add <column>_root, the component of the class or the class itself."""
        few = roots.count() <= FEW_KEYS
        for c in columns:
            own = roots.select(F.col("key").alias(c), F.col("component").alias(f"{c}_root"))
            df = df.join(F.broadcast(own) if few else own, c, "left").withColumn(f"{c}_root", F.coalesce(f"{c}_root", c))
        return df

    def joined(found: DataFrame, pairs: DataFrame) -> DataFrame:
        """Components after further pairs are compared."""
        if pairs.isEmpty():
            return found
        known = found.select(F.col("key").alias("a"), F.col("component").alias("b"))
        return materialize(components(known.unionByName(verified(pairs, texts, n, percent))))

    (size, at), (leader_size, leader_at) = ((size_of(F.col(c)), at_of(F.col(c))) for c in ("size_at", "leader_size_at"))
    led = shared.where("key != leader_key").where(may_link(size, at, leader_size, leader_at, percent))
    led = close(led.select(F.col("key").alias("a"), F.col("leader_key").alias("b"), size.alias("a_size"), leader_size.alias("b_size")))
    # the leader of most of a class's shingles first, the others where that left them apart
    best = materialize(led.groupBy("a").agg(F.max_by("b", F.struct("n", "b")).alias("b")))
    found = materialize(components(verified(best, texts, n, percent)))
    found = joined(found, materialize(with_roots(led.select("a", "b"), found, "a", "b").where("a_root != b_root").select("a", "b")))

    # who shares a shingle but is not in its leader's component
    rooted = with_roots(shared.drop("leader_size_at"), found, "key", "leader_key")
    rooted = materialize(rooted.withColumnsRenamed({"key_root": "root", "leader_key_root": "leader_root"}))
    found = joined(found, close(repair_pairs(rooted, percent)).select("a", "b"))
    return rows, found.select("key", F.col("component").alias("root"))


def rows_and_classes(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, print, key, size) of each row and (key, least, root) of each class of equal sets."""
    rows, roots = classes_and_components(docs, n, percent)
    classes = rows.where("size > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    return rows, materialize(classes.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")))


def near_duplicates(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    Letters A-Z are lower-cased; words are runs of characters other than blanks.
    A null or blank text has no shingles and links with nothing, so its
    component is its own doc_id; a very long text is taken whole. Repeated rows
    are returned as often as they come, and texts of one doc_id link each for
    itself; rows with a null doc_id link like all others but never name a
    component, which is null if it has no other rows. Ties in frequency fall
    back on fingerprints and change no link; other columns are ignored, whatever
    their names. An empty table gives no rows.
    """
    rows, classes = rows_and_classes(docs, n, percent)
    least = materialize(classes.groupBy("root").agg(F.min("least").alias("component_id")))
    named = materialize(classes.select("key", "root").join(least, "root").select("key", "component_id"))
    linked = rows.where("size > 0").join(named, "key").select("doc_id", F.col("size").alias("n_shingles"), "component_id")
    return linked.unionByName(rows.where("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, n: int = N, percent: int = PERCENT, few: int = FEW_KEYS) -> DataFrame:
    """One row of each component, that with the smallest doc_id, ties by a fingerprint; columns unchanged.

    Rows without words are components of their own and all stay. Texts of one
    doc_id are judged each for itself, and rows without a doc_id stay where
    their component has no others. ``few`` is that of ``without_keys``.
    """
    rows, classes = rows_and_classes(docs, n, percent)
    found = rows.where("size > 0").groupBy("key", "print").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))
    found = materialize(found.join(classes.select("key", "root"), "key"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "print", "n"))
    stay = materialize(found.groupBy("root").agg(first.alias("first")).select("first.print", "first.n"))
    copies = found.select("print").join(stay, "print", "left_anti")
    again = stay.where("n > 1").select("print")
    every = docs.select(row_print().alias("print"), as_row(docs).alias("row"))
    single = without_keys(every, materialize(copies.unionByName(again)), "print", few)
    once = with_keys(every, again, "print", few).groupBy("print").agg(F.min("row").alias("row"))
    return single.unionByName(once).select(*of_row("row", docs.columns))
