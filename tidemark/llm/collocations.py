"""Phrase collocations by Rabin-Karp fingerprints of word n-grams.

Texts are split into pieces, pieces into words. Prefix polynomials over the words'
fingerprints give the fingerprint of every n-gram of a slice of texts at once;
tasks count them and keep a pointer to one occurrence, and a shuffle of these
sums finds the frequent ones. A phrase is frequent only if its parts are, so an
n-gram is counted only if the frequent shorter ones within it, counted before,
are in a bitmap of bounded size (``PrintFilter``; it never leaves one out).

No fingerprint is trusted: a second, independent one goes along, and where both
don't agree for all occurrences, the texts decide, read again for the fingerprints
in question. Only frequent phrases are ever spelled out, from their pointers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm._common import byte_slices, materialize, with_keys
from tidemark.llm.word_stream import U64, PrintFilter, Rolling, mixed, print_filter, words_of

WORDS = 5
MIN_COUNT = 100
TOP = 2000
NO_LANG = "und"

#: Bytes between pieces and between words.
PIECE_END = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
BLANK = PIECE_END | np.isin(np.arange(256), [0x20, 9])
#: What joins the words of a phrase in the text.
JOINT = r"[\x20\x09]+"
SECOND = 20240607
ROLLING = [Rolling(20240606), Rolling(SECOND)]
SLICE = 1 << 20
MASK = (1 << 64) - 1

COUNTED = "words tinyint, print long, n long, low long, high long, row long, place long, size long, lang string"


class Grams:
    """The n-grams of some texts, none over the end of a piece."""

    def __init__(self, values: list[bytes], langs: np.ndarray, print_bits: int):
        self.found = words_of(values, BLANK, ROLLING)
        ends = np.concatenate([[0], np.cumsum(PIECE_END[self.found.data])])
        # the line feed behind each text ends its last piece
        self.piece = ends[self.found.starts]
        self.sums = [r.sums(p) for r, p in zip(ROLLING, self.found.prints)]
        self.lang = langs[self.found.text]
        self.keep = U64(MASK) if print_bits == 64 else U64(((1 << print_bits) - 1) << (64 - print_bits))

    def starts(self, k: int) -> np.ndarray:
        """Whether each place begins k words of one piece."""
        n = max(len(self.piece) - k + 1, 0)
        return self.piece[:n] == self.piece[k - 1:k - 1 + n]

    def prints(self, k: int, at: np.ndarray, which: int = 0) -> np.ndarray:
        """Fingerprints of the k words from each place, different ones in each language."""
        out = mixed(ROLLING[which].windows(self.sums[which], at, at + k) + U64(k * 0xD1B54A32D192ED03 & MASK) + self.lang[at])
        return out if which else out & self.keep


def _prepared(docs: DataFrame) -> DataFrame:
    """(row, lang, lang_print, text) of the documents with a text; ``row`` stands for doc_id and text."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG))
    return docs.where("text is not null").select(
        F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row"), lang.alias("lang"), F.xxhash64(lang, F.lit(SECOND)).alias("lang_print"), "text")


def _chosen(grams: Grams, k: int, base: int, known: PrintFilter | None) -> np.ndarray:
    """Places of k-grams all of whose ``base``-grams may be frequent."""
    use = grams.starts(k)
    if known is not None:
        places = np.flatnonzero(grams.starts(base))
        ok = np.zeros(len(grams.piece), bool)
        ok[places] = known.holds(grams.prints(base, places))
        for j in range(k - base + 1):
            use &= ok[j:j + len(use)]
    return np.flatnonzero(use)


def _grams_of(batch: pa.RecordBatch, print_bits: int) -> Grams:
    values = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
    return Grams(values, batch.column("lang_print").to_numpy(zero_copy_only=False).view(U64), print_bits)


def counted(docs: DataFrame, light: list[int], full: list[int], base: int, known: PrintFilter | None, totals: bool, print_bits: int) -> DataFrame:
    """Sums by (words, print) over all texts, of n-grams of these sizes.

    For the sizes ``full``, ``low`` and ``high`` are the least and greatest second
    fingerprint and (row, place, size) points to one occurrence's bytes; the others
    are only counted, as most of them won't be frequent. With ``totals`` there is a
    row without a print for each language, with the number of its words.
    """
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, limit=SLICE):
            grams = _grams_of(batch, print_bits)
            rows = batch.column("row").to_numpy(zero_copy_only=False)
            for k in light + full:
                at = _chosen(grams, k, base, sent.value)
                if not len(at):
                    continue
                prints = grams.prints(k, at)
                if k in light:
                    some, n = np.unique(prints, return_counts=True)
                    values = [pa.array(x) for x in (np.full(len(some), k, np.int8), some.view(np.int64), n.astype(np.int64))] + [pa.nulls(len(some), pa.int64())] * 5
                else:
                    order = np.argsort(prints, kind="stable")
                    at, prints = at[order], prints[order]
                    heads = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
                    checks = grams.prints(k, at, 1).view(np.int64)
                    first = at[heads]
                    text = grams.found.text[first]
                    start = grams.found.starts[first]
                    values = [*map(pa.array, (
                        np.full(len(heads), k, np.int8), prints[heads].view(np.int64), np.diff(np.append(heads, len(at))), np.minimum.reduceat(checks, heads), np.maximum.reduceat(checks, heads),
                        rows[text], start - grams.found.text_starts[text], grams.found.ends[first + k - 1] - start))]
                yield pa.RecordBatch.from_arrays([*values, pa.nulls(len(values[0]), pa.string())], NAMES)
            if totals:
                by_text = np.bincount(grams.found.text, minlength=batch.num_rows)
                sums = pa.table({"lang": batch.column("lang"), "n": by_text}).group_by("lang").aggregate([("n", "sum")])
                empty = pa.nulls(sums.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(sums.num_rows, pa.int8()), empty, pc.cast(sums["n_sum"], pa.int64()).combine_chunks(), *[empty] * 5, sums["lang"].combine_chunks().cast(pa.string())], NAMES)

    parts = docs.mapInArrow(run, COUNTED)
    return parts.groupBy("lang", "words", "print").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("row").alias("row"), F.min_by("place", "row").alias("place"), F.min_by("size", "row").alias("size"))


NAMES = [c.split()[0] for c in COUNTED.split(", ")]


def spelled(text: Column) -> Column:
    """A stretch of text as a phrase: capitals A-Z small, a space between its words."""
    return F.regexp_replace(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), JOINT, " ")


def pointed(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(lang, words, phrase, n) of the fingerprints that stand for one phrase, read from the bytes they point to."""
    holders = with_keys(docs.select("row", "lang", "text"), materialize(found.select("row").distinct()), "row")
    holders = holders.groupBy("row").agg(F.first("lang").alias("lang"), F.first("text").alias("text"))
    stretch = F.col("text").cast("binary").substr(F.col("place").cast("int") + 1, F.col("size").cast("int")).cast("string")
    return found.drop("lang").join(holders, "row").select("lang", "words", spelled(stretch).alias("phrase"), "n")


def read_again(docs: DataFrame, doubtful: DataFrame, sizes: list[int], base: int, known: PrintFilter | None, print_bits: int) -> DataFrame:
    """(lang, words, phrase, n) of the phrases behind fingerprints that several phrases share, counted by their text."""
    suspects = docs.sparkSession.sparkContext.broadcast(print_filter(doubtful, "print"))
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, limit=SLICE):
            grams = _grams_of(batch, print_bits)
            langs = batch.column("lang")
            for k in sizes:
                at = _chosen(grams, k, base, sent.value)
                prints = grams.prints(k, at)
                use = suspects.value.holds(prints)
                at, prints = at[use], prints[use]
                bounds = zip(grams.found.starts[at].tolist(), grams.found.ends[at + k - 1].tolist())
                texts = pa.array([grams.found.data[a:b].tobytes() for a, b in bounds], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), k, np.int8)), pa.array(prints.view(np.int64)), langs.take(pa.array(grams.found.text[at])), texts], ["words", "print", "lang", "text"])

    found = docs.mapInArrow(run, "words tinyint, print long, lang string, text string")
    by_text = found.groupBy("lang", "words", "print", spelled(F.col("text")).alias("phrase")).agg(F.count(F.lit(1)).alias("n"))
    return by_text.join(doubtful.select("words", "print"), ["words", "print"], "left_semi").select("lang", "words", "phrase", "n")


def frequent_phrases(docs: DataFrame, max_words: int = WORDS, min_count: int = MIN_COUNT, print_bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, n) of all phrases of up to ``max_words`` words with n >= min_count, and (lang, n) of all words.

    ``print_bits`` is for tests, where fingerprints of few bits make phrases collide.
    """
    docs = _prepared(docs)
    phrases, totals, known, base, k = [], None, None, 0, 1
    while k <= max_words:
        # four words and more are told well enough by their frequent threes to be counted at once
        sizes = [k] if k < 4 else list(range(k, max_words + 1))
        last = sizes[-1] == max_words
        # what was frequent in the pass before is pointed to in this one
        full = ([base] if base else []) + (sizes if last else [])
        sums = counted(docs, [] if last else sizes, full, base, known, k == 1, print_bits)
        sums = materialize(sums.where(F.col("print").isNull() | (F.col("n") >= min_count)))
        if k == 1:
            totals = sums.where("print is null").select("lang", "n")
        if full:
            found = sums.where(F.col("words").isin(full))
            phrases.append(pointed(docs, found.where("low = high")))
            doubtful = found.where("low != high")
            if not doubtful.isEmpty():
                phrases.append(read_again(docs, doubtful, full, base, known, print_bits).where(F.col("n") >= min_count))
        if not last:
            known, base = print_filter(sums.where(F.col("words") == k), "print"), k
        k = sizes[-1] + 1
    return materialize(reduce(DataFrame.unionByName, phrases)), totals


def _part(words: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, max_words: int = WORDS, min_count: int = MIN_COUNT, top: int = TOP, percent: int = 100, print_bits: int = 64) -> DataFrame:
    """The ``top`` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    A candidate has 2 to ``max_words`` words and a >= min_count occurrences among
    the language's n words. Of its cuts into two parts with l and r occurrences
    the one with the lowest floor(1000 * a * n / (l * r)) counts, of equal ones
    the first; decimals of 38 digits keep this exact. A candidate within a longer
    one that has at least ``percent`` % of its occurrences is dropped. Ties in
    score go to the greater a, then to the phrase in byte order.

    Null and empty texts have no words, a null lang is ``und``; very long texts
    and words are taken whole; repeated rows and doc_ids and null doc_ids count
    as documents of their own. Without documents or frequent phrases there are no
    rows; columns beside doc_id, lang and text play no part.
    """
    phrases, totals = frequent_phrases(docs, max_words, min_count, print_bits)
    candidates = phrases.where("words > 1").withColumn("w", F.split("phrase", " "))
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("of"))

    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: _part(F.col("w"), i, m)))))
    covered = candidates.where("words > 2").select("lang", inner.alias("phrase"), F.col("n").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(covered, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("n")))

    cut = kept.select("lang", "phrase", "w", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", _part(F.col("w"), F.lit(1), F.col("k")).alias("left"), _part(F.col("w"), F.col("k") + 1, F.size("w")).alias("right"))
    cut = cut.join(parts.toDF("lang", "left", "l"), ["lang", "left"]).join(parts.toDF("lang", "right", "r"), ["lang", "right"]).join(totals, "lang")
    big = {c: F.col(c).cast("decimal(38,0)") for c in "alnr"}
    cut = cut.withColumns({"above": F.lit(1000) * big["a"] * big["n"], "below": big["l"] * big["r"]}).withColumn("score", F.expr("above div below"))
    best = cut.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x")).select("lang", "phrase", "x.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
