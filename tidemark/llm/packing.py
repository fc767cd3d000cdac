"""Best-fit packing of documents into sequences, planned on the length histogram.

Best-fit decreasing needs only how many pieces there are of each length: the
plan is made over counts (at most one count per possible length, so its input
and output are small whatever the corpus size), and every piece then takes its
planned slot by a join on its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._common import byte_slices, materialize, shuffle_partitions
from tidemark.llm.tokens import WordEncoder, default_tokenizer

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLAN = "length long, first_rank long, n_ranks long, per_sequence long, first_sequence long, first_offset long"


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Tokenise whole documents and cut the ones longer than ``capacity``.

    Null and empty texts yield the end id alone; a very long text is encoded whole
    and cut then. Extra columns of ``docs`` are ignored, whatever their names;
    repeated rows yield their pieces again; an empty table has no pieces.
    """
    path = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.shared(path)
        for batch in byte_slices(batches, limit=4 << 20):
            ids, sizes = encoder.encode_column(batch.column("text"))
            data = memoryview(np.insert(ids, np.cumsum(sizes), end_id).astype("<u4").tobytes())
            sizes = sizes + 1
            parts = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), parts)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * capacity
            length = np.minimum(sizes[owner] - start, capacity)
            at = (np.cumsum(sizes) - sizes)[owner] + start
            crcs = [zlib.crc32(data[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def plan_best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Returns runs (length, first_rank, n_ranks, per_sequence, first_sequence,
    first_offset): pieces of that length with ranks from ``first_rank`` fill
    consecutive sequences, ``per_sequence`` to each, from ``first_offset`` on.
    Open sequences are held as groups of equal free space with consecutive
    numbers. A length splits at most the last group it visits and opens two
    more, and a visit leaves less than half a group's space, so there are at
    most 4 groups a length and log2(capacity) + 1 runs a group.
    """
    groups: dict[int, list[tuple[int, int]]] = {}
    free: list[int] = []
    plan, opened = [], 0

    def put(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in groups:
                groups[space] = []
                insort(free, space)
            groups[space].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is outside 1..{capacity}")
        while left:
            at = bisect_left(free, length)
            if at < len(free):
                space = free[at]
                first, n = groups[space].pop()
                if not groups[space]:
                    del groups[space], free[at]
            else:
                space, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = space // length
            full = min(n, left // each)
            if full:
                plan.append((length, rank, full * each, each, first, capacity - space))
                put(space - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < n:
                some = min(left, each)
                if some:
                    plan.append((length, rank, some, some, first + full, capacity - space))
                    rank, left = rank + some, left - some
                    put(space - some * length, first + full, 1)
                    full += 1
                put(space, first + full, n - full)
    return plan


def rank_within(df: DataFrame, key: str, order: list[str], salts: int) -> DataFrame:
    """Add ``rank``: the row's number among those of equal ``key``, from 0.

    The rows of one key are dealt over ``salts`` buckets, numbered within each
    bucket, and shifted by the sizes of the buckets before it, so that a key
    with a third of all rows is not sorted by one task.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    sizes = salted.groupBy(key, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(key, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    local = F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order)) - 1
    return (salted.withColumn("_local", local).join(shift, [key, "_salt"])
            .withColumn("rank", F.col("_local") + F.col("_shift")).drop("_salt", "_local", "_shift"))


def pack(parts: DataFrame, capacity: int = 2048) -> DataFrame:
    """Place pieces (doc_id, piece, start, length, ids_crc32) in sequences.

    Adds sequence_id and offset; offsets of a sequence are gapless from 0. Ties
    (repeated rows) take different slots; an empty table packs to no rows.
    """
    spark = parts.sparkSession
    parts = materialize(parts)
    # at most ``capacity`` rows: one for each length
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(plan_best_fit(histogram, capacity), PLAN)
    ranked = rank_within(parts, "length", ["doc_id", "piece", "ids_crc32"], shuffle_partitions(spark))
    nth = F.col("rank") - F.col("first_rank")
    slot = (ranked["length"] == plan["length"]) & (nth >= 0) & (nth < F.col("n_ranks"))
    return ranked.join(F.broadcast(plan), slot).select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32",
        (F.col("first_sequence") + F.floor(nth / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + nth % F.col("per_sequence") * ranked["length"]).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    return pack(pieces(docs, tokenizer, capacity, end_id), capacity)
