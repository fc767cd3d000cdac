"""Token files: ids in canonical length-limited Huffman codes.

A file set is a folder with two Parquet tables. ``codebook`` holds the code
length of each id (the canonical code follows from the lengths), ``shards`` one
row per document in ascending doc_id order: its place in the id stream, its
number of ids, its bits, and the bit offset of every ``BLOCK``-th id. Blocks
between these checkpoints decode on their own, so a reader decodes thousands of
them side by side with table look-ups on arrays.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._common import byte_slices, materialize, scratch_dir, shuffle_partitions
from tidemark.llm.tokens import WordEncoder, default_tokenizer

BLOCK = 256
#: Bytes of texts or ids that are worked on at once.
SLICE = 4 << 20
#: Code words of at most so many bits; more where the ids need them.
MAX_BITS = 16
#: A decoder peeks at 32 bits from a byte's start.
MOST_BITS = 25


# ---- the code -------------------------------------------------------------

def bits_for(symbols: int, max_bits: int = MAX_BITS) -> int:
    """The limit on code words: ``max_bits``, or two more than the ids of a fixed width have."""
    needed = max(symbols - 1, 0).bit_length()
    if max(max_bits, needed) > MOST_BITS:
        raise ValueError(f"{symbols} symbols in {max_bits} bits: code words of more than {MOST_BITS} bits are not supported")
    return max_bits if needed <= max_bits else min(needed + 2, MOST_BITS)


def limited_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive counts.

    Package-merge: of each level's packages and symbols, sorted by weight, the
    cheapest are chosen; a symbol's length is the number of levels choosing it.
    """
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols do not fit in {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    weights, is_leaf = leaves, np.ones(n, bool)
    levels = [is_leaf]
    for _ in range(max_bits - 1):
        even = len(weights) // 2 * 2
        packages = weights[:even:2] + weights[1:even:2]
        merged = np.concatenate([leaves, packages])
        at = np.argsort(merged, kind="stable")
        weights, is_leaf = merged[at], at < n
        levels.append(is_leaf)
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:take].sum())
        lengths[order[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


class Codebook:
    """Canonical code: ids by (length, id) take consecutive code words."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, max_bits: int = MAX_BITS):
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        size = int(ids.max()) + 1 if len(ids) else 1
        self.max_bits = max_bits
        self.length = np.zeros(size, np.uint64)
        self.code = np.zeros(size, np.uint64)
        self.symbol_at = np.zeros(1 << max_bits, np.uint32)
        self.length_at = np.ones(1 << max_bits, np.uint8)
        spans = np.left_shift(1, max_bits - lengths)
        starts = np.cumsum(spans) - spans  # left-aligned code words
        self.length[ids] = lengths
        self.code[ids] = starts >> (max_bits - lengths)
        used = int(spans.sum())
        self.symbol_at[:used] = np.repeat(ids, spans)
        self.length_at[:used] = np.repeat(lengths, spans)

    def encode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[list[bytes], list[bytes]]:
        """Bits and checkpoints of documents of ``sizes`` ids, from their ids in a row."""
        lens, codes = self.length[ids], self.code[ids]
        ends = np.cumsum(lens)
        before = ends - lens
        last = np.cumsum(sizes)
        first = last - sizes
        bits = np.where(sizes > 0, ends[np.maximum(last - 1, 0)] - before[np.minimum(first, len(ids) - 1)], 0).astype(np.uint64)
        n_bytes = (bits + 7) // 8
        base = (np.cumsum(n_bytes) - n_bytes) * 8
        own = before - np.repeat(before[np.minimum(first, len(ids) - 1)], sizes)
        at = own + np.repeat(base, sizes)
        word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        words = np.zeros(int(n_bytes.sum()) // 8 + 2, np.uint64)
        end = off + lens
        over = end > 64
        high = np.where(over, codes >> (np.maximum(end, 64) - 64), codes << (64 - np.minimum(end, 64)))
        heads = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[heads]] = np.bitwise_or.reduceat(high, heads)
        spill = np.flatnonzero(over)
        words[word[spill] + 1] |= codes[spill] << (128 - end[spill])
        data = words.byteswap().tobytes()
        payloads, checkpoints = [], []
        for f, n, b, s in zip(first.tolist(), sizes.tolist(), n_bytes.tolist(), (base // 8).tolist()):
            payloads.append(data[s:s + b])
            checkpoints.append(own[f:f + n:BLOCK].astype("<u8").tobytes())
        return payloads, checkpoints

    def decode(self, payloads: list[bytes], checkpoints: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """All ids of documents, in a row: every block takes a step at a time."""
        data = np.frombuffer(b"".join(payloads) + bytes(4), np.uint8).astype(np.uint32)
        peeks = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        n_bytes = np.array([len(p) for p in payloads], np.int64)
        base = (np.cumsum(n_bytes) - n_bytes) * 8
        blocks = (sizes + BLOCK - 1) // BLOCK
        at = np.frombuffer(b"".join(checkpoints), "<u8").astype(np.int64) + np.repeat(base, blocks)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        left = np.minimum(BLOCK, np.repeat(sizes, blocks) - nth * BLOCK)
        to = np.repeat(np.cumsum(sizes) - sizes, blocks) + nth * BLOCK
        order = np.argsort(-left, kind="stable")
        at, to, left = at[order], to[order], left[order]
        live = np.searchsorted(-left, -np.arange(BLOCK + 1), side="left")
        out = np.empty(int(sizes.sum()), np.uint32)
        mask, shift = (1 << self.max_bits) - 1, 32 - self.max_bits
        for step in range(int(left[0]) if len(left) else 0):
            n = live[step]
            now = at[:n]
            seen = (peeks[now >> 3] >> (shift - (now & 7)).astype(np.uint32)) & mask
            out[to[:n] + step] = self.symbol_at[seen]
            at[:n] = now + self.length_at[seen]
        return out


# ---- Spark side -----------------------------------------------------------

def binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Slices of ``sizes`` elements, one after the other, as binary values."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * data.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def encode_ids(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids as little-endian unsigned 16- or 32-bit binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.shared(tokenizer)
        narrow = max(encoder.tokenizer.get_vocab_size(True), end_id + 1) <= 1 << 16
        for batch in byte_slices(batches, limit=SLICE):
            ids, sizes = encoder.encode_column(batch.column("text"))
            ids = np.insert(ids, np.cumsum(sizes), end_id).astype("<u2" if narrow else "<u4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes + 1), pa.array([narrow] * len(sizes)), binaries(ids, sizes + 1)],
                ["doc_id", "n_tokens", "narrow", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, narrow boolean, ids binary")


def _joined_ids(batch: pa.RecordBatch) -> np.ndarray:
    kind = "<u2" if batch.num_rows and batch.column("narrow")[0].as_py() else "<u4"
    return np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind)


def id_counts(encoded: DataFrame) -> DataFrame:
    """(id, count) over all documents: counted by task, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in byte_slices(batches, "ids", SLICE):
            got = np.bincount(_joined_ids(batch), minlength=len(total))
            got[:len(total)] += total
            total = got
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "n"])

    return encoded.select("narrow", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


class Shards:
    """Ranges of (doc_id, fingerprint) in ascending order, null ids first, of about equal numbers of ids.

    ``cuts`` are the last doc_ids of ranges; the rows of a heavy doc_id, the null
    one included, are a range of their own, split by fingerprint.
    """

    def __init__(self, cuts: list[int], parts: dict[int | None, int]):
        alone = {h for h in parts if h is not None}
        self.cuts = np.array(sorted({*cuts, *(h - 1 for h in alone), *alone}), np.int64)
        self.parts = np.ones(len(self.cuts) + 2, np.int64)
        self.parts[0] = parts.get(None, 1)
        for h in alone:
            self.parts[1 + int(np.searchsorted(self.cuts, h))] = parts[h]
        self.first = np.cumsum(self.parts) - self.parts

    def bucket(self, batch: pa.RecordBatch) -> np.ndarray:
        ids = batch.column("doc_id")
        at = np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, 1 + np.searchsorted(self.cuts, ids.fill_null(0).to_numpy(zero_copy_only=False)))
        spread = batch.column("print").to_numpy(zero_copy_only=False).astype(np.int64) >> 32  # -2**31 to 2**31
        return self.first[at] + (spread + (1 << 31)) * self.parts[at] // (1 << 32)


def plan_shards(encoded: DataFrame, shards: int) -> tuple[Shards, dict[int, tuple[int, int]]]:
    """The buckets of rows, and the shard and the first place in the id stream of each bucket's shard."""
    total = encoded.agg(F.sum("n_tokens")).first()[0] or 0
    share = max(1, total // (2 * shards))
    # fewer than two for each shard
    heavy = encoded.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("rows")).where((F.col("n") > share) & (F.col("rows") > 1)).collect()
    steps = 4 * shards
    cuts = encoded.approxQuantile("doc_id", [i / steps for i in range(1, steps)], 0.25 / steps)
    ranges = Shards([int(c) for c in cuts], {r["doc_id"]: 1 + 2 * r["n"] // share for r in heavy})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(ranges.bucket(batch)), batch.column("n_tokens")], ["bucket", "n"])

    counted = encoded.select("doc_id", "n_tokens", "print").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    placed, at, start, shard = {}, 0, 0, 0
    for r in sorted(counted.collect()):  # about ten for each shard
        mine = min(at * shards // max(total, 1), shards - 1)
        if mine != shard:
            shard, start = mine, at
        placed[r["bucket"]] = (shard, start)
        at += r["n"]
    return ranges, placed


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, max_bits: int = MAX_BITS) -> None:
    """Encode whole texts and write a file set in ascending doc_id order.

    Null and empty texts are the end id alone; very long ones are one row, in
    blocks. Null doc_ids come first; repeated rows and doc_ids stay as rows of
    their own, in the order of their fingerprints. Shards hold about equal
    numbers of ids; the rows of one doc_id go to several where they are many. An
    empty table gives an empty file set. Other columns are ignored, whatever
    their names.
    """
    spark = docs.sparkSession
    encoded = encode_ids(docs, tokenizer or default_tokenizer(), end_id).withColumn("print", F.xxhash64("ids"))
    encoded = materialize(encoded, "zstd")
    # one row for each id of the vocabulary at most
    counts = np.array([tuple(r) for r in id_counts(encoded).collect()], np.int64).reshape(-1, 2)
    max_bits = bits_for(len(counts), max_bits)
    lengths = limited_lengths(counts[:, 1], max_bits)
    book = Codebook(counts[:, 0], lengths, max_bits)
    spark.createDataFrame(
        list(zip(counts[:, 0].tolist(), lengths.tolist())), "id long, length long").withColumn("max_bits", F.lit(max_bits)).coalesce(1).write.parquet(f"{path}/codebook")

    shards = shuffle_partitions(spark)
    ranges, placed = plan_shards(encoded, shards)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "ids", SLICE):
            sizes = batch.column("n_tokens").to_numpy(zero_copy_only=False)
            payloads, checkpoints = book.encode(_joined_ids(batch), sizes)
            shard, first = zip(*(placed[b] for b in ranges.bucket(batch).tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(first, pa.int64()), *(batch.column(c) for c in ("doc_id", "print", "n_tokens")), pa.array(payloads, pa.binary()), pa.array(checkpoints, pa.binary())],
                ["shard", "first", "doc_id", "print", "n_tokens", "bits", "checkpoints"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if at is None:
                at = batch.column("first")[0].as_py()
            sizes = batch.column("n_tokens").to_numpy(zero_copy_only=False)
            ends = at + np.cumsum(sizes)
            at = int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ends - sizes), *(batch.column(c) for c in ("n_tokens", "bits", "checkpoints"))],
                ["doc_id", "start", "n_tokens", "bits", "checkpoints"])

    bits = encoded.mapInArrow(compress, "shard int, first long, doc_id long, print long, n_tokens long, bits binary, checkpoints binary")
    # a shard is a partition and a file: the files' names follow the doc_ids
    placed_rows = bits.repartitionById(shards, F.col("shard")).sortWithinPartitions("doc_id", "print", "n_tokens").mapInArrow(
        place, "doc_id long, start long, n_tokens long, bits binary, checkpoints binary")
    placed_rows.write.option("compression", "uncompressed").parquet(f"{path}/shards")


def read_codebook(spark: SparkSession, path: str) -> Codebook:
    rows = spark.read.parquet(f"{path}/codebook").collect()  # at most the vocabulary
    pairs = np.array([(r["id"], r["length"]) for r in rows], np.int64).reshape(-1, 2)
    return Codebook(pairs[:, 0], pairs[:, 1], rows[0]["max_bits"] if rows else MAX_BITS)


def read_token_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids array<int>) of a file set.

    With ``digest`` the ids are not returned but their ids_crc32, the CRC-32 of
    the ids as little-endian unsigned 32-bit integers.
    """
    book = read_codebook(spark, path)
    last = ("ids_crc32", "long") if digest else ("ids", "array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "bits", SLICE // 2):
            sizes = batch.column("n_tokens").to_numpy(zero_copy_only=False)
            ids = book.decode(batch.column("bits").to_pylist(), batch.column("checkpoints").to_pylist(), sizes)
            ends = np.cumsum(sizes)
            if digest:
                data = memoryview(ids.astype("<u4").tobytes())
                found = pa.array([zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())], pa.int64())
            else:
                found = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), found], ["doc_id", "start", "n_tokens", last[0]])

    return spark.read.parquet(f"{path}/shards").mapInArrow(run, f"doc_id long, start long, n_tokens long, {last[0]} {last[1]}")


def token_file_digests(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write a file set in the shared folder, read it back, and digest each document."""
    path = scratch_dir(docs.sparkSession)
    write_token_files(docs, path, tokenizer, end_id)
    return read_token_files(docs.sparkSession, path, digest=True)
