"""Byte-pair encoding and decoding with a contiguous rank array per word.

A word's state is three short parallel lists: the parts left between its
boundaries, and for each boundary the rank of the merge across it. The least
rank is looked up by scanning, its boundary deleted, and the ranks of the two
neighbouring boundaries refreshed. Words of more than ``SHORT`` parts keep the
same boundaries in a linked list with a heap, so that one very long word does
not cost the square of its length.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import byte_slices, texts
from tidemark.llm.tokens import byte_letters, default_tokenizer, has_plain_pretokens

SHORT = 256
NO_MERGE = 1 << 60

#: Letters besides ASCII that no normalizer step but lower-casing touches (U+0130 becomes two characters).
LATIN = "À-ÖØ-öø-įı-ſ"
SIMPLE = re.compile(f"[\\x00-\\x7f{LATIN}]*")
#: The pre-tokens of a lower-cased simple text.
PIECES = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[a-z{LATIN}]+|[0-9]|[^\\t-\\r a-z0-9{LATIN}]+")

_codecs: dict[str, "RankArrayBpe"] = {}


class RankArrayBpe:
    """Encoder and decoder for a word-level BPE vocabulary file.

    Reads the vocabulary, the merges, the word-end suffix and the added tokens
    from the file. Plain and Latin texts are split here, all others by the
    normalizer and pre-tokenizer that the library reads from the file, whose
    Unicode tables they need; the merges are always the rank array's.
    ``max_words`` bounds each worker's cache of words; emptying it changes no
    result.
    """

    def __init__(self, path: str, max_words: int = 500_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.tokens = {i: t for t, i in vocab.items()}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in added.items()}
        self.added = added
        self.added_pattern = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        if not has_plain_pretokens(spec):
            raise ValueError(f"{path} is no word-level BPE file with the expected normalizer and pre-tokenizer")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        letters = byte_letters()
        self.byte_of = {ord(x): b for b, x in enumerate(letters)}
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + self.suffix] for x in letters]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.max_words = max_words
        self.words: dict[bytes, tuple[int, ...]] = {}
        self.chunks: dict[str, tuple[int, str, str]] = {}

    @classmethod
    def shared(cls, path: str) -> "RankArrayBpe":
        if path not in _codecs:
            _codecs[path] = cls(path)
        return _codecs[path]

    def merge_word(self, data: bytes) -> list[int]:
        """Ids of one pre-token given as its UTF-8 bytes."""
        if not data:
            return []
        parts = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        if len(parts) > SHORT:
            return self._merge_long(parts)
        merges, none = self.merges, (NO_MERGE, 0)
        found = [merges.get(p, none) for p in zip(parts, parts[1:])]
        ranks = [r for r, _ in found]
        while ranks:
            least = min(ranks)
            if least == NO_MERGE:
                break
            at = ranks.index(least)
            parts[at:at + 2] = [merges[parts[at], parts[at + 1]][1]]
            del ranks[at]
            if at:
                ranks[at - 1] = merges.get((parts[at - 1], parts[at]), none)[0]
            if at < len(ranks):
                ranks[at] = merges.get((parts[at], parts[at + 1]), none)[0]
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        merges, n = self.merges, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(merges[p][0], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
        heapq.heapify(heap)
        live = [True] * n

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (m := merges.get((parts[i], parts[j]))):
                heapq.heappush(heap, (m[0], i, parts[i], parts[j]))

        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if live[i] else n
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], live[j] = merges[a, b][1], False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p, keep in zip(parts, live) if keep]

    def _plain(self, text: str) -> list[int]:
        """Ids of a text without added tokens."""
        if SIMPLE.fullmatch(text):
            words = [w.encode() for w in PIECES.findall(text.lower())]
        else:
            words = [w.translate(self.byte_of).encode("latin-1") for w, _ in self.split(self.normalize(text))]
        ids: list[int] = []
        for word in words:
            got = self.words.get(word)
            if got is None:
                if len(self.words) > self.max_words:
                    self.words.clear()
                got = tuple(self.merge_word(word))
                if len(word) <= SHORT:
                    self.words[word] = got
            ids += got
        return ids

    def encode(self, text: str) -> list[int]:
        if not self.added_pattern or not self.added_pattern.search(text):
            return self._plain(text)
        ids, at = [], 0
        for m in self.added_pattern.finditer(text):
            ids += self._plain(text[at:m.start()])
            ids.append(self.added[m[0]])
            at = m.end()
        return ids + self._plain(text[at:])

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by spaces: the file names no decoder."""
        return " ".join(self.tokens[i] for i in ids)

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids in decimal, decoded text) of a whole text.

        Spaces and line feeds end a word in any case, so the parts between them
        are encoded and decoded once each and then reused.
        """
        known = self.chunks
        found = []
        for c in text.replace("\n", " ").split(" "):
            got = known.get(c)
            if got is None:
                ids = self.encode(c)
                got = (len(ids), " ".join(map(str, ids)), self.decode(ids))
                if len(known) > self.max_words:
                    known.clear()
                if len(c) <= SHORT:
                    known[c] = got
            if got[0]:
                found.append(got)
        return sum(g[0] for g in found), " ".join([g[1] for g in found]), " ".join([g[2] for g in found])


def encode_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of whole texts; a null text has no ids."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RankArrayBpe.shared(path)
        for batch in byte_slices(batches):
            ids = [codec.encode(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids decode to an empty text."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RankArrayBpe.shared(path)
        for batch in batches:
            found = [codec.decode(i or []) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Encode and decode whole texts; counts and digests of both directions.

    Null and empty texts have no ids; a very long text is encoded whole, a very
    long word with a heap; repeated rows and null doc_ids are kept as they are;
    other columns are ignored, whatever their names; an empty table gives no rows.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RankArrayBpe.shared(path)
        for batch in byte_slices(batches):
            n, ids, decoded = [], [], []
            for text in texts(batch):
                count, decimal, back = codec.digest(text)
                n.append(count)
                ids.append(hashlib.sha256(decimal.encode()).hexdigest())
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
