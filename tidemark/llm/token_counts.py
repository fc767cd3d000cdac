"""Edit-aware token counts: a segment tree over the pre-tokens of a document.

A leaf is a pre-token and the white space after it; inner nodes hold the sums of
characters and tokens below. An edit finds its leaves by descending on
characters, takes neighbours in until the text on both sides ends where
pre-tokens end whatever stands beyond, re-encodes that region only, puts its
pre-tokens in as leaves and updates the sums on the way up.

Trees are kept as a table of (doc_id, text, leaf_chars, leaf_tokens), so edits of
a corpus cost the encoding of what they touch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import byte_slices, texts
from tidemark.llm.tokens import WordEncoder, default_tokenizer

EDIT = "array<struct<start:long,length:long,replacement:string>>"
TREE = "doc_id long, text string, leaf_chars array<int>, leaf_tokens array<int>"

#: White space of the tokenizer in ASCII, and marks that added tokens and contractions are made of.
SPACES = frozenset(" \t\n\x0b\x0c\r")
JOINING = frozenset("'<|>")


def _kind(c: str) -> int:
    """0: no telling, 1: letter, 2: digit, 3: mark."""
    if c.isascii():
        return 0 if c in JOINING else 1 if c.isalpha() else 2 if c.isdigit() else 3
    return int("À" <= c <= "ÿ" and c not in "×÷")


def separate(a: str, b: str) -> bool:
    """Whether pre-tokens end between two characters, whatever stands around them."""
    if a in SPACES:
        return b in SPACES or _kind(b) > 0 or b in JOINING
    if b in SPACES:
        return True
    x, y = _kind(a), _kind(b)
    return x > 0 and y > 0 and (x != y or x == 2)


class SegmentTree:
    """Sums of characters and tokens over the pre-tokens of one text.

    ``cut`` gives the pre-tokens of a text and their numbers of tokens; an edited
    leaf holds several, up to ``crowded`` before the tree is built anew from its
    leaves, without encoding.
    """

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray, cut: Callable[[str], list[tuple[str, int]]], crowded: int = 64):
        self.cut, self.crowded = cut, crowded
        self.encoded_chars = 0
        self._build(text, chars, tokens)

    def _build(self, text: str, chars: np.ndarray, tokens: np.ndarray) -> None:
        n = len(chars)
        self.width = 1 << (n - 1).bit_length()
        self.text, self.base = text, (chars, tokens)
        self.first = np.cumsum(chars) - chars
        both = np.zeros((2, 2 * self.width), np.int64)
        both[0, self.width:self.width + n], both[1, self.width:self.width + n] = chars, tokens
        level = self.width
        while level > 1:
            np.add(both[:, level:2 * level:2], both[:, level + 1:2 * level:2], out=both[:, level // 2:level])
            level //= 2
        # single numbers are read and written much faster through memory views
        self.chars, self.tokens = memoryview(both[0]), memoryview(both[1])
        self.changed: dict[int, list[tuple[str, int]]] = {}

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def pieces(self, leaf: int) -> list[tuple[str, int]]:
        if leaf in self.changed:
            return self.changed[leaf]
        if leaf >= len(self.first):
            return []
        at = int(self.first[leaf])
        return [(self.text[at:at + int(self.base[0][leaf])], int(self.base[1][leaf]))]

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character, and the characters before the leaf."""
        node, before, chars = 1, 0, self.chars
        while node < self.width:
            node *= 2
            if char >= before + chars[node] and chars[node + 1]:
                before += chars[node]
                node += 1
        return node - self.width, before

    def edit(self, start: int, length: int, replacement: str) -> None:
        """Replace ``length`` characters from ``start``; both are cut to the text."""
        start = min(max(start, 0), self.n_chars)
        stop = min(start + max(length, 0), self.n_chars)
        if start == stop and not replacement:
            return
        low, before = self.leaf_at(start)
        high, held = low, list(self.pieces(low))
        own, width = self.chars, self.width
        after = before + own[width + low]

        def more_right() -> bool:
            nonlocal high, after
            if after >= self.n_chars:
                return False
            # mostly the next leaf; edits may have emptied it
            high = high + 1 if own[width + high + 1] else self.leaf_at(after)[0]
            held.extend(self.pieces(high))
            after += own[width + high]
            return True

        def more_left() -> int:
            nonlocal low, before
            if not before:
                return 0
            if own[width + low - 1]:
                low -= 1
                before -= own[width + low]
            else:
                low, before = self.leaf_at(before - 1)
            new = self.pieces(low)
            held[:0] = new
            return len(new)

        while after < stop:
            more_right()
        # held[a:b] is the region that the edit touches
        a, at = 0, before
        while a + 1 < len(held) and at + len(held[a][0]) <= start:
            at += len(held[a][0])
            a += 1
        b, end = a, at
        while b < len(held) and (end < stop or b == a):
            end += len(held[b][0])
            b += 1
        whole = "".join(t for t, _ in held[a:b])
        region = whole[:start - at] + replacement + whole[stop - at:]
        while True:
            if not a:
                a = more_left()
                b += a
            if a and (not region or not separate(held[a - 1][0][-1:], region[0])):
                a -= 1
                region = held[a][0] + region
                continue
            if b < len(held) or more_right():
                if not region or not separate(region[-1], held[b][0][:1]):
                    region += held[b][0]
                    b += 1
                    continue
            break
        self.encoded_chars += len(region)
        held[a:b] = self.cut(region) if region else []
        self._set(low, high, held)
        if len(held) > self.crowded:
            self._build(*self.flat())

    def _set(self, low: int, high: int, pieces: list[tuple[str, int]]) -> None:
        """Put pieces in for all leaves from ``low`` to ``high``; sums above are added up anew, each once."""
        self.changed[low] = [p for p in pieces if p[0]]
        a, b = self.width + low, self.width + high
        for leaf in range(low + 1, high + 1):
            self.changed[leaf] = []
            self.chars[self.width + leaf] = self.tokens[self.width + leaf] = 0
        self.chars[a], self.tokens[a] = sum(len(t) for t, _ in pieces), sum(n for _, n in pieces)
        while a > 1:
            a, b = a // 2, b // 2
            for node in range(a, b + 1):
                self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
                self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def flat(self) -> tuple[str, np.ndarray, np.ndarray]:
        """The text and the characters and tokens of its leaves, as edited."""
        parts, chars, tokens, at = [], [], [], 0
        n = len(self.first)
        for leaf in sorted(x for x in self.changed if x < n):
            for whole, base in ((chars, self.base[0]), (tokens, self.base[1])):
                whole.append(base[at:leaf])
            if leaf > at:
                parts.append(self.text[int(self.first[at]):int(self.first[leaf])])
            own = self.changed[leaf]
            parts += [t for t, _ in own]
            chars.append(np.array([len(t) for t, _ in own], np.int64))
            tokens.append(np.array([c for _, c in own], np.int64))
            at = leaf + 1
        if at < n:
            parts.append(self.text[int(self.first[at]):])
        chars, tokens = np.concatenate([*chars, self.base[0][at:]]), np.concatenate([*tokens, self.base[1][at:]])
        if not len(chars):
            chars = tokens = np.zeros(1, np.int64)
        return "".join(parts), chars, tokens


def attach_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """Join a long table of edits (doc_id, seq, start, length, replacement) to documents.

    Edits of a document apply one after the other and so stay together; the
    text is joined once, after the edits of a document are one row. A column
    ``edits`` of ``docs`` is replaced.
    """
    rows = edits.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("seq", "start", "length", "replacement"))).alias("edits"))
    rows = rows.select("doc_id", F.transform("edits", lambda e: F.struct(e["start"], e["length"], e["replacement"])).cast(EDIT).alias("edits"))
    return docs.drop("edits").join(rows, "doc_id", "left")


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, values), np.int64, len(values)))])
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32)))


def build_trees(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The trees of documents, to be kept as a table: doc_id, text, leaf_chars and leaf_tokens.

    Inner sums follow from the leaves. A null text counts as empty, which is one
    leaf of nothing; repeated rows have a tree each; other columns are ignored.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.shared(path)
        for batch in byte_slices(batches, limit=4 << 20):
            own = texts(batch)
            found = encoder.leaves(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(own, pa.string()), _lists([c for c, _ in found]), _lists([n for _, n in found])],
                ["doc_id", "text", "leaf_chars", "leaf_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, TREE)


def _apply(tree: SegmentTree, edits: list[dict] | None) -> int:
    for e in edits or []:
        if e:
            tree.edit(e["start"] or 0, e["length"] or 0, e["replacement"] or "")
    return len(edits or [])


def update_trees(trees: DataFrame, edits: Column, tokenizer: str | None = None) -> DataFrame:
    """Kept trees with their edits applied: the columns of trees, n_tokens and n_encoded_chars.

    Only the text that edits touch is encoded, ``n_encoded_chars`` of it; the
    result is a table of trees for the next edits. ``edits`` as in
    ``count_with_edits``.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.shared(path)
        for batch in byte_slices(batches, limit=4 << 20):
            rows = []
            leaves = [[np.array(v or [0], np.int64) for v in batch.column(c).to_pylist()] for c in ("leaf_chars", "leaf_tokens")]
            for text, chars, tokens, own in zip(texts(batch), *leaves, batch.column("edits").to_pylist()):
                tree = SegmentTree(text, chars, tokens, encoder.pieces_of)
                _apply(tree, own)
                rows.append((*tree.flat(), tree.n_tokens, tree.encoded_chars))
            text, chars, tokens, counts, encoded = map(list, zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(text, pa.string()), _lists(chars), _lists(tokens), pa.array(counts, pa.int64()), pa.array(encoded, pa.int64())],
                ["doc_id", "text", "leaf_chars", "leaf_tokens", "n_tokens", "n_encoded_chars"])

    return trees.select("doc_id", "text", "leaf_chars", "leaf_tokens", edits.cast(EDIT).alias("edits")).mapInArrow(
        run, TREE + ", n_tokens long, n_encoded_chars long")


def count_with_edits(docs: DataFrame, edits: Column, tokenizer: str | None = None, with_text: bool = False) -> DataFrame:
    """Token counts of each document before and after its edits.

    ``edits`` is an array of (start, length, replacement) in characters of the
    text as the edits before have left it. Null and empty texts have no tokens,
    a very long text is one tree; null or empty edits change nothing, a null
    replacement deletes, null offsets are 0. Returns doc_id, n_tokens, n_edits,
    n_tokens_after, n_chars_after and n_encoded_chars, the characters that the
    edits had encoded anew; the edited text too where ``with_text`` is set.
    Repeated rows are counted each; other columns are ignored, whatever their
    names; an empty table gives no rows.
    """
    path = tokenizer or default_tokenizer()
    names = ["n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_encoded_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.shared(path)
        for batch in byte_slices(batches, limit=4 << 20):
            rows, after, own = [], [], texts(batch)
            for text, (chars, tokens), changes in zip(own, encoder.leaves(own), batch.column("edits").to_pylist()):
                tree = SegmentTree(text, chars, tokens, encoder.pieces_of)
                before = tree.n_tokens
                n = _apply(tree, changes)
                rows.append((before, n, tree.n_tokens, tree.n_chars, tree.encoded_chars))
                if with_text:
                    after.append(tree.flat()[0])
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in zip(*rows))]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(after, pa.string())] * with_text, ["doc_id", *names] + ["text"] * with_text)

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", text string" * with_text
    return docs.select(F.col("doc_id").cast("long"), "text", edits.cast(EDIT).alias("edits")).mapInArrow(run, schema)


def revision_edits() -> Column:
    """The edits of a revision of ``text``: a moved passage, a cut and an addition.

    Sixteen characters at a quarter give way to those at three quarters, eight
    at the middle are deleted, and a closing line is added.
    """
    n = F.char_length(F.coalesce("text", F.lit("")))
    quarter, half, rest = (F.floor(n * k / 4) for k in (1, 2, 3))

    def step(start: Column, length: int, replacement: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(length).cast("long").alias("length"), replacement.alias("replacement"))

    return F.array(
        step(quarter, 16, F.substr(F.coalesce("text", F.lit("")), (rest + 1).cast("int"), F.lit(16))),
        step(half, 8, F.lit("")),
        step(n.cast("long"), 0, F.concat(F.lit("\nrevised document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
