"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items and documents are sequences of normalised words. A window is ``size``
consecutive words of an item; an item of fewer words is one window. The automaton
knows all word sequences within the items; a document's words stream through it,
and wherever the longest match reaches a window, the window's words are hit.

Words that can't be in a match are left out before: only where all neighbouring
pairs of words are pairs of the items as well does anything stream. The words of
such places are compared with the items' words themselves, so that equal
fingerprints of different words give no match.

The items go to the tasks in parts of at most ``max_words`` words, an automaton
each, and longer items in pieces that overlap by a window less a word. Usually that
is one part; documents go through several ones one after the other, within one job
and without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import as_row, byte_slices, materialize, of_row
from tidemark.llm.word_stream import U64, Rolling, words_of

SIZE = 10
#: Words of one automaton: about 100 MB in a task.
MAX_WORDS = 250_000

#: Bytes that no word holds: all ASCII but digits and letters.
GAP = np.ones(256, bool)
GAP[0x80:] = False
for _first, _last in ("09", "AZ", "az"):
    GAP[ord(_first):ord(_last) + 1] = False
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SMALL = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
ROLLING = Rolling(20241105)


class Automaton:
    """A generalised suffix automaton over word numbers, with the items of each window.

    State 0 is the empty sequence. A state stands for sequences that end at the
    same places of the items; ``length`` is the longest one's, ``link`` the state
    of the longest sequence that ends elsewhere too.
    """

    def __init__(self, items: list[tuple[str, list[str]]], size: int):
        self.size = size
        self.words: dict[str, int] = {}
        self.next: dict[int, int] = {}
        self.length, self.link = [0], [-1]
        self._out: list[dict[int, int]] = [{}]
        numbered = [(name, [self.words.setdefault(w, len(self.words)) for w in words]) for name, words in items]
        for _, ids in numbered:
            last = 0
            for w in ids:
                last = self._extended(last, w)
        #: Items by state: of a window's sequences, and of whole short items with their numbers of words.
        self.windows: dict[int, set[str]] = {}
        self.short: dict[int, set[tuple[int, str]]] = {}
        for name, ids in numbered:
            if len(ids) < size:
                at = 0
                for w in ids:
                    at = self._out[at][w]
                if ids:
                    self.short.setdefault(at, set()).add((len(ids), name))
                continue
            at = n = 0
            for w in ids:
                at, n = self._out[at][w], n + 1
                if n >= size:
                    at, n = self.shortened(at, n)
                    self.windows.setdefault(at, set()).add(name)
        for state, out in enumerate(self._out):
            for w, to in out.items():
                self.next[state * len(self.words) + w] = to
        del self._out
        self.least = min([size, *(n for found in self.short.values() for n, _ in found)])
        pairs = {a * len(self.words) + b for _, ids in numbered for a, b in zip(ids, ids[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        named = sorted(self.words, key=self.words.get)
        self.spelled = [w.encode() for w in named]
        prints = words_of(self.spelled, GAP, [ROLLING]).prints[0] if named else np.empty(0, U64)
        # of words with one fingerprint, should there be any, each is looked up in turn
        order = np.argsort(prints, kind="stable")
        self.prints, self.ids = prints[order], order.astype(np.int64)

    def _state(self, length: int, link: int, out: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self._out.append(out)
        return len(self.length) - 1

    def _split(self, before: int, w: int, to: int) -> int:
        """A state of its own for the sequences of ``to`` that are no longer than ``before`` and w."""
        copy = self._state(self.length[before] + 1, self.link[to], dict(self._out[to]))
        self.link[to] = copy
        while before >= 0 and self._out[before].get(w) == to:
            self._out[before][w] = copy
            before = self.link[before]
        return copy

    def _extended(self, last: int, w: int) -> int:
        """The state of the sequence of ``last`` followed by w, which is added if it is new."""
        to = self._out[last].get(w)
        if to is not None:
            return to if self.length[to] == self.length[last] + 1 else self._split(last, w, to)
        new, at = self._state(self.length[last] + 1, 0, {}), last
        while at >= 0 and w not in self._out[at]:
            self._out[at][w] = new
            at = self.link[at]
        if at >= 0:
            to = self._out[at][w]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._split(at, w, to)
        return new

    def shortened(self, state: int, n: int) -> tuple[int, int]:
        """The state of the last ``size`` words of a match of n."""
        while self.length[self.link[state]] >= self.size:
            state = self.link[state]
        return state, min(n, self.length[state])

    def stream(self, ids: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Occurrences of windows among the words (first, behind the last), and their items."""
        spans, items, state, n = [], set(), 0, 0
        for at, w in enumerate(ids):
            if w < 0:
                state = n = 0
                continue
            to = self.next.get(state * len(self.words) + w)
            while to is None and state:
                state = self.link[state]
                n = self.length[state]
                to = self.next.get(state * len(self.words) + w)
            if to is None:
                continue
            state, n = to, n + 1
            if n >= self.size:
                state, n = self.shortened(state, n)
                items |= self.windows[state]
                spans.append((at + 1 - self.size, at + 1))
            if self.short:
                up = state
                while up > 0:
                    for m, name in self.short.get(up, ()):
                        if m <= n:
                            items.add(name)
                            spans.append((at + 1 - m, at + 1))
                    up = self.link[up]
        return spans, items

    def candidates(self, prints: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers (-1: in no item), and first and last words of the runs that may hold a window."""
        ids = np.full(len(prints), -1, np.int64)
        if len(self.prints) and len(prints):
            at = np.minimum(np.searchsorted(self.prints, prints), len(self.prints) - 1)
            ids = np.where(self.prints[at] == prints, self.ids[at], -1)
        if self.least < 2:
            known = np.flatnonzero(ids >= 0)
            return ids, known, known
        code = ids[:-1] * len(self.words) + ids[1:]
        joined = (ids[:-1] >= 0) & (ids[1:] >= 0) & (text[:-1] == text[1:])
        if len(self.pairs):
            where = np.flatnonzero(joined)
            at = np.minimum(np.searchsorted(self.pairs, code[where]), len(self.pairs) - 1)
            joined[where] = self.pairs[at] == code[where]
        else:
            joined[:] = False
        edge = np.diff(np.concatenate([[0], joined.astype(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        enough = last - first + 1 >= self.least
        return ids, first[enough], last[enough]


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, joined where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_parts(items: DataFrame, size: int, max_words: int) -> Iterator[list[tuple[str, list[str]]]]:
    """The items' words, in parts of about ``max_words`` words, a part at a time on the driver.

    Longer items come in pieces that overlap by size - 1 words, so that every
    window is whole in one of them.
    """
    step = max(max_words // 8, size)
    chosen = items.where("item_id is not null and text is not null")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    cut = chosen.select(F.col("item_id").cast("string").alias("item"), words.alias("w")).where("size(w) > 0")
    cut = cut.select("item", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)), F.lit(step))).alias("at"))
    cut = materialize(cut.select("item", F.slice("w", F.col("at") + 1, step + size - 1).alias("w")).distinct())
    total = cut.agg(F.sum(F.size("w"))).first()[0] or 0
    parts = max(-(-total // max_words), 1)
    for k in range(parts):
        yield [(r["item"], r["w"]) for r in cut.where(F.pmod(F.xxhash64("item", "w"), F.lit(parts)) == k).collect()]


def _through(rows: DataFrame, automaton: Automaton, keep_text: bool) -> DataFrame:
    """Rows of (row, text, n_words, spans, items) with what one automaton finds added; texts become null unless they are kept."""
    sent = rows.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in byte_slices(batches, limit=1 << 22):
            values = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            words = words_of(values, GAP, [ROLLING])
            n_words = np.bincount(words.text, minlength=len(values))
            begun = np.cumsum(n_words) - n_words
            spans = [[(x["a"], x["b"]) for x in s] for s in batch.column("spans").to_pylist()]
            items = [set(s) for s in batch.column("items").to_pylist()]
            ids, first, last = known.candidates(words.prints[0], words.text)
            for a, b in zip(first.tolist(), last.tolist()):
                # the words themselves decide; a stranger with an item word's fingerprint ends the run
                spelled = [words.data[s:e].tobytes().lower() for s, e in zip(words.starts[a:b + 1].tolist(), words.ends[a:b + 1].tolist())]
                run_ids = [known.words.get(w.decode(), -1) for w in spelled]
                t = int(words.text[a])
                more, names = known.stream(run_ids)
                if more:
                    spans[t] += [(x + a - int(begun[t]), y + a - int(begun[t])) for x, y in more]
                    items[t] |= names
            kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            columns = {
                "row": batch.column("row"), "text": batch.column("text") if keep_text else pa.nulls(len(values), pa.string()), "n_words": pa.array(n_words.astype(np.int64)),
                "spans": pa.array([[{"a": x, "b": y} for x, y in united(s)] for s in spans], kind), "items": pa.array([sorted(x) for x in items], pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return rows.mapInArrow(run, rows.schema)


def find_spans(docs: DataFrame, items: DataFrame, size: int = SIZE, max_words: int = MAX_WORDS, keep_text: bool = False) -> DataFrame:
    """(row, n_words, spans, items): the columns of ``docs`` but the text as a struct, and what the text holds of the items.

    ``spans`` are the hit words (first, behind the last), apart and in order;
    ``items`` the ids, as sorted strings, of the items with a window among them.
    With ``keep_text`` the text is a column of its own, too.
    """
    others = docs.drop("text")
    row = as_row(others) if others.columns else F.struct(F.lit(0).alias("none"))
    rows = docs.select(row.alias("row"), F.col("text"), F.lit(0).cast("long").alias("n_words"),
                       F.array().cast("array<struct<a:bigint,b:bigint>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    parts = item_parts(items, size, max_words)
    part = next(parts)
    for following in chain(parts, [None]):
        rows = _through(rows, Automaton(part, size), keep_text or following is not None)
        part = following
    return rows if keep_text else rows.drop("text")


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])


def contamination(docs: DataFrame, items: DataFrame, size: int = SIZE, max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for each row of ``docs``.

    Texts are taken whole, whatever their length; a null or empty one has no
    words. Each of several rows with one doc_id, or none, has a result of its own.
    Items with a null id or text, or without words, have no window; items with
    one id are one item; without items nothing is hit. An empty table gives no
    rows; further columns of either table, whatever their names, play no part.
    """
    found = find_spans(docs.select("doc_id", "text"), items, size, max_words)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def without_spans(docs: DataFrame, items: DataFrame, size: int = SIZE, max_span: int = SIZE, max_coverage: float = 0.5, max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` without the passages of the items, columns unchanged.

    Spans of ``max_span`` hit words or more are cut out of the text with what
    stands between their words; shorter ones, by short items, stay. Documents go
    whole if more than ``max_coverage`` of their words are hit. Null and empty
    texts stay as they are.
    """
    found = find_spans(docs, items, size, max_words, keep_text=True)
    kept = found.where(hit_words() <= F.col("n_words") * F.lit(max_coverage))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                long = [(s["a"], s["b"]) for s in spans if s["b"] - s["a"] >= max_span]
                if long:
                    places = [m.span() for m in WORD.finditer(text.translate(SMALL))]
                    at, parts = 0, []
                    for a, b in long:
                        parts.append(text[at:places[a][0]])
                        at = places[b - 1][1]
                    text = "".join([*parts, text[at:]])
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "text"])

    clean = kept.select("row", "text", "spans")
    clean = clean.mapInArrow(cut, clean.drop("spans").schema)
    return clean.select(*(F.col("text") if c == "text" else of_row("row", [c])[0] for c in docs.columns))
