"""Encoding of whole texts with a public tokenizer file, pre-token by pre-token.

The word tokenizer drops white space, lower-cases and encodes every pre-token on
its own, so the ids of a text are the ids of its pre-tokens, one after the other.
A slice of texts is cut into pre-tokens on arrays of bytes and
dictionary-encoded; only its distinct pre-tokens are looked up, only those that a
worker process has not met go to the tokenizers library, and the ids of the
whole slice are gathered at once. Chunks between spaces whose pre-tokens bytes
can't tell (other alphabets, contractions, added tokens) go to the library as
they are, and files with other normalizers or pre-tokenizers are encoded by
whole texts.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

# The normalizer and pre-tokenizer whose pre-tokens this module can tell.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Kinds of bytes; a pre-token is a digit or a run of one other kind.
SPACE, LETTER, DIGIT, MARK, WHOLE = range(5)
KIND = np.full(256, MARK, np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = SPACE
KIND[ord("0"):ord("9") + 1] = DIGIT
KIND[ord("A"):ord("Z") + 1] = KIND[ord("a"):ord("z") + 1] = LETTER
KIND[0x80:] = WHOLE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: The letters from U+00C0 to U+00FF are this byte and one more.
LATIN = 0xC3
#: A pre-token as it goes to the model.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf]|\xc3\x9f)+|[0-9]|[^a-z0-9A-Z\t-\r \x80-\xff]+")

#: The same for one short text: letters that only lower-casing touches, and the pre-tokens of such a text.
LETTERS = "a-zß-öø-ÿ"
SIMPLE = re.compile("[\\x00-\\x7fÀ-ÖØ-öø-ÿ]*")
PIECES = re.compile(f"[{LETTERS}]+|[0-9]|[^\\t-\\r 0-9{LETTERS}]+")
CHUNKS = re.compile("[^\\t-\\r ]+")

_encoders: dict[str, "WordEncoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies.

    Bytes that print as themselves stand for themselves, the others take the
    code points from 256 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def has_plain_pretokens(spec: dict) -> bool:
    """Whether a tokenizer file normalizes and splits as this module assumes."""
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    return ([s["type"] for s in steps] == NORMALIZERS and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
            and [s["type"] for s in splits] == ["Split", "ByteLevel"] and splits[0]["pattern"] == {"Regex": SPLIT}
            and splits[0]["behavior"] == "Removed" and splits[0]["invert"] and not splits[1]["add_prefix_space"] and not splits[1]["use_regex"]
            and all(t["content"].startswith("<|") and not t["normalized"] for t in spec["added_tokens"]))


def cut(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The pre-tokens of texts: first byte in the texts joined by a space, kind and lower-case bytes."""
    raw = np.frombuffer(b" ".join(values) + b" ", np.uint8)
    kind, low = KIND[raw], LOWER[raw]
    first = np.flatnonzero(raw == LATIN)
    if len(first):
        after = raw[first + 1]
        letter = (after != 0x97) & (after != 0xB7)
        first, after = first[letter], after[letter]
        kind[first] = kind[first + 1] = LETTER
        low[first + 1] = after + np.where(after < 0x9F, 32, 0).astype(np.uint8)
    odd = kind == WHOLE
    odd[:-1] |= (raw[:-1] == ord("'")) & (kind[1:] == LETTER) | (raw[:-1] == ord("<")) & (raw[1:] == ord("|"))
    space = kind == SPACE
    if odd.any():
        chunk = np.cumsum(space)
        whole = np.zeros(int(chunk[-1]) + 1, bool)
        whole[chunk[odd]] = True
        whole = whole[chunk] & ~space
        kind[whole], low[whole] = WHOLE, raw[whole]
    new = ~space
    new[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    starts = np.flatnonzero(new)
    offsets = np.append(np.cumsum(~space)[starts] - 1, len(raw) - np.count_nonzero(space))
    pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(low[~space])])
    return starts, kind[starts], pieces


def _longer(values: np.ndarray, more: list[int]) -> np.ndarray:
    """Values with more after them, in a buffer that doubles where it is full, so that a few more don't copy all."""
    n, buffer = len(values), values.base if values.base is not None else values
    if n + len(more) > len(buffer):
        buffer = np.empty(max(2 * len(buffer), n + len(more), 1024), values.dtype)
        buffer[:n] = values
    buffer[n:n + len(more)] = more
    return buffer[:n + len(more)]


class WordEncoder:
    """Texts -> ids, with the ids of the pre-tokens met so far.

    ``max_words`` bounds the memory of these; where there are more, they are
    forgotten and filled again, which changes no result.
    """

    def __init__(self, path: str, max_words: int = 800_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            self.by_pretoken = has_plain_pretokens(json.load(f))
        self.letters = dict(enumerate(byte_letters()))
        self.max_words = max_words
        self._forget()

    @classmethod
    def shared(cls, path: str) -> "WordEncoder":
        """One encoder per worker process and tokenizer file."""
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def _forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.ends = np.empty(0, np.int64)
        self.sizes: list[int] = []

    def encode(self, text: str) -> list[int]:
        return self.encode_column(pa.array([text]))[0].tolist()

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row and each text's number of ids; nulls are empty."""
        values = [v or b"" for v in column.cast(pa.binary()).to_pylist()]
        if not self.by_pretoken:
            found = [e.ids for e in self.tokenizer.encode_batch_fast([v.decode() for v in values], add_special_tokens=False)]
            return np.array([i for f in found for i in f], np.uint32), np.fromiter(map(len, found), np.int64, len(found))
        starts, _, pieces = cut(values)
        slots, text_ends = self.slots_of(pieces), np.cumsum(np.fromiter(map(len, values), np.int64, len(values)) + 1)
        begins = np.concatenate([[0], self.ends])[slots]
        sizes = self.ends[slots] - begins
        after = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.arange(after[-1]) + np.repeat(begins - after[:-1], sizes)]
        return ids, np.diff(after[np.searchsorted(starts, text_ends)], prepend=0)

    def leaves(self, values: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Characters and tokens of each text's pre-tokens, with the white space that follows them.

        White space before the first one belongs to it; a text without pre-tokens is one of no tokens.
        """
        data = [v.encode() for v in values]
        text_ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)) + 1)
        if self.by_pretoken:
            starts, _, pieces = cut(data)
            slots = self.slots_of(pieces)
            tokens = self.ends[slots] - np.concatenate([[0], self.ends])[slots]
            heads = np.searchsorted(starts, np.concatenate([[0], text_ends]))
        else:
            starts, heads = text_ends - np.diff(text_ends, prepend=0), np.arange(len(data) + 1)
            tokens = self.encode_column(pa.array(values, pa.string()))[1]
        raw = np.frombuffer(b" ".join(data) + b" ", np.uint8)
        chars = np.cumsum((raw & 0xC0) != 0x80)[starts] - 1 if len(starts) else starts
        out, before = [], 0
        for value, a, b in zip(values, heads[:-1].tolist(), heads[1:].tolist()):
            places = chars[a:b].copy() - before
            places[:1] = 0
            out.append((np.diff(places, append=len(value)), tokens[a:b]) if b > a else (np.array([len(value)]), np.zeros(1, np.int64)))
            before += len(value) + 1
        return out

    def pieces_of(self, text: str) -> list[tuple[str, int]]:
        """The pre-tokens of one text, with the white space that follows them, and their numbers of tokens."""
        if len(text) > 2000 or not self.by_pretoken:
            ends = [0]
            (chars, tokens), = self.leaves([text])
            for n in chars.tolist():
                ends.append(ends[-1] + n)
            return [(text[a:b], n) for a, b, n in zip(ends, ends[1:], tokens.tolist())]
        starts, words = [], []
        if SIMPLE.fullmatch(text) and "'" not in text and "<|" not in text:
            for p in PIECES.finditer(text.lower()):
                starts.append(p.start())
                words.append(p[0].encode())
        for m in CHUNKS.finditer(text) if not words else ():
            if SIMPLE.fullmatch(m[0]) and "'" not in m[0] and "<|" not in m[0]:
                for p in PIECES.finditer(m[0].lower()):
                    starts.append(m.start() + p.start())
                    words.append(p[0].encode())
            else:
                starts.append(m.start())
                words.append(m[0].encode())
        if not words:
            return [(text, 0)]
        if len(self.slots) > self.max_words:
            self._forget()
        self._learn(list({w for w in words if w not in self.slots}))
        starts[0] = 0
        sizes, slots = self.sizes, self.slots
        return [(text[a:b], sizes[slots[w]]) for a, b, w in zip(starts, [*starts[1:], len(text)], words)]

    def slots_of(self, pieces: pa.Array) -> np.ndarray:
        """Where the ids of each pre-token are kept: those of slot s are before ``ends[s]``."""
        coded = pieces.dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.slots) + len(words) > self.max_words:
            self._forget()
        found = list(map(self.slots.get, words))
        if None in found:
            self._learn([w for w, s in zip(words, found) if s is None])
            found = list(map(self.slots.__getitem__, words))
        return np.array(found, np.int64)[coded.indices.to_numpy()]

    def _learn(self, words: list[bytes]) -> None:
        if not words:
            return
        at, ids, ends, rest = len(self.ends), [], [], []
        tokenize, base = self.model.tokenize, len(self.ids)
        for w in words:
            if not PLAIN.fullmatch(w) or b"<|" in w:
                rest.append(w)
                continue
            text = w.decode()
            if not (text.isascii() and text.isprintable()):
                text = w.decode("latin-1").translate(self.letters)
            ids += [t.id for t in tokenize(text)]
            self.slots[w] = at + len(ends)
            ends.append(base + len(ids))
        if rest:
            for w, e in zip(rest, self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)):
                ids += e.ids
                self.slots[w] = at + len(ends)
                ends.append(base + len(ids))
        self.ids, self.ends = _longer(self.ids, ids), _longer(self.ends, ends)
        self.sizes += np.diff(self.ends[at:], prepend=base).tolist()
