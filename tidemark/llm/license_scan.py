"""License scans: template markup compiled into token automata.

A template is wording with two kinds of marked regions: ``[[...]]`` may be
missing, ``{n}`` stands for up to n words of any kind, ``{a|b}`` for one of the
words given. Everything else is mandatory. A text holds a template if somewhere
its words run through the automaton to the end, so that the mandatory wording
stands there exactly, word for word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import byte_slices

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
IS_WORD = np.array([WORD.fullmatch(bytes([b]).lower()) is not None for b in range(256)])

#: Phrases of the base scan and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# The wording of notices and licenses in common use.
_NOTICE = "{released|licensed|distributed|available} under"
_AS_IS_DAMAGES = (
    "any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or "
    "services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, "
    "or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage")
_BSD_OPENING = "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_CONDITIONS = (
    _BSD_OPENING + ": [[1]] redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "[[2]] redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution.")
_BSD_END = (
    "this software is provided by {8} as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and "
    "fitness for a particular purpose are disclaimed. in no event shall {8} be liable for " + _AS_IS_DAMAGES)
_MIT_OPENING = (
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the software), to deal in "
    "the software without restriction")


def _gnu_notice(license: str, version: str) -> str:
    return (
        "{6} free software; you can redistribute it and/or modify it under the terms of the " + license + " as published by the free software foundation; "
        "either version " + version + " of the license, [[or (at your option) any later version]]. {6} distributed in the hope that it will be useful, but without "
        "any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. see the " + license + " for more details. "
        "you should have received a copy of the " + license + " along with {4}; if not")


#: Label, score, markup. Whole texts score 1, notices of a line or a file that name a license 0.9, opening clauses alone 0.7.
TEMPLATES = [
    ("mit-notice", 0.9, _NOTICE + " the [[terms of the]] mit license"),
    ("apache-2.0", 0.9, _NOTICE + " the [[terms of the]] apache license, version 2.0"),
    ("gpl-3.0", 0.9, "this {3} is " + _NOTICE + " the [[terms of the]] gnu general public license version 3 [[or [[at your option]] any later version]]"),
    ("gpl-2.0", 0.9, "this {3} is " + _NOTICE + " the [[terms of the]] gnu general public license version 2 [[or [[at your option]] any later version]]"),
    ("cc-by-nc-4.0", 0.9, _NOTICE + " [[a]] cc by-nc 4.0 [[license]]"),
    ("cc-by-sa-4.0", 0.9, _NOTICE + " [[a]] cc by-sa 4.0 [[license]]"),
    ("cc-by-4.0", 0.9, _NOTICE + " [[a]] cc by 4.0 [[license]]"),
    ("all-rights-reserved", 0.9, "[[copyright [[c]] {6}]] all rights reserved"),
    ("mit-opening", 0.7, _MIT_OPENING),
    ("bsd-opening", 0.7, _BSD_OPENING),
    ("mit-text", 1.0, _MIT_OPENING + (
        ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit "
        "persons to whom the software is furnished to do so, subject to the following conditions: the above copyright notice and this permission notice [[including "
        "the next paragraph]] shall be included in all copies or substantial portions of the software. the software is provided as is, without warranty of any kind, "
        "express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. in no event shall "
        "the {6} be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with "
        "the software or the use or other dealings in the software")),
    ("bsd-2-clause-text", 1.0, _BSD_CONDITIONS + " " + _BSD_END),
    ("bsd-3-clause-text", 1.0, _BSD_CONDITIONS + (
        " [[3]] neither the name of {12} nor the names of {2} contributors may be used to endorse or promote products derived from this software without specific "
        "prior written permission. ") + _BSD_END),
    ("isc-text", 1.0, (
        "permission to use, copy, modify, and [[or]] distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
        "notice and this permission notice appear in all copies. the software is provided as is and {4} disclaims all warranties with regard to this software including "
        "all implied warranties of merchantability and fitness. in no event shall {4} be liable for any special, direct, indirect, or consequential damages or any "
        "damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in "
        "connection with the use or performance of this software")),
    ("apache-2.0-file-notice", 0.9, (
        "licensed under the apache license, version 2.0 [[the license]]; you may not use this file except in compliance with the license. you may obtain a copy of the "
        "license at {10} unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an as is basis, without "
        "warranties or conditions of any kind, either express or implied. see the license for the specific language governing permissions and limitations under the "
        "license")),
    ("gpl-2.0-file-notice", 0.9, _gnu_notice("gnu general public license", "2")),
    ("gpl-3.0-file-notice", 0.9, _gnu_notice("gnu general public license", "3")),
    ("lgpl-2.1-file-notice", 0.9, _gnu_notice("gnu lesser general public license", "2.1")),
    ("lgpl-3.0-file-notice", 0.9, _gnu_notice("gnu lesser general public license", "3")),
    ("mpl-2.0-file-notice", 0.9, (
        "this source code form is subject to the terms of the mozilla public license, v. 2.0. if a copy of the mpl was not distributed with this file, you can obtain "
        "one at {8} mozilla.org/mpl/2.0")),
]
#: What base phrases alone score.
BASE_SCORE = 0.5


def marks(markup: str) -> list[str]:
    """``[[``, ``]]``, ``{...}`` and the words of what stands between them."""
    out = []
    for part in re.findall(r"\[\[|\]\]|\{[^}]*\}|[^\[\]{}]+", markup):
        out += [part] if part[0] in "[]{" else [w.decode() for w in WORD.findall(part.lower().encode())]
    return out


class Automaton:
    """States 0..end; each has word edges, any-word edges and free steps."""

    def __init__(self, markup: str):
        self.words: list[dict[bytes, int]] = [{}]
        self.any: list[int] = [-1]
        self.free: list[list[int]] = [[]]
        mandatory: list[list[bytes]] = []
        opened: list[int] = []
        for mark in marks(markup):
            here = len(self.words) - 1
            if mark == "[[":
                opened.append(here)
            elif mark == "]]":
                self.free[opened.pop()].append(here)
            elif mark[0] == "{" and mark[1:-1].isdigit():
                steps = [here] + [self._state() for _ in range(int(mark[1:-1]))]
                for a, b in zip(steps, steps[1:]):
                    self.any[a] = b
                    self.free[a].append(steps[-1])
            else:
                names = mark.strip("{}").encode().split(b"|")
                after = self._state()
                self.words[here].update(dict.fromkeys(names, after))
                if not opened and len(names) == 1:
                    mandatory.append(names)
        self.end = len(self.words) - 1
        #: The longest words that any match must hold, to pass over texts quickly.
        self.needs = sorted({w[0] for w in mandatory}, key=lambda w: (-len(w), w))[:2]
        self.starts = self._closed({0})

    def _state(self) -> int:
        self.words.append({})
        self.any.append(-1)
        self.free.append([])
        return len(self.words) - 1

    def _closed(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return out

    def accepts(self, words: list[bytes]) -> bool:
        """Whether a run of the words goes through the template.

        A new run may begin at every word; all runs advance as one set of
        states, so the time grows with the number of words only.
        """
        live: set[int] = set()
        first = set().union(*(self.words[s] for s in self.starts))
        wild = any(self.any[s] >= 0 for s in self.starts)
        for w in words:
            if wild or w in first:
                live |= self.starts
            elif not live:
                continue
            moved = {self.words[s][w] for s in live if w in self.words[s]} | {self.any[s] for s in live if self.any[s] >= 0}
            live = self._closed(moved) if moved else set()
            if self.end in live:
                return True
        return False


@lru_cache(maxsize=8)
def compiled(templates: tuple[tuple[str, float, str], ...]) -> list[tuple[str, float, Automaton]]:
    return [(label, score, Automaton(markup)) for label, score, markup in templates]


def places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    n = len(phrase)
    return [i for i, w in enumerate(words) if w == phrase[0] and words[i:i + n] == phrase]


def scan(docs: DataFrame, templates: list[tuple[str, float, str]] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """Base places and labels of each document, and the labels of its templates.

    Letters A-Z are lower-cased; words are runs of other letters, digits and
    non-ASCII characters of the whole text, however long. The score is the highest
    of the accepted templates', 0.5 where only base phrases stand, else 0. A null
    or empty text has no words, null first_word and last_word, and empty labels.
    Texts that hold several templates have all their labels, and ties in score
    don't matter; repeated rows are scanned each; other columns are ignored,
    whatever their names; an empty table gives no rows.
    """
    chosen = tuple(templates if templates is not None else TEMPLATES)
    base = [(p.encode().split(), label) for p, label in (phrases if phrases is not None else PHRASES).items()]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = compiled(chosen)
        for batch in byte_slices(batches):
            values = [(t or b"").lower() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            flags = IS_WORD[np.frombuffer(b" ".join(values) + b" ", np.uint8)]
            ends = np.concatenate([[0], np.cumsum(flags[:-1] & ~flags[1:])])
            sizes = np.cumsum(np.fromiter(map(len, values), np.int64, len(values)) + 1)
            counts = np.diff(np.concatenate([[0], ends[sizes - 1]]))
            rows = []
            for doc, value, n in zip(batch.column("doc_id").to_pylist(), values, counts.tolist()):
                asked = [t for t in automata if all(w in value for w in t[2].needs)]
                stated = [(p, label) for p, label in base if all(w in value for w in p)]
                if not asked and not stated:
                    rows.append((doc, n, 0, None, None, "", "", 0.0))
                    continue
                words = WORD.findall(value)
                at, own = [], set()
                for phrase, label in stated:
                    if got := places(words, phrase):
                        at += got
                        own.add(label)
                more = {label: score for label, score, a in asked if a.accepts(words)}
                rows.append((doc, n, len(at), min(at, default=None), max(at, default=None), ",".join(sorted(own)),
                             ",".join(sorted(own | set(more))), max(more.values(), default=BASE_SCORE if own else 0.0)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
