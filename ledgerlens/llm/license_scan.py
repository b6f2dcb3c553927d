"""Licence scan with a generalised suffix automaton over licence tokens.

The automaton holds every run of tokens of every template. Texts are streamed through it token by
token, which gives the matching statistics: the longest run ending at each token that occurs in
some template, and where. The words of long maximal matches are credited to every template that
has ``MIN_MATCH`` of them in a row, wherever, also where another template's match goes on. The
longest chain of a template's words in text and template order is its coverage, however far apart
they stand; a template is reported when the chain covers enough of it, and gaps cut its span.

Only runs of tokens whose neighbours also stand side by side in a template can hold a match of two
tokens or more, so the stream skips the rest."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlens.llm import text as tx
from ledgerlens.llm.decontaminate import Lookup

# Phrases of the contract with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Public licence notices.
TEMPLATES = (
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("mit-notice", "Released under the MIT License"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0",
    ),
    (
        "apache-2.0-text",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS"
        " OF ANY KIND, either express or implied",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-text",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version",
    ),
    (
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: Redistributions of source code must retain the above copyright notice",
    ),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("all-rights-reserved", "All rights reserved"),
    (
        "mit-conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions"
        " of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING"
        " BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN"
        " NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN"
        " AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR"
        " OTHER DEALINGS IN THE SOFTWARE",
    ),
    (
        "bsd-3-clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
    ),
    (
        "bsd-disclaimer",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES,"
        " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE"
        " ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,"
        " INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF"
        " SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON"
        " ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)"
        " ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE",
    ),
    (
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "zlib-text",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held"
        " liable for any damages arising from the use of this software. Permission is granted to anyone to use this"
        " software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,"
        " use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any"
        " purpose, commercial or non-commercial, and by any means",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ),
    (
        "epl-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"
        " which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0"),
    (
        "cc0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this"
        " work",
    ),
    # Only the words that tell one licence from its siblings: whole notices of these differ by one word.
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl", "GNU Affero General Public License"),
    ("cc-by-sa-4.0", "Attribution-ShareAlike 4.0 International"),
    ("cc-by-nc-4.0-text", "Attribution-NonCommercial 4.0 International"),
    ("cc-by-nd-4.0", "Attribution-NoDerivatives 4.0 International"),
    ("spdx-mit", "SPDX-License-Identifier: MIT"),
    ("spdx-apache", "SPDX-License-Identifier: Apache"),
    ("spdx-bsd", "SPDX-License-Identifier: BSD"),
    ("spdx-gpl", "SPDX-License-Identifier: GPL"),
    ("spdx-lgpl", "SPDX-License-Identifier: LGPL"),
    ("spdx-agpl", "SPDX-License-Identifier: AGPL"),
    ("spdx-mpl", "SPDX-License-Identifier: MPL"),
    ("spdx-isc", "SPDX-License-Identifier: ISC"),
)
MIN_MATCH = 3
MAX_GAP = 8
COVERAGE = 0.8


@dataclass
class Automaton:
    """Suffix automaton of several token sequences. ``place[s]`` maps a template to the end of its
    first occurrence of the state's strings."""

    tokens: dict[int, int]
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])
    place: list[dict[int, int]] = field(default_factory=lambda: [{}])
    lengths: list[int] = field(default_factory=list)

    def _new(self, size: int, step: dict[int, int], link: int) -> int:
        self.step.append(dict(step))
        self.link.append(link)
        self.size.append(size)
        self.place.append({})
        return len(self.size) - 1

    def _split(self, p: int, q: int, token: int) -> int:
        """A copy of ``q`` for the strings that reach it through ``p``."""
        copy = self._new(self.size[p] + 1, self.step[q], self.link[q])
        self.link[q] = copy
        while p >= 0 and self.step[p].get(token) == q:
            self.step[p][token] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, token: int) -> int:
        if token in self.step[last]:
            q = self.step[last][token]
            return q if self.size[q] == self.size[last] + 1 else self._split(last, q, token)
        now, p = self._new(self.size[last] + 1, {}, 0), last
        while p >= 0 and token not in self.step[p]:
            self.step[p][token] = now
            p = self.link[p]
        if p >= 0:
            q = self.step[p][token]
            self.link[now] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, token)
        return now

    def add(self, sequence: list[int]) -> None:
        last = 0
        for token in sequence:
            last = self._extend(last, token)
        self.lengths.append(len(sequence))

    def finish(self, sequences: list[list[int]]) -> None:
        """Mark where each state's strings first end in each template."""
        for which, sequence in enumerate(sequences):
            state = 0
            for at, token in enumerate(sequence):
                state = self.step[state][token]
                self.place[state].setdefault(which, at + 1)
        for state in sorted(range(1, len(self.size)), key=lambda s: -self.size[s]):
            up = self.place[self.link[state]]
            for which, at in self.place[state].items():
                up[which] = min(up.get(which, at), at)


@dataclass
class Scanner:
    """Automaton with the lookups that select what is streamed through it."""

    automaton: Automaton
    labels: list[str]
    n_phrases: int
    words: Lookup
    pairs: np.ndarray  # allowed (token, next token) as one number, sorted
    ends: list[list[tuple[int, int]]]  # (phrase, length) ending in a state's strings
    sequences: list[list[int]]
    runs: dict[tuple[int, ...], list[tuple[int, int]]]  # places of each MIN_MATCH tokens in templates

    def streams(self, words: tx.Words) -> list[tuple[int, np.ndarray]]:
        """(first word, tokens) of each run that can hold a match of two tokens or more."""
        at, token = self.words.find(words.hash)
        if len(at) < 2 or not len(self.pairs):
            return []
        pair = token[:-1] * len(self.words.keys) + token[1:]
        place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        room = words.room()[at[:-1]]
        joined = (np.diff(at) == 1) & (self.pairs[place] == pair) & (room > 1)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], joined.astype(np.int8), [0]])))
        return [(int(at[a]), token[a : b + 1]) for a, b in edge.reshape(-1, 2)]

    def matches(self, first: int, tokens: np.ndarray) -> tuple[list, list]:
        """Phrase places (start word, phrase) and maximal matches (start, length, state) of a run."""
        a = self.automaton
        state = size = 0
        found, long = [], []
        for i, token in enumerate(tokens.tolist()):
            before = (size, state)
            while state and token not in a.step[state]:
                state = a.link[state]
                size = a.size[state]
            if token in a.step[state]:
                state = a.step[state][token]
                size += 1
            if before[0] >= MIN_MATCH and size != before[0] + 1:
                long.append((first + i - before[0], *before))
            for phrase, length in self.ends[state]:
                if length <= size:
                    found.append((first + i - length + 1, phrase))
        if size >= MIN_MATCH:
            long.append((first + len(tokens) - size, size, state))
        return found, long

    def _credited(self, start: int, size: int, state: int):
        """(word, template, token of the template) where a run of ``MIN_MATCH`` of a match's tokens
        stands in a template."""
        which, end = next(iter(self.automaton.place[state].items()))
        tokens = self.sequences[which][end - size : end]
        for x in range(size - MIN_MATCH + 1):
            for template, y in self.runs.get(tuple(tokens[x : x + MIN_MATCH]), ()):
                for k in range(MIN_MATCH):
                    yield start + x + k, template, y + k

    def chains(self, long: list) -> list[tuple[str, int, int, float]]:
        """(label, start, end, coverage of the template) of each part of the fullest chain of each
        template with matches in one document; of equally full ones, that which ends first and then
        starts last."""
        chains: dict[int, Chain] = {}
        waiting: dict[int, dict[int, set[int]]] = {}

        def advance(until: float) -> None:
            for at in sorted(w for w in waiting if w < until):
                for template, tokens in waiting.pop(at).items():
                    chain = chains.get(template)
                    if chain is None:
                        chain = chains[template] = Chain(self.automaton.lengths[template])
                    chain.add(at, tokens)

        for start, size, state in long:
            # Matches come by start, so the words before this one are complete.
            advance(start)
            for at, template, token in self._credited(start, size, state):
                waiting.setdefault(at, {}).setdefault(template, set()).add(token)
        advance(float("inf"))
        out = []
        for template, chain in chains.items():
            share = chain.covered / self.automaton.lengths[template]
            out += [(self.labels[template], a, b, share) for a, b in chain.parts()]
        return sorted(out)


class Chain:
    """Longest common subsequence of a template and the words credited to it, word by word."""

    def __init__(self, length: int):
        # Of the best chain that ends with each token: tokens, then start; 0 for none.
        self.keys = np.zeros(length + 1, dtype=np.int64)
        self.ends: list[tuple | None] = [None] * (length + 1)  # (part's start, last word, earlier parts)
        self.covered, self.best = 0, None
        self.key = 0

    def add(self, at: int, tokens: set[int]) -> None:
        # From the right, so that a word is not used twice.
        for token in sorted(tokens, reverse=True):
            before = int(self.keys[: token + 1].argmax())
            key = int(self.keys[before])
            key = key + (1 << 40) if key else (1 << 40) + at
            if key <= self.keys[token + 1]:
                continue
            end = self.ends[before]
            near = end is not None and at - end[1] - 1 <= MAX_GAP
            end = (end[0], at, end[2]) if near else (at, at, end)
            self.keys[token + 1], self.ends[token + 1] = key, end
            if key >> 40 > self.covered or (self.best[1] == at and key > self.key):
                self.covered, self.best, self.key = key >> 40, end, key

    def parts(self) -> list[tuple[int, int]]:
        out, end = [], self.best
        while end is not None:
            out.append((end[0], end[1] + 1))
            end = end[2]
        return out[::-1]


def build_scanner(phrases=PHRASES, templates=TEMPLATES) -> Scanner:
    texts = [p for p, _ in phrases] + [t for _, t in templates]
    words = tx.split_words(*tx.text_of(texts), tx.NON_WORD)
    keys, token = np.unique(words.hash, return_inverse=True)
    sequences = [token[a:b].tolist() for a, b in zip(words.first[:-1], words.first[1:])]
    least = [2] * len(phrases) + [MIN_MATCH] * len(templates)
    short = [t for t, s, n in zip(texts, sequences, least) if len(s) < n]
    if short:
        raise ValueError(f"too few words to be found: {short}")
    automaton = Automaton({})
    for sequence in sequences:
        automaton.add(sequence)
    automaton.finish(sequences)
    pairs = np.unique([x * len(keys) + y for s in sequences for x, y in zip(s[:-1], s[1:])])
    own: dict[int, list[tuple[int, int]]] = {}
    for phrase in range(len(phrases)):
        state = 0
        for t in sequences[phrase]:
            state = automaton.step[state][t]
        own.setdefault(state, []).append((phrase, len(sequences[phrase])))
    ends: list[list[tuple[int, int]]] = [[] for _ in automaton.size]
    for state in sorted(range(1, len(automaton.size)), key=lambda s: automaton.size[s]):
        ends[state] = own.get(state, []) + ends[automaton.link[state]]
    labels = [label for _, label in phrases] + [label for label, _ in templates]
    runs: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    for which, sequence in list(enumerate(sequences))[len(phrases) :]:
        for at in range(len(sequence) - MIN_MATCH + 1):
            runs.setdefault(tuple(sequence[at : at + MIN_MATCH]), []).append((which, at))
    return Scanner(automaton, labels, len(phrases), Lookup(keys), pairs, ends, sequences, runs)


_SPAN = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("coverage", T.DoubleType()),
    ]
)
_ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("license_spans", T.ArrayType(_SPAN)),
    ]
)
_ARROW_SPANS = pa.list_(
    pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())])
)


def scan(
    docs: DataFrame,
    keep: list[str] | None = None,
    text: str = "text",
    phrases=PHRASES,
    templates=TEMPLATES,
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row per input row: the ``keep`` columns (all by default), ``n_words``, ``n_base`` (places
    of phrases), ``first_word`` and ``last_word`` (their smallest and largest start, else null),
    ``base_labels``, ``labels`` (those of covered templates too), ``score`` (1 with a phrase, else
    the best coverage of a template) and ``license_spans`` (covered templates as word ranges; one
    interrupted by more than ``MAX_GAP`` words has a range for each part, with its whole coverage).

    Null and word-less texts have no words, empty labels and score 0. Overlapping places each
    count; templates covered several times are listed by their fullest, then first, chain only.
    A phrase of one word or a template of fewer than three is refused; without any, nothing is found.
    Columns named like an added one are replaced."""
    shipped = docs.sparkSession.sparkContext.broadcast(build_scanner(phrases, templates))

    def work(data, offsets):
        scanner = shipped.value
        words = tx.split_words(data, offsets, tx.NON_WORD)
        size = len(offsets) - 1
        places: dict[int, list] = {}
        longest: dict[int, list] = {}
        for first, tokens in scanner.streams(words):
            found, long = scanner.matches(first, tokens)
            if found or long:
                d = int(np.searchsorted(words.first, first, side="right")) - 1
                places.setdefault(d, []).extend(found)
                longest.setdefault(d, []).extend(long)
        out = {
            "n_words": words.counts.astype(np.int64),
            "n_base": np.zeros(size, np.int64),
            "first_word": [None] * size,
            "last_word": [None] * size,
            "base_labels": [""] * size,
            "labels": [""] * size,
            "score": np.zeros(size),
        }
        spans: list[list] = [[]] * size
        for d, found in places.items():
            origin = int(words.first[d])
            chains = scanner.chains(longest[d])
            base = {scanner.labels[p] for _, p in found}
            covered = [c for c in chains if c[3] >= coverage]
            if found:
                starts = [s - origin for s, _ in found]
                out["n_base"][d], out["first_word"][d], out["last_word"][d] = len(found), min(starts), max(starts)
            out["base_labels"][d] = ",".join(sorted(base))
            out["labels"][d] = ",".join(sorted(base | {c[0] for c in covered}))
            out["score"][d] = 1.0 if found else max((c[3] for c in chains), default=0.0)
            spans[d] = [{"label": c[0], "start": c[1] - origin, "end": c[2] - origin, "coverage": c[3]} for c in covered]
        return out | {
            "first_word": pa.array(out["first_word"], pa.int64()),
            "last_word": pa.array(out["last_word"], pa.int64()),
            "license_spans": pa.array(spans, _ARROW_SPANS),
        }

    return tx.map_texts(docs, docs.columns if keep is None else keep, _ADDED, work, text)
