"""License scan with a generalised suffix automaton of licence tokens.

The tokens of all templates and phrases go into one automaton. A file's tokens
are streamed through it; after each token the automaton knows how many of the
last tokens stand together in some template (matching statistics). Long matches
are chained in template order, each at whichever of its places continues the
heaviest chain, and a chain that covers enough of a template is a licence span.
Of spans that lie half in one another the best covered ones count. Phrases are found by the same walk, at the states they end in.

Words that occur in no template, and neighbours that never stand together in
one, end a match; such positions are found on whole arrays, and only the runs
between them are walked.

Cases: a null or empty text has no word; repeated rows are scanned each; texts
of any length are walked in one pass with memory in proportion to their matches.
"""

from __future__ import annotations

import bisect
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from tallywell.llm.rows import map_texts

# Phrases that count as a licence notice by themselves, with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Openings and notices of public licences, with their labels.
TEMPLATES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software.""",
    "apache-2": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution.""",
    "bsd-3": """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "gpl-2": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version 2 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "lgpl": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the
        License, or (at your option) any later version. This library is distributed in the hope that it will be
        useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
        PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "agpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Affero General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU Affero General Public License for more details.""",
    "cc-by-4": """This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy
        of this license, visit http://creativecommons.org/licenses/by/4.0/.""",
    "cc-by-sa-4": """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.
        To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/.""",
    "mpl-2": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means.""",
}

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Tokens of a match that may be chained, tokens between two matches of a chain, share of a template to be covered.
LONG_MATCH, MAX_GAP, MIN_COVER = 5, 40, 0.5


def words_of(text: str) -> list[bytes]:
    """Words of the text with A-Z in lower case."""
    return WORD.findall(text.encode().lower())


@dataclass
class Span:
    label: str
    start: int
    end: int
    cover: float


@dataclass
class Found:
    words: int = 0
    phrases: list[tuple[int, str]] = field(default_factory=list)
    spans: list[Span] = field(default_factory=list)


class SuffixAutomaton:
    """Generalised suffix automaton of token rows, grown token by token."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]

    def _state(self, length, link, edges) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, p: int, token: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, token: int) -> int:
        q = self.next[last].get(token)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, token, q)
        here, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = here
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[here] = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q)
        return here

    def add(self, row: int, tokens: list[int]) -> None:
        last = 0
        for place, token in enumerate(tokens):
            last = self._extend(last, token)
            self.ends[last].append((row, place))

    def close(self) -> None:
        """Give every state all places (row, last token) at which its strings end."""
        for s in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            self.ends[self.link[s]] = list(set(self.ends[self.link[s]]) | set(self.ends[s])) if self.link[s] else []


class LicenseScanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        rows = [(label, words_of(text), True) for text, label in phrases.items()]
        rows += [(label, words_of(text), False) for label, text in templates.items()]
        self.labels = [label for label, _, _ in rows]
        self.sizes = [len(w) for _, w, _ in rows]
        self.is_phrase = [p for _, _, p in rows]
        self.ids = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for _, row, _ in rows for w in row))}
        self.automaton = SuffixAutomaton()
        self.pairs = np.zeros((len(self.ids) + 1,) * 2, bool)
        for k, (_, row, _) in enumerate(rows):
            ids = [self.ids[w] for w in row]
            self.automaton.add(k, ids)
            self.pairs[ids[:-1], ids[1:]] = True
        self.automaton.close()
        # Per state, the phrases (row, length) that end in it and the places of the other rows.
        self.stops, self.places = [], []
        for s, ends in enumerate(self.automaton.ends):
            whole = {k for k, at in ends if self.is_phrase[k] and at == self.sizes[k] - 1}
            self.stops.append([(self.sizes[k], k) for k in sorted(whole)])
            self.places.append(sorted(e for e in ends if not self.is_phrase[e[0]]))
        self.shortest = min([LONG_MATCH, *[n for n, p in zip(self.sizes, self.is_phrase) if p]])

    def scan(self, text: str) -> Found:
        words = words_of(text)
        found = Found(len(words))
        if len(words) < self.shortest:
            return found
        get = self.ids.get
        ids = np.fromiter([get(w, 0) for w in words], np.int32, len(words))
        # Runs in which every two neighbours stand together in some template.
        linked = np.concatenate(([False], self.pairs[ids[:-1], ids[1:]], [False])).view(np.int8)
        change = np.flatnonzero(np.diff(linked))
        starts, stops = change[::2], change[1::2] + 1
        matches: list[tuple[int, int, int, int]] = []
        for a, b in zip(starts.tolist(), stops.tolist()):
            if b - a >= self.shortest:
                self._walk(ids[a:b].tolist(), a, found, matches)
        self._chain(matches, found)
        return found

    def _walk(self, run: list[int], base: int, found: Found, matches: list) -> None:
        auto, state, size = self.automaton, 0, 0
        for i, token in enumerate(run):
            before, held = state, size
            while state and token not in auto.next[state]:
                state = auto.link[state]
                size = auto.length[state]
            if held >= LONG_MATCH and size < held:
                self._note(before, held, base + i, matches)
            if token in auto.next[state]:
                state, size = auto.next[state][token], size + 1
            at = state
            while at > 0:
                for length, k in self.stops[at]:
                    if length <= size and (at == state or length <= auto.length[at]) and length > auto.length[auto.link[at]]:
                        found.phrases.append((base + i + 1 - length, self.labels[k]))
                at = auto.link[at]
        if size >= LONG_MATCH:
            self._note(state, size, base + len(run), matches)

    def _note(self, state: int, size: int, end: int, matches: list) -> None:
        """A match that could not be made longer: words [end - size, end) at its places in the templates."""
        for row, at in self.places[state]:
            matches.append((row, end - size, at + 1 - size, size))

    def _chain(self, matches: list, found: Found) -> None:
        """The heaviest chains of matches that follow each other in text and template order, of each template."""
        rows: dict[int, list] = {}
        for row, start, place, size in sorted(set(matches)):
            rows.setdefault(row, []).append((start, place, size))
        spans = [span for row, own in rows.items() for span in self._heaviest(row, own)]
        # Licences share wording: of spans that lie half in one another only the best covered ones are notices.
        kept: dict[int, list[Span]] = {}
        for span in sorted(spans, key=lambda s: (-s.cover, s.start, s.label)):
            near = range(span.start // 256, span.end // 256 + 1)
            if all(k.cover == span.cover or 2 * (min(k.end, span.end) - max(k.start, span.start)) < span.end - span.start
                   for b in near for k in kept.get(b, ())):
                found.spans.append(span)
                for b in near:
                    kept.setdefault(b, []).append(span)

    def _heaviest(self, row: int, own: list[tuple[int, int, int]]) -> list[Span]:
        """A match may have several places in a template: each is tried behind every chain that ends shortly before."""
        ends: list[tuple[int, int, int, int]] = []  # words covered, first word, behind the last word, behind the last place
        near = 0
        for k, (start, place, size) in enumerate(own):
            best = (size, start, start + size, place + size)
            while near < k and own[near][0] + own[near][2] < start - MAX_GAP:
                near += 1
            for covered, first, last, reached in ends[near:k]:
                overlap = max(0, last - start, reached - place)
                if start - last <= MAX_GAP and overlap < size and place + size > reached and start + size > last:
                    best = max(best, (covered + size - overlap, first, start + size, place + size))
            ends.append(best)
        spans: list[Span] = []
        taken: list[tuple[int, int]] = []  # in order
        for covered, first, last, _ in sorted(ends, key=lambda e: (-e[0], e[1])):
            share = covered / self.sizes[row]
            if share < MIN_COVER:
                break
            at = bisect.bisect(taken, (first, last))
            if (at and taken[at - 1][1] > first) or (at < len(taken) and taken[at][0] < last):
                continue
            taken.insert(at, (first, last))
            spans.append(Span(self.labels[row], first, last, min(1.0, share)))
        return spans


def scan_licenses(df: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence notices of every whole text.

    ``id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``: places of the phrases,
    smallest and largest start (null without one), labels of the phrases and of everything found, the largest
    covered share of a template (1 for a phrase), and the covered template spans as ``label:start-end``.
    """
    scanner = LicenseScanner(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)

    def work(texts):
        rows = []
        for found in map(scanner.scan, texts):
            places = [p for p, _ in found.phrases]
            base = {label for _, label in found.phrases}
            every = base | {s.label for s in found.spans}
            rows.append((found.words, len(places), min(places, default=None), max(places, default=None),
                         ",".join(sorted(base)), ",".join(sorted(every)),
                         1.0 if base else max((s.cover for s in found.spans), default=0.0),
                         " ".join(f"{s.label}:{s.start}-{s.end}" for s in sorted(found.spans, key=lambda s: (s.start, s.label)))))
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(8)]

    return map_texts(df, work, [("n_words", "long"), ("n_base", "long"), ("first_word", "long"), ("last_word", "long"),
                                ("base_labels", "string"), ("labels", "string"), ("score", "double"),
                                ("spans", "string")], id_col, text_col)
