"""Licence scans: matching statistics of a suffix automaton, chained into template spans.

One automaton accepts every run of words in any licence template. A file's words stream through
it and give, at each word, the longest run ending there that some template holds, with a place
in a template. Runs long enough are chained, in order and close together in both texts; what the
chains cover of a template decides whether its label is given. Fixed phrases are places of their
own and are always counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesmarts.llm import common

#: Words of the shortest run that is chained.
LEAST_RUN = 5
#: Words that two chained runs may be apart, in the file and in the template.
LARGEST_GAP = 12
#: Part of a template, or words of it, that its chains must cover for its label.
LEAST_COVER, LEAST_WORDS = 0.5, 25

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening or characteristic passages of public licence texts and notices.
TEMPLATES = {
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software."
    ),
    "apache-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form "
        "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies."
    ),
    "gpl-statement": "This work is licensed under the GNU General Public License, version 3.",
    "mit-statement": "Released under the MIT License.",
    "apache-statement": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-statement": "Licensed under CC BY-NC 4.0.",
    "cc-by-statement": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

# A-Z become a-z; ASCII that is neither letter nor digit separates words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c < 48 or 58 <= c <= 96 or 123 <= c <= 127 else c for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class SuffixAutomaton:
    """All runs of words of several texts, with for each state one place where its runs end."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.place = [-1], [0], [(-1, -1)]

    def _state(self, length: int, place: tuple[int, int], edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        self.place.append(place)
        return len(self.next) - 1

    def _split(self, source: int, word: int) -> int:
        """The target of source's edge, made to hold exactly the runs through that edge."""
        target, wanted = self.next[source][word], self.length[source] + 1
        if self.length[target] == wanted:
            return target
        shorter = self._state(wanted, self.place[target], dict(self.next[target]))
        self.link[shorter], self.link[target] = self.link[target], shorter
        while source >= 0 and self.next[source].get(word) == target:
            self.next[source][word] = shorter
            source = self.link[source]
        return shorter

    def add(self, text: int, words: list[int]) -> None:
        last = 0
        for at, word in enumerate(words):
            if word in self.next[last]:  # a run that an earlier text holds already
                last = self._split(last, word)
                continue
            new, source = self._state(self.length[last] + 1, (text, at), {}), last
            while source >= 0 and word not in self.next[source]:
                self.next[source][word] = new
                source = self.link[source]
            self.link[new] = self._split(source, word) if source >= 0 else 0
            last = new

    def statistics(self, words: list[int]) -> tuple[list[int], list[int]]:
        """Length of the longest known run that ends at each word, and its state."""
        state, size, sizes, states = 0, 0, [], []
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            sizes.append(size)
            states.append(state)
        return sizes, states


@dataclass
class Found:
    n_words: int
    places: list[tuple[int, str]]  # starts of phrases
    spans: list[tuple[int, int, str, float]]  # first and last word, template, part covered


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES):
        self.names = list(templates)
        self.ids: dict[bytes, int] = {}
        texts = [[self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(t.encode())] for t in templates.values()]
        self.texts = texts
        self.phrases = [
            ([self.ids.setdefault(w, len(self.ids) + 1) for w in p.encode().split()], label) for p, label in phrases.items()
        ]
        self.automaton = SuffixAutomaton()
        for k, words in enumerate(texts):
            self.automaton.add(k, words)
        self.holders = self._holders()
        self.shortest = min([LEAST_RUN, *map(len, texts)])

    def _holders(self) -> list[list[tuple[int, int]]]:
        """For each state every (template, end) of its runs."""
        ends: list[list[tuple[int, int]]] = [[] for _ in self.automaton.next]
        for k, words in enumerate(self.texts):
            for at, state in enumerate(self.automaton.statistics(words)[1]):
                while state > 0:
                    ends[state].append((k, at))
                    state = self.automaton.link[state]
        return ends

    def _ending(self, state: int, size: int) -> Iterator[tuple[int, int, int]]:
        """(template, end, words) of the longest match of every place of a template that ends here."""
        seen = set()
        while state > 0 and size >= self.shortest:
            for k, end in self.holders[state]:
                if (k, end) not in seen:
                    seen.add((k, end))
                    yield k, end, size
            state = self.automaton.link[state]
            size = self.automaton.length[state]

    def _runs(self, known: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of licence words at least as long as the shortest phrase."""
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known > 0, [0]))))
        long = edges[1::2] - edges[::2] >= 2
        return list(zip(edges[::2][long].tolist(), edges[1::2][long].tolist(), strict=True))

    def scan(self, text: bytes) -> Found:
        words = words_of(text)
        known = np.fromiter((self.ids.get(w, 0) for w in words), np.int32, len(words))
        places, matches = [], []
        for start, stop in self._runs(known):
            run = known[start:stop].tolist()
            for phrase, label in self.phrases:
                n = len(phrase)
                places += [(start + i, label) for i in range(len(run) - n + 1) if run[i : i + n] == phrase]
            if len(run) >= LEAST_RUN - 1:
                sizes, states = self.automaton.statistics(run)
                for i, size in enumerate(sizes):
                    following = run[i + 1] if i + 1 < len(run) else 0
                    for k, end, n in self._ending(states[i], size):
                        text = self.texts[k]
                        # Where the template itself goes on, a longer match of it ends later. A
                        # statement shorter than the shortest run must be there as a whole.
                        if (end + 1 == len(text) or text[end + 1] != following) and n >= min(LEAST_RUN, len(text)):
                            matches.append((k, start + i - n + 1, end - n + 1, n))
        return Found(len(words), sorted(places), self._chained(matches))

    def _chained(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, str, float]]:
        """Per template the chains of its matches that cover enough of it."""
        spans = []
        for k in sorted({m[0] for m in matches}):
            own = sorted((at, there, size) for t, at, there, size in matches if t == k)
            reach = LARGEST_GAP + max(size for _, _, size in own)
            best: list[tuple[int, int, int]] = []  # words covered, first word, previous match
            for i, (at, there, size) in enumerate(own):
                top = (size, at, -1)
                for j in range(i - 1, -1, -1):
                    a, t, n = own[j]
                    if at - a > reach:
                        break
                    overlap = max(0, a + n - at, t + n - there)
                    if overlap < size and a < at and t < there and at - a - n <= LARGEST_GAP and there - t - n <= LARGEST_GAP:
                        top = max(top, (best[j][0] + size - overlap, best[j][1], j))
                best.append(top)
            taken: list[tuple[int, int]] = []
            for i in sorted(range(len(own)), key=lambda i: -best[i][0]):
                covered, first = best[i][0], best[i][1]
                last = own[i][0] + own[i][2] - 1
                whole = len(self.texts[k])
                if covered < min(LEAST_WORDS, LEAST_COVER * whole) or any(a <= last and first <= b for a, b in taken):
                    continue
                taken.append((first, last))
                spans.append((first, last, self.names[k], min(1.0, covered / whole)))
        return sorted(spans)


_SCANNERS: list[Scanner] = []


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, spans.

    Words are stretches of ASCII letters and digits and of other characters, A-Z lower-cased.
    n_base counts all places of the fixed phrases, first_word and last_word are their smallest
    and largest start (null without one). labels adds those of templates of which enough is
    covered; ``spans`` lists them as "label:first-last". score is the largest part covered, at
    least 0.5 if a phrase is there. A null or empty text has no words, empty labels and score 0;
    repeated rows give equal rows; a null id stays null; other columns are not read.
    """

    def scored(block: pa.RecordBatch) -> list:
        if not _SCANNERS:
            _SCANNERS.append(Scanner())
        found = [_SCANNERS[0].scan(t) for t in common.utf8(block.column(1))]
        base = [sorted({label for _, label in f.places}) for f in found]
        more = [sorted({*b, *(s[2] for s in f.spans)}) for b, f in zip(base, found, strict=True)]
        return [
            block.column(0),
            [f.n_words for f in found],
            [len(f.places) for f in found],
            [f.places[0][0] if f.places else None for f in found],
            [f.places[-1][0] if f.places else None for f in found],
            [",".join(b) for b in base],
            [",".join(m) for m in more],
            [max([0.5 * bool(f.places), *(s[3] for s in f.spans)]) for f in found],
            [",".join(f"{s[2]}:{s[0]}-{s[1]}" for s in f.spans) for f in found],
        ]

    return common.per_text(
        common.texts_of(docs, id_col, text_col), scored,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double, spans string",
    )
