"""License scans: matching statistics against an automaton of license texts.

All templates, as token sequences, go into one generalised suffix automaton. A
text is streamed through it once: after each word the automaton's state and
length give the longest run of words, ending there, that occurs in any template
(the matching statistics). Runs that can't be made longer are matches. Those of
``SHORTEST`` words or more are chained for each template: matches in the same
order in text and template, with at most ``GAP`` words between them, cover a
span. A chain that covers enough of its template labels the text, unless it lies
within a span of another label that covers more words (a notice of the LGPL holds
nearly all of one of the GPL).

Base phrases are templates that must match whole; every place counts. They are
read off the same states: a state knows the phrases that end there.

The words of a text are its runs of digits, letters (A-Z in lower case) and
non-ASCII characters. Words of no template reset the automaton, so streaming
takes constant memory beyond the words themselves.

Chains are kept for as long as their template, and those chosen are found by
bisection, so the work grows with the words, also of very long and repetitive
texts. Defined results: null and empty texts have no words, no labels and score
0; repeated rows, also with null ids, each get their row; of equal chains the
first one stays; an empty table has an empty result; columns other than the id
and the text aren't read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from siltstone.llm.arrow_text import Block, map_blocks

SHORTEST, GAP = 3, 8
#: Share of a template that a chain must cover.
COVERED = 0.75

# Phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices by label, as their authors ask to use them.
TEMPLATES = (
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
    ),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    ),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation",
    ),
    (
        "gpl",
        "this program is distributed in the hope that it will be useful but without any warranty without even the "
        "implied warranty of merchantability or fitness for a particular purpose see the gnu general public license "
        "for more details",
    ),
    (
        "lgpl",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
        "published by the free software foundation",
    ),
    (
        "agpl",
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as "
        "published by the free software foundation",
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
        "not distributed with this file you can obtain one at",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify "
        "publish use compile sell or distribute this software",
    ),
    (
        "cc0-1.0",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to "
        "this work",
    ),
    ("bsl-1.0", "distributed under the boost software license version 1 0"),
    (
        "mit",
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software",
    ),
    (
        "apache-2.0",
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
    ),
    (
        "bsd-3-clause",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ),
)

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
    for b in range(256)
)


def text_words(data: bytes) -> list[bytes]:
    """The words of UTF-8 bytes, A-Z in lower case."""
    return data.translate(_WORD_BYTES).split()


@dataclass
class Automaton:
    """Suffix automaton of several token sequences."""

    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])

    def add(self, sequence: list[int], number: int) -> None:
        last = 0
        for place, token in enumerate(sequence):
            last = self._extend(last, token)
            self.ends[last].append((number, place + 1))

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, state: int, token: int, target: int) -> int:
        """A state for the strings of ``target`` that ``state`` plus ``token`` ends in."""
        part = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = part
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = part
            state = self.link[state]
        return part

    def _extend(self, last: int, token: int) -> int:
        target = self.next[last].get(token)
        if target is not None:
            fits = self.length[target] == self.length[last] + 1
            return target if fits else self._split(last, token, target)
        new = self._new(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][token]
            fits = self.length[target] == self.length[state] + 1
            self.link[new] = target if fits else self._split(state, token, target)
        return new

    def finish(self) -> None:
        """Hand the ends of longer strings to their suffixes."""
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            above = self.link[state]
            if above > 0:
                self.ends[above] = sorted({*self.ends[above], *self.ends[state]})


@dataclass(frozen=True)
class Span:
    """A chain of matches: words first:last of the text, and how much of the template it covers."""

    label: str
    first: int
    last: int
    covered: float
    words: int


class Scanner:
    def __init__(self, templates=TEMPLATES, base=BASE) -> None:
        phrases = list(base)
        texts = [*phrases, *(text for _, text in templates)]
        self.labels = [*base.values(), *(label for label, _ in templates)]
        self.base = len(phrases)
        self.vocabulary: dict[bytes, int] = {}
        sequences = [
            [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in text_words(t.encode())] for t in texts
        ]
        self.sizes = [len(s) for s in sequences]
        self.automaton = Automaton()
        for number, sequence in enumerate(sequences):
            self.automaton.add(sequence, number)
        self.automaton.finish()
        # Phrases that end in a state: all of a phrase's words, up to its end.
        a = self.automaton
        self.phrases_at: list[tuple[int, ...]] = [()] * len(a.next)
        for state in sorted(range(1, len(a.next)), key=lambda s: a.length[s]):
            above = a.link[state]
            shortest = a.length[above] + 1
            own = [
                n
                for n, end in a.ends[state]
                if n < self.base and end == self.sizes[n] and shortest <= self.sizes[n] <= a.length[state]
            ]
            self.phrases_at[state] = (*own, *(self.phrases_at[above] if above > 0 else ()))

    def statistics(self, words: list[bytes]):
        """(place, state, length) after each word that is in a template."""
        get, follow, link, size = self.vocabulary.get, self.automaton.next, self.automaton.link, self.automaton.length
        state = length = 0
        previous = -2
        for place, word in enumerate(words):
            token = get(word)
            if token is None:
                continue
            if place != previous + 1:
                state = length = 0
            previous = place
            target = follow[state].get(token)
            while target is None and state:
                state = link[state]
                length = size[state]
                target = follow[state].get(token)
            if target is None:
                continue
            state, length = target, length + 1
            yield place, state, length

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[Span]]:
        """(phrase, first word) of every base place, and the covered spans."""
        places: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int]] = []
        before = (-2, 0, 0)
        for found in self.statistics(words):
            place, state, length = found
            if before[2] >= SHORTEST and not (place == before[0] + 1 and length == before[2] + 1):
                matches.append(before)
            for n in self.phrases_at[state]:
                if self.sizes[n] <= length:
                    places.append((n, place + 1 - self.sizes[n]))
            before = found
        if before[2] >= SHORTEST:
            matches.append(before)
        return places, self._chains(matches)

    def _chains(self, matches: list[tuple[int, int, int]]) -> list[Span]:
        spans: list[Span] = []
        # For each template its open chains: first word, last word, end in the template, words covered.
        open_: dict[int, list[tuple[int, int, int, int]]] = {}
        for place, state, length in matches:
            last = place + 1
            for n, end in self.automaton.ends[state]:
                if n < self.base:
                    continue
                chains = open_.setdefault(n, [])
                best = (last - length, last, end, length)
                for first, stop, at, covered in chains:
                    # An overlap counts once, in the text and in the template.
                    cut = max(0, stop - (last - length), at - (end - length))
                    near = last - length - stop <= GAP and end - length - at <= GAP
                    if near and at < end and cut < length and covered + length - cut > best[3]:
                        best = (first, last, end, covered + length - cut)
                open_[n] = [c for c in chains if last - c[1] <= GAP + self.sizes[n]] + [best]
                share = min(1.0, best[3] / self.sizes[n])
                spans.append(Span(self.labels[n], best[0], best[1], share, best[3]))
        return spans


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


def _document(s: Scanner, data: bytes) -> tuple:
    words = text_words(data)
    places, spans = s.scan(words)
    base = sorted({s.labels[n] for n, _ in places})
    chosen = best_spans(spans)
    labels = sorted({*base, *(x["label"] for x in chosen)})
    starts = [first for _, first in places]
    score = 1.0 if places else max((x.covered for x in spans), default=0.0)
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(base),
        ",".join(labels),
        score,
        chosen,
    )


def best_spans(spans: list[Span]) -> list[dict]:
    """Of spans that overlap under one label the one that covers most, but none within a larger one of another."""
    # Chosen spans of a label don't overlap, so only the neighbours of a place matter.
    chosen: dict[str, list[tuple[int, int]]] = {}
    by_place: dict[tuple[str, int], Span] = {}
    for x in sorted((x for x in spans if x.covered >= COVERED), key=lambda x: (-x.covered, x.first, x.last, x.label)):
        taken = chosen.setdefault(x.label, [])
        at = bisect_left(taken, (x.first, x.last))
        if (at == 0 or taken[at - 1][1] <= x.first) and (at == len(taken) or x.last <= taken[at][0]):
            insort(taken, (x.first, x.last))
            by_place[x.label, x.first] = x

    def within_another(x: Span) -> bool:
        for label, taken in chosen.items():
            at = bisect_right(taken, (x.first, float("inf"))) - 1
            if label != x.label and at >= 0 and taken[at][1] >= x.last:
                if by_place[label, taken[at][0]].words > x.words:
                    return True
        return False

    return [
        {"label": x.label, "first_word": x.first, "last_word": x.last - 1, "covered": x.covered}
        for x in sorted(by_place.values(), key=lambda x: (x.first, x.label))
        if not within_another(x)
    ]


_SPAN = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("covered", T.DoubleType()),
    ]
)
_ARROW_SPAN = pa.struct(
    [("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.float64())]
)


def scan(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: words, base places, labels, score and covered spans."""
    fields = [
        ("n_words", T.LongType(), pa.int64()),
        ("n_base", T.LongType(), pa.int64()),
        ("first_word", T.LongType(), pa.int64()),
        ("last_word", T.LongType(), pa.int64()),
        ("base_labels", T.StringType(), pa.string()),
        ("labels", T.StringType(), pa.string()),
        ("score", T.DoubleType(), pa.float64()),
        ("spans", T.ArrayType(_SPAN), pa.list_(_ARROW_SPAN)),
    ]

    def run(block: Block) -> pa.RecordBatch:
        s, raw = scanner(), memoryview(block.data.tobytes())
        found = [
            _document(s, bytes(raw[a:b])) for a, b in zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist(), strict=True)
        ]
        columns = [pa.array(c, kind) for c, (_, _, kind) in zip(zip(*found, strict=True), fields, strict=True)]
        return pa.record_batch([block.rows.column(0), *columns], [id_col, *(n for n, _, _ in fields)])

    schema = T.StructType(
        [T.StructField(id_col, df.schema[id_col].dataType), *(T.StructField(n, kind) for n, kind, _ in fields)]
    )
    return map_blocks(df.select(id_col, text), run, schema, text)
