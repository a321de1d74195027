"""Licence scan: matching statistics in a suffix automaton of licence texts, chained into spans."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spans_of, text_bytes

# The phrases that always count.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Notices by which files name or quote their licence.
TEMPLATES = {
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    "gpl-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ],
    "bsd-2-clause": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
    "cc-by-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0."],
    "reserved": ["All rights reserved."],
}

#: Words of a match that may be part of a chain, unless it is a whole template; words of a text
#: between two matches of a chain; share of a template that a chain must cover.
LEAST_MATCH = 4
MOST_GAP = 8
LEAST_COVER = 0.75

_KEEP = bytes(
    c if c >= 0x80 or chr(c).isdigit() or chr(c).isalpha() else 0x20 for c in range(256)
).lower()


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), digits and bytes beyond ASCII."""
    return text.translate(_KEEP).split()


@dataclass
class Automaton:
    """The generalised suffix automaton of some sequences of word numbers.

    Each state stands for the strings that end at the same places; ``length`` is its longest,
    ``link`` the state of the longest suffix that ends at other places too, ``ends`` its places as
    (sequence, index of the last word).
    """

    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.step) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The state of the longest string that leads by ``word`` to q from p and its links."""
        if self.length[p] + 1 == self.length[q]:
            return q
        copy = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.ends[copy] = list(self.ends[q])
        self.link[q] = copy
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, sequence: list[int], number: int) -> None:
        at = 0
        for word in sequence:
            if word in self.step[at]:
                at = self._split(at, word, self.step[at][word])
                continue
            new, p = self._state(self.length[at] + 1, {}, 0), at
            while p >= 0 and word not in self.step[p]:
                self.step[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, word, self.step[p][word])
            at = new
        at = 0
        for index, word in enumerate(sequence):
            at = self.step[at][word]
            state = at
            while state > 0:
                self.ends[state].append((number, index))
                state = self.link[state]

    def parts(self, sizes: list[int], least: int) -> list[list[tuple[int, int, list[int], int]]]:
        """For each state (sequence, length, last indices, least length) of its longest suffix in each.

        Suffixes shorter than ``least`` words, or than the whole sequence, are left out.  A suffix
        that other sequences end longer ones with is found over the links.
        """
        out: list[list[tuple[int, int, list[int], int]]] = []
        needed = [min(least, n) for n in sizes]
        for state in range(len(self.step)):
            seen: dict[int, tuple[int, list[int]]] = {}
            at = state
            while at > 0:
                here: dict[int, list[int]] = {}
                for sequence, last in self.ends[at]:
                    here.setdefault(sequence, []).append(last)
                for sequence, lasts in here.items():
                    seen.setdefault(sequence, (self.length[at], lasts))
                at = self.link[at]
            out.append([
                (k, size, lasts, needed[k]) for k, (size, lasts) in seen.items() if size >= needed[k]
            ])
        return out

    def matches(self, words: list[int], parts) -> dict[int, list[tuple[int, int, int]]]:
        """(start, place in the sequence, length) of all matches of each sequence, by their ends.

        Matching statistics: after each word, for every sequence, the longest string that ends here
        and is in it.  One that the next word does not make longer is a match.
        """
        out: dict[int, list[tuple[int, int, int]]] = {}
        now: dict[int, tuple[int, list[int]]] = {}
        state = held = 0
        for index, word in enumerate([*words, -1]):
            while state and word not in self.step[state]:
                state = self.link[state]
                held = self.length[state]
            if word in self.step[state]:
                state, held = self.step[state][word], held + 1
            else:
                state = held = 0
            after = {
                k: (min(size, held), lasts) for k, size, lasts, need in parts[state] if held >= need
            }
            for k, (size, lasts) in now.items():
                if k not in after or after[k][0] != size + 1:
                    out.setdefault(k, []).extend((index - size, last - size + 1, size) for last in lasts)
            now = after
        return out


def _best_chain(found: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """Covered words, start and end of the best chain of matches (start, place, size), given by ends."""
    best = []  # covered words, start of the chain
    for k, (start, place, size) in enumerate(found):
        covered, begin = size, start
        for j in range(k - 1, -1, -1):
            s, p, n = found[j]
            if start - (s + n) > MOST_GAP:
                break
            over = max(0, s + n - start, p + n - place)
            if s < start and p < place and over < size and best[j][0] + size - over > covered:
                covered, begin = best[j][0] + size - over, best[j][1]
        best.append((covered, begin))
    covered, begin, end = max((c, -b, s + n) for (c, b), (s, _, n) in zip(best, found, strict=True))
    return covered, -begin, end


@dataclass
class LicenseIndex:
    """The automaton of all templates, their labels, and the numbers of their words."""

    templates: Mapping[str, list[str]] = field(default_factory=lambda: TEMPLATES)
    phrases: Mapping[str, str] = field(default_factory=lambda: PHRASES)

    def __post_init__(self):
        self.number: dict[bytes, int] = {}
        self.automaton, self.labels, self.sizes = Automaton(), [], []
        for label, texts in self.templates.items():
            for text in texts:
                words = [self._number(w) for w in words_of(text.encode())]
                self.automaton.add(words, len(self.labels))
                self.labels.append(label)
                self.sizes.append(len(words))
        self.parts = self.automaton.parts(self.sizes, LEAST_MATCH)
        self.fixed = [
            ([self._number(w) for w in words_of(p.encode())], label)
            for p, label in self.phrases.items()
        ]

    def _number(self, word: bytes) -> int:
        return self.number.setdefault(word, len(self.number))

    def chains(self, words: list[int], offset: int) -> list[tuple[int, int, int, float]]:
        """(start, end, template, cover) of chains of matches in a run of known words.

        Of each template the chain that covers most of it, the first of equal ones; then the best
        before it and the best after it, and so on: chains of one template do not overlap.
        """
        out = []
        for template, found in self.automaton.matches(words, self.parts).items():
            size, last = self.sizes[template], -MOST_GAP - 1
            near: list[list[tuple[int, int, int]]] = []  # chains lie within such a group
            for match in found:  # by their ends
                if match[2] < min(LEAST_MATCH, size):
                    continue
                if match[0] - last > MOST_GAP:
                    near.append([])
                near[-1].append(match)
                last = match[0] + match[2]
            while near:
                group = near.pop()
                covered, begin, end = _best_chain(group)
                if covered < LEAST_COVER * size:
                    continue
                out.append((offset + begin, offset + end, template, min(1.0, covered / size)))
                for rest in ([m for m in group if m[0] + m[2] <= begin], [m for m in group if m[0] >= end]):
                    if rest:
                        near.append(rest)
        return out

    def scan(self, text: bytes) -> dict:
        """Number of words, places of the fixed phrases, and spans of covered templates."""
        words = words_of(text)
        ids = np.fromiter(
            (self.number.get(w, -1) for w in words), dtype=np.int64, count=len(words)
        )
        places = []
        for phrase, label in self.fixed:
            hit = np.ones(max(len(ids) - len(phrase) + 1, 0), dtype=bool)
            for k, word in enumerate(phrase):
                hit &= ids[k:k + len(hit)] == word
            places += [(int(p), label) for p in np.flatnonzero(hit)]
        # Words that no template has end every match, and a gap of a chain is bounded.
        starts, ends = spans_of(ids >= 0)
        long = ends - starts >= min([LEAST_MATCH, *self.sizes])
        spans = []
        if long.any():
            starts, ends = starts[long], ends[long]
            joined = np.flatnonzero(np.concatenate(([True], starts[1:] - ends[:-1] > MOST_GAP)))
            for a, b in zip(joined, [*joined[1:], len(starts)], strict=True):
                first, last = int(starts[a]), int(ends[b - 1])
                spans += self.chains(ids[first:last].tolist(), first)
        return {
            "n_words": len(words),
            "places": [{"word": p, "label": label} for p, label in sorted(places)],
            "spans": [
                {"start": a, "end": b, "label": self.labels[t], "cover": c}
                for a, b, t, c in sorted(spans)
            ],
        }


def _scan(index: LicenseIndex, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                found = [index.scan(t) for t in text_bytes(part.column(1))]
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    *[pa.array([x[name] for x in found], schema.field(name).type)
                      for name in ("n_words", "places", "spans")],
                ], schema=schema)

    return run


def find_licenses(
    docs: DataFrame, index: LicenseIndex | None = None, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: id, n_words, places (word, label) and spans (start, end, label, cover).

    Places are where the words of a fixed phrase stand one after the other; they may overlap.  Spans
    are where matches of at least ``LEAST_MATCH`` words with a template, in its order and at most
    ``MOST_GAP`` words apart, cover ``LEAST_COVER`` of it: all that do not overlap, best ones first;
    templates in others are found too.  Words are counted from 0.  Null and empty texts have no words; rows of equal or null ids
    are scanned each for itself; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = docs.sparkSession.createDataFrame(
        [], f"id {kind}, n_words bigint, places array<struct<word:bigint,label:string>>, "
            f"spans array<struct<start:bigint,end:bigint,label:string,cover:double>>"
    ).schema
    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(
        _scan(index or LicenseIndex(), to_arrow_schema(schema)), schema
    )
