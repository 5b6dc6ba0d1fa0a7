"""License scans: matching statistics of whole texts against an automaton of license wording.

A generalised suffix automaton over the words of all templates reads a text word by word and knows at each word the
longest stretch ending there that some template contains. Long stretches are chained per template, in order in both;
a template whose words a chain covers well enough gives its label. The automaton has the size of the templates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from labelloom.llm import textops

SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"  # after lower-casing

# Phrases whose every place counts, with their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Wording of common license notices, as published by their stewards.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "licensed under the GNU General Public License, version 2"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
]

MIN_MATCH = 4  # words of a stretch that may enter a chain
MAX_GAP = 12  # text words between two stretches of one chain
MIN_COVER = 0.8  # share of the template's words that the chain has to cover


def template_words(text: str) -> list[str]:
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


@dataclass
class Automaton:
    """Generalised suffix automaton of several word-id sequences; one set of ends (template, position) per state."""

    following: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[set[tuple[int, int]]] = field(default_factory=lambda: [set()])

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.following.append(following), self.link.append(link), self.length.append(length), self.ends.append(set())
        return len(self.length) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """A copy of q for the shorter strings that p reaches it by."""
        copy = self._state(self.length[p] + 1, dict(self.following[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.following[p].get(word) == q:
            self.following[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if (q := self.following[last].get(word)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and word not in self.following[p]:
            self.following[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.following[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def add(self, sequences: list[list[int]]) -> None:
        for sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        for number, sequence in enumerate(sequences):
            state = 0
            for at, word in enumerate(sequence):
                state = self.following[state][word]
                up = state
                while up > 0 and (number, at) not in self.ends[up]:
                    self.ends[up].add((number, at))
                    up = self.link[up]

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """The longest stretch that ends with ``word``: (state, words matched)."""
        while state and word not in self.following[state]:
            state = self.link[state]
            matched = self.length[state]
        found = self.following[state].get(word)
        return (0, 0) if found is None else (found, matched + 1)


class Scanner:
    """The automaton with its vocabulary, templates and phrases; built once and sent to the tasks."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        every = [(label, template_words(text), False) for label, text in templates]
        every += [(label, template_words(text), True) for text, label in phrases.items()]
        self.labels, self.sizes = [x[0] for x in every], [len(x[1]) for x in every]
        self.is_phrase = [x[2] for x in every]
        vocabulary = sorted({w for _, ws, _ in every for w in ws})
        hashes = word_hashes(vocabulary)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        ids = {vocabulary[k]: i for i, k in enumerate(order)}
        self.automaton = Automaton()
        self.automaton.add([[ids[w] for w in ws] for _, ws, _ in every])
        # Which phrases end where a state ends: those that end in the state or, as shorter suffixes, behind its links.
        own = [[t for t, at in ends if self.is_phrase[t] and at == self.sizes[t] - 1] for ends in self.automaton.ends]
        self.phrase_ends = []
        for state in range(len(own)):
            found: set[int] = set()
            while state > 0:
                found.update(t for t in own[state] if self.automaton.length[state] >= self.sizes[t])
                state = self.automaton.link[state]
            self.phrase_ends.append(sorted(found))

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def stretch(self, ids: list[int], first: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """Read consecutive known words: (start, phrase) places, and (end, words, state) of stretches that stop growing."""
        places, long = [], []
        state = matched = 0
        for k, word in enumerate(ids):
            before = (first + k - 1, matched, state)
            state, matched = self.automaton.step(state, matched, word)
            if matched <= before[1] and before[1] >= MIN_MATCH:
                long.append(before)
            for t in self.phrase_ends[state]:
                if matched >= self.sizes[t]:
                    places.append((first + k - self.sizes[t] + 1, t))
        if matched >= MIN_MATCH:
            long.append((first + len(ids) - 1, matched, state))
        return places, long

    def chains(self, long: list[tuple[int, int, int]]) -> list[tuple[int, float, int, int]]:
        """(template, share covered, first word, last word) of the best chain of each template that matches."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for end, words, state in long:
            for t, at in self.automaton.ends[state]:
                if not self.is_phrase[t] and at + 1 >= words:
                    by_template.setdefault(t, []).append((end - words + 1, at - words + 1, words))
        found = []
        for t, matches in by_template.items():
            matches.sort()
            best: list[tuple[int, int]] = []  # covered words and first text word of the best chain that ends with a match
            for i, (start, at, words) in enumerate(matches):
                cover, first = words, start
                for j in range(i - 1, -1, -1):
                    s, a, w = matches[j]
                    if start - s > MAX_GAP + self.sizes[t]:
                        break
                    if s + w <= start and a + w <= at and start - s - w <= MAX_GAP and best[j][0] + words > cover:
                        cover, first = best[j][0] + words, best[j][1]
                best.append((cover, first))
            k = max(range(len(best)), key=lambda i: best[i][0])
            found.append((t, best[k][0] / self.sizes[t], best[k][1], matches[k][0] + matches[k][2] - 1))
        return found


def word_hashes(words: list[str]) -> np.ndarray:
    column = pa.array(words, pa.string())
    data, offsets = textops.text_bytes(column)
    return textops.words(data, offsets, 0, len(words), textops.byte_table(SEPARATORS_RAW))[3]


# The same separators before lower-casing: A-Z are letters then.
SEPARATORS_RAW = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


def scan_licenses(docs: DataFrame, text_col: str = "text", templates: list[tuple[str, str]] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """Add what the scan finds to every row of ``docs``.

    n_words, n_base (places of phrases), first_word and last_word (their smallest and largest start, else null),
    base_labels and labels (distinct, sorted, comma-joined; "" without any), score (1 with a phrase, else the largest
    share of a template that a chain covers), spans (label, start, end, cover of each covered template, in words).
    A null text counts as empty: no words, no labels, score 0. Words are A-Z lower-cased and told apart by 64-bit
    hashes. Columns of these names are replaced, others pass unchanged; every row is judged alone.
    """
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(TEMPLATES if templates is None else templates, BASE_PHRASES if phrases is None else phrases))
    new = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    docs = docs.drop(*new)
    names = docs.columns
    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())])
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
    ddl = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,start:long,end:long,cover:double>>"
    schema = StructType([*docs.schema, *docs.sparkSession.createDataFrame([], ddl).schema])
    table = textops.byte_table(SEPARATORS_RAW)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scanner.value
        shortest = min([MIN_MATCH, *[n for n, p in zip(s.sizes, s.is_phrase, strict=True) if p]])
        for batch in batches:
            data, offsets = textops.text_bytes(batch.column(text_col))
            out = []
            for lo, hi in textops.pieces(offsets):
                row, _, _, hashes = textops.words(data, offsets, lo, hi, table)
                n = np.bincount(row, minlength=hi - lo)
                heads = np.cumsum(n) - n
                ids = s.word_ids(hashes)
                rel = np.r_[heads, len(row)]
                where, start, end = textops.runs((ids >= 0).view(np.uint8), rel)
                long_enough = end - start >= shortest
                places: dict[int, list] = {}
                stretches: dict[int, list] = {}
                for r, x, y in zip(where[long_enough].tolist(), start[long_enough].tolist(), end[long_enough].tolist(), strict=True):
                    p, m = s.stretch(ids[x:y].tolist(), x - int(heads[r]))
                    if p:
                        places.setdefault(r, []).extend(p)
                    if m:
                        stretches.setdefault(r, []).extend(m)
                for r in range(hi - lo):
                    at = places.get(r, [])
                    chains = s.chains(stretches[r]) if r in stretches else []
                    base = {s.labels[t] for _, t in at}
                    good = [c for c in chains if c[1] >= MIN_COVER]
                    labels = base | {s.labels[c[0]] for c in good}
                    starts = [x for x, _ in at]
                    score = 1.0 if base else max([0.0, *[min(c[1], 1.0) for c in chains]])
                    spans = [{"label": s.labels[t], "start": a, "end": b, "cover": c} for t, c, a, b in sorted(good, key=lambda c: c[2:])]
                    out.append((int(n[r]), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, spans))
            columns = [pa.array([o[k] for o in out], t) for k, t in enumerate(types)]
            yield pa.record_batch([*batch.columns, *columns], names=[*names, *new])

    return docs.mapInArrow(scan, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The columns that downstream tables keep, without texts and spans."""
    return scan_licenses(docs.select("doc_id", "text")).drop("text", "spans")
