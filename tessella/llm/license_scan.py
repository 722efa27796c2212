"""Licence scan with a generalised suffix automaton of licence templates.

The automaton holds every run of words of every template. A text is streamed through it word by word;
the matching statistics (the longest run ending at each word that some template has) give maximal
matches, and matches that follow each other in the text and in a template are chained into spans.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.textkit import LOWER, pieces, span_hashes, text_bytes, words

#: Phrases whose places are counted, and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Wording of common licence notices.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

#: Shortest match that counts, largest gap in a chain, and the share of a template to be covered.
MIN_MATCH, MAX_GAP, MIN_COVER = 3, 5, 0.8

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,start:long,end:long,covered:double>>"
)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[data]
    starts, ends, first = words(data, offsets, WORD)
    return span_hashes(data, starts, ends), first


def _of(text: str) -> list[int]:
    data = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(data, np.array([0, len(data)]))[0].tolist()


class SuffixAutomaton:
    """The smallest automaton of all runs of words of several token lists."""

    def __init__(self, lists: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: (list, end) of the occurrences first seen in a state.
        self.ends: list[list[tuple[int, int]]] = [[]]
        for number, tokens in enumerate(lists):
            last = 0
            for place, token in enumerate(tokens):
                last = self._extend(last, token)
                self.ends[last].append((number, place + 1))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]] = sorted(set(self.ends[self.link[state]]) | set(self.ends[state]))

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.link) - 1

    def _split(self, state: int, token: int, target: int) -> int:
        """A state for the shorter runs of `target` that `state` reaches."""
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, token: int) -> int:
        target = self.next[last].get(token)
        if target is not None:  # an earlier list has this run already
            return target if self.length[target] == self.length[last] + 1 else self._split(last, token, target)
        new, state = self._state(self.length[last] + 1, 0, {}), last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][token]
            exact = self.length[target] == self.length[state] + 1
            self.link[new] = target if exact else self._split(state, token, target)
        return new

    def statistics(self, tokens: Sequence[int]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest known run that ends at each token."""
        state = length = 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state, length = self.next[state][token], length + 1
            yield state, length


class Scanner:
    """The automaton of phrases and templates, and what a run of their words holds."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.names = [label for _, label in phrases] + [label for label, _ in templates]
        self.lists = [_of(text) for text, _ in phrases] + [_of(text) for _, text in templates]
        self.phrases = len(phrases)
        self.automaton = SuffixAutomaton(self.lists)
        self.vocabulary = np.unique(np.concatenate([np.array(x, np.uint64) for x in self.lists]))
        #: One word of every phrase, by which a short run is worth streaming.
        common = {}
        for tokens in self.lists:
            for t in tokens:
                common[t] = common.get(t, 0) + 1
        self.telling = np.array([min(x, key=common.__getitem__) for x in self.lists[: self.phrases]], np.uint64)
        self.whole: dict[int, list[tuple[int, int]]] = {}
        for state, ends in enumerate(self.automaton.ends):
            whole = [(n, len(self.lists[n])) for n, end in ends if n < self.phrases and end == len(self.lists[n])]
            if whole:
                self.whole[state] = whole

    def runs(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of known words within a text that are long enough or hold a phrase's word."""
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[place] == hashes
        begin, end = known.copy(), known.copy()
        begin[1:] &= ~known[:-1]
        end[:-1] &= ~known[1:]
        cut = first[:-1][first[:-1] < first[1:]]
        begin[cut] = known[cut]
        end[cut[1:] - 1] = known[cut[1:] - 1]
        start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
        telling = np.concatenate([[0], np.cumsum(known & np.isin(hashes, self.telling))])
        keep = (stop - start >= MIN_MATCH) | (telling[stop] > telling[start])
        return start[keep], stop[keep]

    def scan(self, tokens: list[int], at: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """Places of phrases (start, phrase), and maximal matches (start, length, template, start in it)."""
        places, matches = [], []
        found = list(self.automaton.statistics(tokens))
        for i, (state, length) in enumerate(found):
            while state > 0:
                for phrase, n in self.whole.get(state, ()):
                    if n <= length:
                        places.append((at + i + 1 - n, phrase))
                state = self.automaton.link[state]
                length = min(length, self.automaton.length[state])
            state, length = found[i]
            if length >= MIN_MATCH and (i + 1 == len(found) or found[i + 1][1] <= length):
                matches += [(at + i + 1 - length, length, n, end - length) for n, end in self.automaton.ends[state] if n >= self.phrases]
        return sorted(set(places)), matches

    def chain(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Template spans: matches of one template in order in both texts with small gaps, and of
        overlapping spans of a label the best covered one."""
        spans = []
        open_: dict[int, list[list[int]]] = {}
        for start, length, n, inside in sorted(matches):
            chains = open_.setdefault(n, [])
            for c in chains:
                skip = max(0, c[1] - start, c[2] - inside)
                if skip < length and start - c[1] <= MAX_GAP and inside - c[2] <= MAX_GAP:
                    c[1], c[2], c[3] = start + length, inside + length, c[3] + length - skip
                    break
            else:
                chains.append([start, start + length, inside + length, length])
        for n, chains in open_.items():
            for a, b, _, covered in chains:
                share = covered / len(self.lists[n])
                if share >= MIN_COVER:
                    spans.append((self.names[n], a, b, min(1.0, share)))
        best: list[tuple[str, int, int, float]] = []
        for span in sorted(spans, key=lambda s: (-s[3], s[1], s[0])):
            if not any(s[0] == span[0] and s[1] < span[2] and span[1] < s[2] for s in best):
                best.append(span)
        return sorted(best, key=lambda s: (s[1], s[0]))


def _scan(batches: Iterator[pa.RecordBatch], scanner: Scanner) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.float64())])
    for batch in batches:
        for piece in pieces(batch, "text"):
            data, offsets = text_bytes(piece.column("text"))
            hashes, first = word_hashes(data, offsets)
            places: dict[int, list] = {}
            matches: dict[int, list] = {}
            start, stop = scanner.runs(hashes, first)
            texts = np.searchsorted(first, start, "right") - 1
            for a, b, i in zip(start.tolist(), stop.tolist(), texts.tolist(), strict=True):
                p, m = scanner.scan(hashes[a:b].tolist(), a - int(first[i]))
                if p:
                    places.setdefault(i, []).extend(p)
                if m:
                    matches.setdefault(i, []).extend(m)
            rows = []
            for i, n in enumerate(np.diff(first).tolist()):
                p = places.get(i, [])
                spans = scanner.chain(matches[i]) if i in matches else []
                base = {scanner.names[x] for _, x in p}
                score = 1.0 if p else max((s[3] for s in spans), default=0.0)
                rows.append((n, len(p), min(p)[0] if p else None, max(p)[0] if p else None, ",".join(sorted(base)), ",".join(sorted(base | {s[0] for s in spans})), score, [dict(zip(("label", "start", "end", "covered"), s, strict=True)) for s in spans]))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(kind)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES
) -> DataFrame:
    """One row per row of `docs`: the words of the text, the places of the phrases, and the template
    spans [start, end) in words with the covered share of their template.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased; matching never leaves
    a text. labels are those of phrases and spans, distinct and sorted. score is 1 where a phrase stands
    and otherwise the best covered share. No shuffle: every text is read once. A null text has no words;
    a null id is passed on.
    """
    scanner = Scanner(phrases, templates)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: _scan(batches, scanner), SCHEMA)
