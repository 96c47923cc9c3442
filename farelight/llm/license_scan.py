"""Licence scan with a generalised suffix automaton of licence tokens.

All templates become one automaton over word numbers. Files are streamed through it word by word; the automaton
keeps the longest run of words that ends here and occurs in any template (matching statistics). Long matches
are chained in the order of a template, and a span that covers enough of it gives the template's label.

Most words of a file are in no template and most pairs of neighbours that are do not occur in one, so
only runs of known pairs are streamed; elsewhere the statistics are below two, which no chain uses.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelight.llm import words
from farelight.llm.tables import batch_map, documents

# Phrases whose places are counted, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices as licences ask for them to be printed, words only, and their labels.
TEMPLATES = (
    ("licensed under the gnu general public license version 3", "gpl"),
    ("licensed under the gnu general public license version 2", "gpl"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your "
        "option any later version",
        "gpl",
    ),
    (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
        "general public license as published by the free software foundation",
        "lgpl",
    ),
    (
        "it under the terms of the gnu affero general public license as published by the free software foundation",
        "agpl",
    ),
    ("licensed under the apache license version 2 0", "apache"),
    (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "apache",
    ),
    ("released under the mit license", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "mit",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "bsd",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted",
        "isc",
    ),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
)

#: Shortest match that is chained, most words between two of a chain, and share of a template for its label.
MIN_MATCH = 3
MAX_GAP = 6
COVERED = 0.8


def _word_hashes(phrases: list[str]) -> list[np.ndarray]:
    out = []
    with np.errstate(over="ignore"):
        for _, _, data, offsets in words.text_slices(pa.array(phrases, pa.string())):
            starts, ends, first = words.word_spans(data, offsets, words.ALNUM)
            hashes = words.word_hashes(words.lower(data), starts, ends)
            out += [hashes[first[i] : first[i + 1]] for i in range(len(offsets) - 1)]
    return out


class Matcher:
    """The automaton of all templates, with the places of the templates that each state stands for."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        hashes = _word_hashes([p for p, _ in (*phrases, *templates)])
        self.vocabulary = np.unique(np.concatenate(hashes))
        self.seen = np.zeros(1 << 16, dtype=bool)
        self.seen[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True
        numbered = [np.searchsorted(self.vocabulary, h).tolist() for h in hashes]
        self.phrases = [(numbers, label) for numbers, (_, label) in zip(numbered, phrases, strict=False)]
        self.templates = numbered[len(phrases) :]
        self.labels = [label for _, label in templates]
        n = len(self.vocabulary)
        self.pairs = np.zeros(n * n, dtype=bool)
        for t in self.templates:
            self.pairs[[a * n + b for a, b in zip(t, t[1:], strict=False)]] = True
        self._build()

    def _build(self) -> None:
        self.step, self.link, self.length = [{}], [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]
        for number, template in enumerate(self.templates):
            last = 0
            for at, word in enumerate(template):
                last = self._extend(last, word)
                while len(ends) < len(self.step):
                    ends.append([])
                ends[last].append((number, at))
        # A state ends wherever those that link to it end.
        for state in sorted(range(1, len(self.step)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                ends[self.link[state]] += ends[state]
        self.ends = [sorted(set(e)) for e in ends]

    def _extend(self, last: int, word: int) -> int:
        step, link, length = self.step, self.link, self.length

        def split(p: int, q: int) -> int:
            clone = len(step)
            step.append(dict(step[q]))
            length.append(length[p] + 1)
            link.append(link[q])
            link[q] = clone
            while p >= 0 and step[p].get(word) == q:
                step[p][word] = clone
                p = link[p]
            return clone

        if word in step[last]:
            q = step[last][word]
            return q if length[q] == length[last] + 1 else split(last, q)
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p >= 0:
            q = step[p][word]
            link[new] = q if length[q] == length[p] + 1 else split(p, q)
        return new

    def stream(self, numbers: list[int], base: int) -> list[tuple[int, int, int]]:
        """Matches (last word, length, state) that cannot be extended to the right, of a run of known words."""
        found, state, held = [], 0, 0
        for at, word in enumerate(numbers):
            while state and word not in self.step[state]:
                if held >= MIN_MATCH and (not found or found[-1][0] != base + at - 1):
                    found.append((base + at - 1, held, state))
                state = self.link[state]
                held = self.length[state]
            if word in self.step[state]:
                state = self.step[state][word]
                held += 1
            else:
                held = 0
        if held >= MIN_MATCH:
            found.append((base + len(numbers) - 1, held, state))
        return found

    def chain(self, matches: list[tuple[int, int, int]]) -> dict[int, float]:
        """For each template matched, the largest share of it that a chain of matches in its order covers.

        ``matches`` are in the order of the file. The next piece of a chain starts at most ``MAX_GAP`` words after the
        last in the file, and after it in the template; words that two pieces share count once.
        """
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        for last, held, state in matches:
            for template, end in self.ends[state]:
                pieces.setdefault(template, []).append((last, end, held))
        best = {}
        for template, found in pieces.items():
            covers: list[tuple[int, int, int]] = []
            for last, end, held in found:
                cover = held
                for before, ended, covered in reversed(covers):
                    if last - held - before > MAX_GAP:
                        break
                    if before < last and ended < end:
                        cover = max(cover, covered + min(held, last - before, end - ended))
                covers.append((last, end, cover))
            best[template] = max(c for _, _, c in covers) / len(self.templates[template])
        return best

    def scan(self, texts: pa.Array):
        """Per text: words, places of phrases, first and last of them, base labels, all labels, largest share covered."""
        n = len(self.vocabulary)
        with np.errstate(over="ignore"):
            for row, end, data, offsets in words.text_slices(texts):
                data = words.lower(data)
                starts, stops, first = words.word_spans(data, offsets, words.ALNUM)
                hashes = words.word_hashes(data, starts, stops)
                near = np.flatnonzero(self.seen[(hashes >> np.uint64(48)).astype(np.int64)])
                place = np.minimum(np.searchsorted(self.vocabulary, hashes[near]), n - 1)
                hit = self.vocabulary[place] == hashes[near]
                number = np.full(len(hashes) + 1, -1, dtype=np.int64)
                number[near[hit]] = place[hit]
                owner = np.repeat(np.arange(end - row), np.diff(first))
                base = self._places(number, owner)
                chains = self._chains(number, owner, n)
                for i in range(end - row):
                    spots = base.get(i, [])
                    labels = {label for _, label in spots}
                    shares = chains.get(i, {})
                    more = labels | {self.labels[t] for t, share in shares.items() if share >= COVERED}
                    at = [int(p - first[i]) for p, _ in spots]
                    yield (
                        int(first[i + 1] - first[i]), len(spots), min(at, default=None), max(at, default=None),
                        ",".join(sorted(labels)), ",".join(sorted(more)), float(max(shares.values(), default=0.0)),
                    )

    def _places(self, number: np.ndarray, owner: np.ndarray) -> dict[int, list[tuple[int, str]]]:
        found: dict[int, list[tuple[int, str]]] = {}
        for wanted, label in self.phrases:
            at = np.flatnonzero(number[:-1] == wanted[0])
            at = at[at + len(wanted) <= len(owner)]
            for k, word in enumerate(wanted[1:], start=1):
                at = at[number[at + k] == word]
            at = at[owner[at] == owner[at + len(wanted) - 1]]
            for p in at.tolist():
                found.setdefault(int(owner[p]), []).append((p, label))
        return found

    def _chains(self, number: np.ndarray, owner: np.ndarray, n: int) -> dict[int, dict[int, float]]:
        left, right = number[:-2], number[1:-1]
        known = (left >= 0) & (right >= 0) & (owner[:-1] == owner[1:])
        known[known] = self.pairs[left[known] * n + right[known]]
        edges = np.diff(np.concatenate([[0], known.astype(np.int8), [0]]))
        matches: dict[int, list] = {}
        for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
            if b - a + 1 >= MIN_MATCH:
                matches.setdefault(int(owner[a]), []).extend(self.stream(number[a : b + 1].tolist(), a))
        return {i: self.chain(found) for i, found in matches.items() if found}


_FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _scan(phrases, templates):
    def run(batches):
        matcher = Matcher(phrases, templates)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = [f.split()[0] for f in _FIELDS.split(", ")]
        for batch in batches:
            rows = list(matcher.scan(batch.column(1)))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["_id", *names])

    return run


def scan_licenses(
    docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: id, ``n_words``, ``n_base`` places of phrases, ``first_word`` and ``last_word`` of them, ``base_labels``,
    ``labels`` (those of chained templates too) and ``score``, the largest share of a template that is covered.

    Null texts are empty texts: no words, no labels (empty strings), score 0. Null ids are carried along, repeated
    rows come out repeated, an empty table gives an empty result; other columns are not looked at.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = batch_map(docs.select(id_column, text_column), _scan(phrases, templates), f"_id {kind}, {_FIELDS}")
    return rows.withColumnRenamed("_id", id_column).select(F.col(id_column), *[f.split()[0] for f in _FIELDS.split(", ")])


def op4_license_scan(spark, sf_dir):
    """Licence phrases and labels of every document."""
    return scan_licenses(documents(spark, sf_dir))
