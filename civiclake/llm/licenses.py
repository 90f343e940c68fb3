"""Licence scan: texts streamed through a generalised suffix automaton of licence words.

The automaton holds every run of words of every template. A text moves through it word by word;
the state and matched length after each word are its matching statistics. Matches that cannot
grow further and are long enough are chained per template, in order on both sides, and the share
of a template its best chain covers is the template's coverage. Base phrases are templates too:
one ends wherever its state lies on the suffix-link path of the current state.
"""

from __future__ import annotations

from bisect import bisect_right
from heapq import heappop, heappush

from pyspark.sql import DataFrame

from civiclake.llm.common import alnum_words, map_rows

#: Phrases whose every place counts, and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Openings and key clauses of public licences, (label, words).
TEMPLATES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files to deal in the software without restriction including without "
        "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
        "of the software and to permit persons to whom the software is furnished to do so",
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
    ),
    ("apache", "licensed under the apache license version 2 0"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 3 of the "
        "license or at your option any later version",
    ),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee "
        "is hereby granted",
    ),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("all-rights-reserved", "all rights reserved"),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited"),
)

#: Words a match needs before it may join a chain, and the coverage at which a template's label stands.
LEAST_MATCH = 3
LEAST_COVERAGE = 0.6


class LicenceAutomaton:
    """Generalised suffix automaton of word sequences with the places where each state ends."""

    def __init__(self, templates, phrases) -> None:
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.longest = [-1], [0]
        self.labels = [label for label, _ in templates]
        self.sizes: list[int] = []
        ends: list[set[tuple[int, int]]] = [set()]
        for number, (_, text) in enumerate(templates):
            words = alnum_words(text)
            self.sizes.append(len(words))
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, word)
                while len(ends) < len(self.step):
                    ends.append(set())
                ends[last].add((number, place + 1))
        phrase_state: dict[int, list[tuple[int, str]]] = {}
        for phrase, label in phrases.items():
            last, words = 0, alnum_words(phrase)
            for word in words:
                last = self._extend(last, word)
            phrase_state.setdefault(last, []).append((len(words), label))
        ends += [set() for _ in range(len(self.step) - len(ends))]
        by_length = sorted(range(1, len(self.step)), key=self.longest.__getitem__)
        for state in reversed(by_length):
            if self.link[state] > 0:
                ends[self.link[state]] |= ends[state]
        self.places = [sorted(places) for places in ends]
        self.phrases: list[tuple[tuple[int, str], ...]] = [()] * len(self.step)
        for state in by_length:
            self.phrases[state] = self.phrases[max(self.link[state], 0)] + tuple(phrase_state.get(state, ()))
        self.words = {word for steps in self.step for word in steps}

    def _state(self, longest: int, steps: dict[bytes, int], link: int) -> int:
        self.step.append(steps)
        self.longest.append(longest)
        self.link.append(link)
        return len(self.step) - 1

    def _split(self, before: int, word: bytes) -> int:
        """The state of ``before``'s longest sequence plus ``word``, cut off from a longer one if need be."""
        step, longest, link = self.step, self.longest, self.link
        target = step[before][word]
        if longest[target] == longest[before] + 1:
            return target
        copy = self._state(longest[before] + 1, dict(step[target]), link[target])
        link[target] = copy
        while before >= 0 and step[before].get(word) == target:
            step[before][word] = copy
            before = link[before]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        step, longest, link = self.step, self.longest, self.link
        if word in step[last]:
            return self._split(last, word)
        new = self._state(longest[last] + 1, {}, 0)
        while last >= 0 and word not in step[last]:
            step[last][word] = new
            last = link[last]
        link[new] = 0 if last < 0 else self._split(last, word)
        return new

    def scan(self, words: list[bytes], least_match: int):
        """(base places, matches): [(first word, label)], [(first word, past-last word, state)]."""
        known, step, link, longest, phrases = self.words, self.step, self.link, self.longest, self.phrases
        base: list[tuple[int, str]] = []
        found: list[tuple[int, int, int]] = []
        state = length = 0
        previous = -2
        for place in [n for n, word in enumerate(words) if word in known]:
            word = words[place]
            if place != previous + 1:
                if length >= least_match:
                    found.append((previous + 1 - length, previous + 1, state))
                state = length = 0
            elif word not in step[state]:
                if length >= least_match:
                    found.append((place - length, place, state))
                while state and word not in step[state]:
                    state = link[state]
                length = longest[state]
            state = step[state].get(word, 0)
            length = length + 1 if state else 0
            previous = place
            for size, label in phrases[state]:
                if size <= length:
                    base.append((place + 1 - size, label))
        if length >= least_match:
            found.append((previous + 1 - length, previous + 1, state))
        return base, found

    def coverage(self, found) -> list[float]:
        """For each template, the share that the best chain of matches covers."""
        per: dict[int, list[tuple[int, int, int, int]]] = {}
        for first, past, state in found:
            for number, end in self.places[state]:
                per.setdefault(number, []).append((first, past, end - (past - first), end))
        covered = [0.0] * len(self.sizes)
        for number, matches in per.items():
            covered[number] = best_chain(matches) / self.sizes[number]
        return covered


def best_chain(matches: list[tuple[int, int, int, int]]) -> int:
    """Most template words covered by matches (text from, to, template from, to) in order on both sides.

    A frontier keeps, for growing template ends, growing covers of chains that have ended in the
    text; each match looks up the best chain before it: O(m log m).
    """
    ends, covers, open_chains, top = [0], [0], [], 0
    for first, past, low, high in sorted(matches):
        while open_chains and open_chains[0][0] <= first:
            _, end, cover = heappop(open_chains)
            at = bisect_right(ends, end)
            if covers[at - 1] < cover:
                stop = at
                while stop < len(ends) and covers[stop] <= cover:
                    stop += 1
                at -= ends[at - 1] == end
                ends[at:stop], covers[at:stop] = [end], [cover]
        cover = covers[bisect_right(ends, low) - 1] + high - low
        top = max(top, cover)
        heappush(open_chains, (past, high, cover))
    return top


def scan_licenses(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates=TEMPLATES,
    phrases=None,
    least_match: int = LEAST_MATCH,
    least_coverage: float = LEAST_COVERAGE,
) -> DataFrame:
    """Per document: word count, places of base phrases, labels, and a score.

    ``n_base`` counts all places, ``first_word`` and ``last_word`` are the smallest and largest
    start (null without one), ``base_labels`` and ``labels`` are sorted and comma-joined, ``spans``
    are the text's matched runs of template words. ``score`` is the largest coverage, 1 where a
    base phrase stands, as such a phrase is covered whole. Null and empty texts have no words; one
    output row per input row; other columns are not read.
    """
    phrases = BASE_PHRASES if phrases is None else phrases
    id_type = documents.schema[id_column].dataType.simpleString()
    schema = (
        f"{id_column} {id_type}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double, spans array<struct<first: bigint, past: bigint>>"
    )

    def run(rows):
        automaton = LicenceAutomaton(templates, phrases)
        for key, text in rows:
            words = alnum_words(text)
            base, found = automaton.scan(words, least_match)
            covered = automaton.coverage(found)
            own = {label for _, label in base}
            more = {automaton.labels[n] for n, share in enumerate(covered) if share >= least_coverage}
            starts = [place for place, _ in base]
            score = 1.0 if base else max(covered, default=0.0)
            spans = [{"first": first, "past": past} for first, past, _ in found]
            yield (
                key, len(words), len(base), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(own)), ",".join(sorted(own | more)), min(score, 1.0), spans,
            )

    return map_rows(documents.select(id_column, text_column), run, schema)
