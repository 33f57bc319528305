"""Licence scan: templates with markup, compiled into token automata.

A template is wording with two kinds of markup: ``<<opt: words >>`` is a region
that may be absent, ``<<any: n >>`` one that may hold up to n words of any kind.
Everything else is mandatory. Each template becomes an automaton over words
(states with a word edge, a skip edge, or an any-word edge); a text is accepted
where the automaton, started at a place, passes all mandatory wording exactly.
All templates run together: every word that can start one opens a run, and a run
holds a set of states, so the work is a few steps a word of a candidate place.

Whole licences (``license_texts``, labels that end in ``-text``) are accepted only with
all their conditions and the disclaimer; the labels of ``OPENINGS`` stand for
notices and first words, by which texts name a licence.

The base labels come from fixed phrases whose words stand consecutively; they
are independent of the templates, whose labels are added.

The score is 1 where a template is accepted, else the largest share of a
template's mandatory words that a run has passed, but at least half where a
base phrase stands.

Edge cases: a null text is empty: no word, no label, score 0; overlapping
places all count; equal labels are listed once; repeated rows get equal results;
texts of any length are scanned whole. Input columns named like an output are
replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from larder.llm.common import LOWER, add_columns
from larder.llm.license_texts import WHOLE

# fixed values: base phrases and labels
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Lower-cases A-Z and turns every ASCII byte outside a word into a blank.
WORDS = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else 32 for b in LOWER)

#: Label and wording of the notices and openings by which texts name a licence.
OPENINGS = {
    "apache-2.0-notice": "licensed under the apache license <<opt: version >> 2 0 <<opt: the license you may not use this "
                         "<<any: 2 >> except in compliance with the license >>",
    "mit-notice": "<<opt: this <<any: 2 >> is >> released under the <<opt: terms of the >> mit license",
    "gpl-3.0-notice": "this <<any: 2 >> is licensed under the gnu general public license <<opt: version >> 3",
    "gpl-free-software": "this program is free software you can redistribute it and or modify it under the terms of the "
                         "gnu <<opt: lesser >> <<opt: affero >> general public license as published by the free software "
                         "foundation either version <<any: 1 >> of the license or <<opt: at your option >> any later version",
    "cc-by-notice": "licensed under <<opt: a >> <<opt: the >> <<opt: creative commons >> cc by <<opt: nc >> <<opt: sa >> "
                    "<<opt: nd >> 4 0 <<opt: international >>",
    "cc-attribution-notice": "licensed under <<opt: a >> <<opt: the >> creative commons attribution <<any: 3 >> 4 0 "
                             "international license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                      "associated documentation files the software to deal in the software without restriction including "
                      "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                      "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                      "the following conditions",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted "
                          "provided that the following conditions are met <<opt: 1 >> redistributions of source code must "
                          "retain the above copyright notice this list of conditions and the following disclaimer",
    "isc-permission": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                      "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-2.0-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "all-rights-reserved": "copyright <<any: 8 >> all rights reserved",
}
TEMPLATES = OPENINGS | WHOLE


class Automaton:
    """One template's states: ``words[i]`` the word that leads on, ``jumps[i]`` free moves, ``loose`` any-word states.

    State i is passed by its word to i + 1; an any-word state is passed by any
    word; a jump moves without a word. ``done`` counts mandatory words up to a state.
    """

    def __init__(self, wording: str):
        self.words: list[bytes | None] = []
        self.jumps: list[list[int]] = []
        self.loose: set[int] = set()
        self.done: list[int] = []
        mandatory, opened = 0, []
        for token in re.findall(r"<<opt:|<<any:\s*\d+\s*>>|>>|[^\s<>]+", wording):
            if token == "<<opt:":
                opened.append(self._state(mandatory))
            elif token == ">>":
                self.jumps[opened.pop()].append(len(self.words))
            elif token.startswith("<<any:"):
                first, n = len(self.words), int(re.search(r"\d+", token).group())
                for _ in range(n):
                    at = self._state(mandatory)
                    self.loose.add(at)
                    self.jumps[at].append(first + n)
            else:
                self._state(mandatory, token.encode())
                mandatory += not opened
        self.end, self.mandatory = len(self.words), mandatory
        self.jumps.append([])
        self.words.append(None)
        self.done.append(mandatory)

    def _state(self, done: int, word: bytes | None = None) -> int:
        self.words.append(word)
        self.jumps.append([])
        self.done.append(done)
        return len(self.words) - 1

    def free(self, states: set[int]) -> set[int]:
        """All states reached without a word. A region's opening state has no word: it moves on or past the region."""
        todo, seen = list(states), set()
        while todo:
            s = todo.pop()
            if s in seen:
                continue
            seen.add(s)
            todo += self.jumps[s]
            if s != self.end and self.words[s] is None and s not in self.loose:
                todo.append(s + 1)
        return seen

    def starts(self) -> set[bytes]:
        return {self.words[s] for s in self.free({0}) if self.words[s]}

    def run(self, words: list[bytes], at: int) -> tuple[bool, int]:
        """Whether the wording stands from place ``at``, and the mandatory words passed."""
        states, best = self.free({0}), 0
        for i in range(at, len(words) + 1):
            best = max(best, max(self.done[s] for s in states))
            if self.end in states:
                return True, self.mandatory
            if i == len(words):
                break
            w = words[i]
            states = self.free({s + 1 for s in states if s != self.end and (s in self.loose or self.words[s] == w)})
            if not states:
                break
        return False, best


def compiled(templates: dict[str, str] | None = None) -> dict[bytes, list]:
    """(label, automaton) by the words that can start the wording."""
    by_start: dict[bytes, list] = {}
    for label, wording in (templates or TEMPLATES).items():
        auto = Automaton(wording)
        if not auto.mandatory:
            raise ValueError(f"{label} has no mandatory wording")
        for w in auto.starts():
            by_start.setdefault(w, []).append((label, auto))
    return by_start


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORDS).split()


def scan(words: list[bytes], by_start: dict[bytes, list]) -> tuple[list[int], set[str], set[str], float]:
    """Starts of the base phrases' places, base labels, template labels, score."""
    places: list[int] = []
    base: set[str] = set()
    joined = b" " + b" ".join(words) + b" "
    for phrase, label in PHRASES.items():
        needle = f" {phrase} ".encode()
        at, counted, before = joined.find(needle), 0, 0  # blanks are counted on from the place before
        while at >= 0:
            before += joined.count(b" ", counted, at)
            counted = at
            places.append(before)
            base.add(label)
            at = joined.find(needle, at + 1)
    added: set[str] = set()
    score = 0.5 if places else 0.0
    for w, autos in by_start.items():
        if joined.find(b" " + w + b" ") < 0:
            continue
        at = words.index(w)
        while at >= 0:
            for label, auto in autos:
                full, passed = auto.run(words, at)
                if full:
                    added.add(label)
                share = passed / auto.mandatory
                if passed > 1 and share > score:
                    score = share
            try:
                at = words.index(w, at + 1)
            except ValueError:
                at = -1
    return places, base, added, score


FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
          T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
          T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
          T.StructField("score", T.DoubleType())]


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with word count, base places, labels and score."""

    def start() -> Callable:
        by_start = compiled(templates)

        def run(texts: list) -> dict:
            out: dict[str, list] = {f.name: [] for f in FIELDS}
            for text in texts:
                words = words_of(text)
                places, base, added, score = scan(words, by_start) if words else ([], set(), set(), 0.0)
                row = (len(words), len(places), min(places, default=None), max(places, default=None),
                       ",".join(sorted(base)), ",".join(sorted(base | added)), score)
                for f, v in zip(FIELDS, row):
                    out[f.name].append(v)
            return out

        return run

    return add_columns(docs, "text", T.StructType(FIELDS), start)
