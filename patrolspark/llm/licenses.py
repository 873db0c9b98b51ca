"""License scans by a generalised suffix automaton of licence words.

One automaton holds every template and phrase, word by word.  A text streams
through it; after each word the automaton knows the longest run of words that
ends there and occurs in some template (the matching statistics).  Maximal runs
of at least ``MIN_RUN`` words are laid against every template place they occur
at and chained: runs in order on both sides and close together cover a template
span.  A template is found where one chain covers ``MIN_COVER`` of its words.

Fixed phrases are templates too: a phrase stands at a word exactly if the
current match is as long as the phrase and ends with it, which the automaton's
suffix links tell.

Defined cases: a null text counts as empty; a text without words has no
matches and score 0; an empty table gives an empty result; whole texts are
read; repeated rows get equal results; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, col, free_name, small_batches

#: Fixed by the contract: the word class and the base phrases with their labels.
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Notices of public licences (fixed values), with the label of each.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the "
                   "license at http www apache org licenses license 2 0 unless required by applicable law or agreed "
                   "to in writing software distributed under the license is distributed on an as is basis without "
                   "warranties or conditions of any kind either express or implied see the license for the specific "
                   "language governing permissions and limitations under the license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
            "copies of the software and to permit persons to whom the software is furnished to do so subject to "
            "the following conditions"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
MIN_RUN = 3
MIN_COVER = 0.8
MAX_GAP = 12


@dataclass
class _State:
    length: int = 0
    link: int = -1
    step: dict[str, int] = field(default_factory=dict)
    places: set[tuple[int, int]] = field(default_factory=set)  # template and place of the last word
    phrases: tuple[int, ...] = ()


class Automaton:
    """Generalised suffix automaton over the words of all templates."""

    def __init__(self, templates: list[list[str]], phrases: list[list[str]]):
        self.states = [_State()]
        self.templates, self.phrases = templates, phrases
        for t, words in enumerate(templates + phrases):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, word)
                if t < len(templates):
                    self.states[last].places.add((t, place))
        by_length = sorted(range(1, len(self.states)), key=lambda s: self.states[s].length)
        for s in reversed(by_length):  # a suffix ends wherever its longer strings end
            self.states[self.states[s].link].places |= self.states[s].places
        ends = {}
        for p, words in enumerate(phrases):
            at = 0
            for word in words:
                at = self.states[at].step[word]
            ends.setdefault(at, []).append(p)
        for s in by_length:
            state = self.states[s]
            state.phrases = self.states[state.link].phrases + tuple(ends.get(s, ()))
        self.words = {w for words in templates + phrases for w in words}

    def _extend(self, last: int, word: str) -> int:
        states = self.states
        old = states[last].step.get(word)
        if old is not None:
            return old if states[old].length == states[last].length + 1 else self._clone(last, word, old)
        new = len(states)
        states.append(_State(states[last].length + 1))
        at = last
        while at >= 0 and word not in states[at].step:
            states[at].step[word] = new
            at = states[at].link
        if at < 0:
            states[new].link = 0
        else:
            old = states[at].step[word]
            fits = states[old].length == states[at].length + 1
            states[new].link = old if fits else self._clone(at, word, old)
        return new

    def _clone(self, at: int, word: str, old: int) -> int:
        states = self.states
        new = len(states)
        states.append(_State(states[at].length + 1, states[old].link, dict(states[old].step)))
        states[old].link = new
        while at >= 0 and states[at].step.get(word) == old:
            states[at].step[word] = new
            at = states[at].link
        return new

    def scan(self, words: list[str]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """Phrase places (phrase, first word) and maximal runs (state, last word, length)."""
        states, known = self.states, self.words
        at = length = 0
        found, runs = [], []
        for j, word in enumerate(words):
            if word not in known:
                if length >= MIN_RUN:
                    runs.append((at, j - 1, length))
                at = length = 0
                continue
            if word not in states[at].step:
                if length >= MIN_RUN:
                    runs.append((at, j - 1, length))
                while at and word not in states[at].step:
                    at = states[at].link
                    length = states[at].length
            at = states[at].step.get(word, 0)
            length = length + 1 if at else 0
            for p in states[at].phrases:
                if len(self.phrases[p]) <= length:
                    found.append((p, j - len(self.phrases[p]) + 1))
        if length >= MIN_RUN:
            runs.append((at, len(words) - 1, length))
        return found, runs

    def chains(self, runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
        """Best chain ending at each run place: (template, first word, last word, share covered)."""
        done: dict[int, list[list[int]]] = {}
        out = []
        for state, end, length in runs:
            for t, place in self.states[state].places:
                begin, at = end - length + 1, place - length + 1
                best, first = length, begin
                near = done.setdefault(t, [])
                while near and near[0][0] < begin - MAX_GAP:
                    near.pop(0)
                for other_end, other_place, covered, start in near:
                    # runs may overlap by words that both sides share
                    over = max(0, other_end - begin + 1, other_place - at + 1)
                    if other_end < end and other_place < place and covered + length - over > best:
                        best, first = covered + length - over, start
                near.append([end, place, best, first])
                out.append((t, first, end, best / len(self.templates[t])))
        return out


@lru_cache(maxsize=4)
def automaton(templates: tuple, phrases: tuple) -> Automaton:
    return Automaton([t.split() for _, t in templates], [p.split() for p, _ in phrases])


def scan_text(text: str, templates=TEMPLATES, phrases=PHRASES) -> dict:
    """Words, phrase places and covered template spans of one text."""
    words = WORD.findall(text.translate(UPPER))
    auto = automaton(templates, phrases)
    found, runs = auto.scan(words)
    chains = auto.chains(runs)
    spans = [(templates[t][0], a, b, c) for t, a, b, c in chains if c >= MIN_COVER]
    base = sorted({phrases[p][1] for p, _ in found})
    return {
        "n_words": len(words), "n_base": len(found),
        "first_word": min((j for _, j in found), default=None),
        "last_word": max((j for _, j in found), default=None),
        "base_labels": ",".join(base),
        "labels": ",".join(sorted({*base, *(s[0] for s in spans)})),
        "score": max([min(1.0, c) for *_, c in chains] + [1.0] * bool(found), default=0.0),
        "spans": [{"label": label, "first": a, "last": b, "cover": min(1.0, c)} for label, a, b, c in spans],
    }


SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, spans array<struct<label:string,first:long,last:long,cover:double>>")


def scan(docs: DataFrame, text: str = "text", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """``docs`` with a ``licenses`` struct of SCHEMA's fields (underscores added if taken)."""
    templates, phrases = tuple(templates), tuple(phrases)
    small_batches(docs.sparkSession)

    @F.pandas_udf(SCHEMA)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [scan_text(t, templates, phrases) for t in batch]
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            yield frame.astype({"n_words": "int64", "n_base": "int64", "first_word": "Int64", "last_word": "Int64"})

    return docs.withColumn(free_name(docs, "licenses"), apply(F.coalesce(col(docs, text), F.lit(""))))
