"""License scans: phrases, and license texts by template-markup matching.

A template is a license text with markup: ``<<optional>> ... <<end>>`` may be left out, and
``<<var:n>>`` stands for up to n words of any wording. It is compiled to an automaton over
words. A place in a text is accepted if the automaton reaches its end, so every mandatory word must stand
there in order; nothing is scored by likeness. The scan is one pass over whole texts, without
a shuffle; the automata are fixed in size.

Defined results: a NULL text counts as empty; without places first and last word are NULL and the
labels are empty; repeated rows are scanned alike.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from flowtide.llm import textops

# Phrases of the base scan and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# License templates. Only the words count, not case or punctuation.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 <<optional>> (the License); you may not use this "
        "<<var:3>> except in compliance with the License. <<end>>"
    ),
    "mit": "Released under the <<optional>> terms of the <<end>> MIT License",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of <<var:12>> to deal in the "
        "Software without restriction"
    ),
    "gpl-3.0": (
        "<<var:2>> licensed under the <<optional>> terms of the <<end>> GNU General Public License, version 3 "
        "<<optional>> or later <<end>>"
    ),
    "cc-by-nc-4.0": (
        "Licensed under <<optional>> a <<optional>> Creative Commons <<end>> license <<end>> CC BY-NC 4.0"
    ),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "copyright-notice": "Copyright <<optional>> (c) <<end>> <<var:8>> All rights reserved",
}

TEMPLATE_SCORE, PHRASE_SCORE = 1.0, 0.5

RESULT = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double"
)

_LOWER = bytes(textops.LOWER.tolist())
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARK = re.compile(r"<<(optional|end|var:\d+)>>")


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.translate(_LOWER))


def _places(line: bytes, wanted: bytes) -> Iterator[int]:
    """Number of the first word of each place of ``wanted``, which has a blank at either end."""
    place, counted = -1, 0
    at = line.find(wanted)
    while at >= 0:
        place += line.count(b" ", counted, at + 1)
        counted = at + 1
        yield place
        at = line.find(wanted, at + 1)


class Automaton(NamedTuple):
    """States are numbered; ``final`` accepts.

    ``steps`` leads on by a given word, ``anywhere`` by any word, ``skips`` by none.
    """

    steps: Mapping[int, Mapping[bytes, int]]
    anywhere: Mapping[int, int]
    skips: Mapping[int, list[int]]
    final: int

    def closure(self, states: set[int]) -> set[int]:
        open_, seen = list(states), set(states)
        while open_:
            for state in self.skips.get(open_.pop(), ()):
                if state not in seen:
                    seen.add(state)
                    open_.append(state)
        return seen

    def accepts_at(self, words: list[bytes], at: int) -> int | None:
        """The nearest end of an accepted place that begins at a word, or None."""
        states = self.closure({0})
        while self.final not in states:
            if at == len(words):
                return None
            ahead = {self.anywhere[s] for s in states if s in self.anywhere}
            ahead |= {self.steps[s][words[at]] for s in states if words[at] in self.steps.get(s, ())}
            if not ahead:
                return None
            states, at = self.closure(ahead), at + 1
        return at

    def first_words(self) -> set[bytes]:
        """The words an accepted place can begin with; the template must not begin with a variable."""
        return {w for s in self.closure({0}) for w in self.steps.get(s, ())}


def compile_template(template: str) -> Automaton:
    """Automaton of a template. A region at either end adds nothing to what is accepted
    and is left out, so that a place begins and ends with a mandatory word."""
    parts: list[bytes | str] = []
    at = 0
    for mark in _MARK.finditer(template):
        parts += [*words_of(template[at : mark.start()].encode()), mark[1]]
        at = mark.end()
    parts += words_of(template[at:].encode())
    steps: dict[int, dict[bytes, int]] = defaultdict(dict)
    anywhere: dict[int, int] = {}
    skips: dict[int, list[int]] = defaultdict(list)
    state, open_ = 0, []
    mandatory = [i for i, depth in _depths(parts) if depth == 0]
    if not mandatory:
        raise ValueError("a template needs mandatory words")
    for part in _trimmed(parts, mandatory[0], mandatory[-1]):
        if part == "optional":
            open_.append(state)
        elif part == "end":
            skips[open_.pop()].append(state)
        elif isinstance(part, str):
            begin, size = state, int(part.removeprefix("var:"))
            for _ in range(size):
                anywhere[state] = state + 1
                state += 1
            for inner in range(begin, state):
                skips[inner].append(state)
        else:
            steps[state][part] = state + 1
            state += 1
            continue
        # a state of its own after a mark keeps regions apart
        skips[state].append(state + 1)
        state += 1
    return Automaton(dict(steps), anywhere, dict(skips), state)


def _depths(parts: list) -> Iterator[tuple[int, int]]:
    """Place and nesting depth of each word."""
    depth = 0
    for i, part in enumerate(parts):
        if isinstance(part, bytes):
            yield i, depth
        elif part in ("optional", "end"):
            depth += 1 if part == "optional" else -1
            if depth < 0:
                raise ValueError("<<end>> without <<optional>>")
    if depth:
        raise ValueError("<<optional>> without <<end>>")


def _trimmed(parts: list, first: int, last: int) -> list:
    return parts[first : last + 1]


class Scanner:
    def __init__(self, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES):
        self.phrases = [(b" %s " % p.encode(), label) for p, label in phrases.items()]
        self.templates: dict[bytes, list[tuple[str, Automaton]]] = defaultdict(list)
        for label, template in templates.items():
            automaton = compile_template(template)
            for word in automaton.first_words():
                self.templates[word].append((label, automaton))

    def scan(self, text: bytes) -> tuple:
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        places, base = [], set()
        for phrase, label in self.phrases:
            for place in _places(line, phrase):
                places.append(place)
                base.add(label)
        found = set(base)
        for word, starts in self.templates.items():
            for place in _places(line, b" %s " % word):
                for label, automaton in starts:
                    if automaton.accepts_at(words, place) is not None:
                        found.add(label)
        score = TEMPLATE_SCORE if found - base else PHRASE_SCORE if places else 0.0
        return (
            len(words),
            len(places),
            min(places, default=None),
            max(places, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(found)),
            score,
        )


def scan_licenses(
    docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES
) -> DataFrame:
    """Places and labels of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = [part.split()[0] for part in RESULT.split(", ")]
        for batch in batches:
            rows = [scanner.scan(text) for text in textops.byte_texts(batch.column("text"))]
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)
