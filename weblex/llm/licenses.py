"""License scans: base phrases and licence templates as token automata.

A template is mandatory wording with marked regions, in a markup of its own:

    [[ ... ]]     optional wording, taken whole or not at all; regions may nest
    {{n}}         replaceable text of 0 to n words

It compiles to an automaton over words whose states are positions in the
template; optional regions add a way around, replaceable ones a bounded loop.
A text is accepted where some run of its words spells all mandatory wording
exactly.  The automaton is started only at words that can begin a template,
and only in texts that hold the template's longest mandatory run as it stands,
which every accepted text must hold.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, so
markup, punctuation and line breaks never matter.

Defined results: a null text is empty (no words, no labels, score 0); repeated
rows are scanned row by row; phrases at equal places each count; an empty
table gives an empty table; other columns pass through, those named like a
result give way to it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import annotate, field

# Base phrases and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

#: (label, template).  Wordings of common public licence notices.
TEMPLATES = [
    ("mit", "[[this {{3}} is]] released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 [[the license]]"),
    ("gpl-3", "licensed under the gnu general public license version 3 [[0]] [[or any later version]]"),
    ("gpl-3", "under the terms of the gnu general public license as published by the free software foundation "
              "either version 3 of the license or at your option any later version"),
    ("cc-by-nc", "licensed under [[a]] [[creative commons]] cc by nc [[4 0]]"),
    ("cc-by", "licensed under [[a]] [[the]] creative commons attribution [[4 0]] [[international]] license"),
    ("bsd-3", "redistribution and use in source and binary forms with or without modification are permitted "
              "provided that the following conditions are met {{120}} neither the name of {{12}} nor the names of "
              "its contributors may be used to endorse or promote products derived from this software"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("proprietary", "all rights reserved {{6}} no part of this {{3}} may be reproduced"),
]

#: Every byte that is no part of a word becomes a space, A-Z become a-z.
_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else (b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20)
    for b in range(256))
_MARKUP = re.compile(r"\[\[|\]\]|\{\{(\d+)\}\}|[^\s\[\]{}]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class Automaton:
    """States are positions in the template; ``steps[i]`` is a word, or a
    bound (replaceable words may follow, up to it); ``skips[i]`` the positions
    reachable without a word.  Marks that do not pair are refused."""

    def __init__(self, label: str, template: str):
        self.label = label
        self.steps: list[bytes | int] = []
        self.skips: dict[int, set[int]] = {}
        runs: list[list[bytes]] = [[]]
        opened: list[int] = []
        for m in _MARKUP.finditer(template):
            part = m.group(0)
            if part == "[[":
                opened.append(len(self.steps))
                runs.append([])
            elif part == "]]":
                if not opened:
                    raise ValueError("]] without [[ in a template")
                self.skips.setdefault(opened.pop(), set()).add(len(self.steps))
                runs.append([])
            elif m.group(1):
                self.steps.append(int(m.group(1)))
                if not opened:
                    runs.append([])
            else:
                self.steps.append(part.encode())
                if not opened:
                    runs[-1].append(part.encode())
        if opened:
            raise ValueError("[[ without ]] in a template")
        longest = max(runs, key=lambda r: (len(r), sum(map(len, r))))
        if not longest:
            raise ValueError("a template needs mandatory wording")
        self.anchor = b" " + b" ".join(longest) + b" "
        self.first = {s for s, _ in self._closure({(0, 0)}) if isinstance(self._step(s), bytes)}
        self.starts = {self._step(s) for s in self.first}

    def _step(self, state: int):
        return self.steps[state] if state < len(self.steps) else None

    def _closure(self, states: set[tuple[int, int]]) -> set[tuple[int, int]]:
        """(position, words used in its replaceable region) reachable without
        a word; only the fewest words used matter for a position."""
        best: dict[int, int] = {}
        todo = list(states)
        while todo:
            at, used = todo.pop()
            if best.get(at, used + 1) <= used:
                continue
            best[at] = used
            todo += [(to, 0) for to in self.skips.get(at, ())]
            if isinstance(self._step(at), int):
                todo.append((at + 1, 0))
        return set(best.items())

    def accepts(self, words: list[bytes], start: int) -> int | None:
        """End of the longest accepted run from ``start``, else None."""
        states, end = self._closure({(0, 0)}), None
        for i in range(start, len(words) + 1):
            if any(at == len(self.steps) for at, _ in states):
                end = i
            if i == len(words) or not states:
                break
            nxt = set()
            for at, used in states:
                step = self._step(at)
                if step == words[i]:
                    nxt.add((at + 1, 0))
                elif isinstance(step, int) and used < step:
                    nxt.add((at, used + 1))
            states = self._closure(nxt)
        return end


def places(joined: bytes, phrase: str) -> list[int]:
    """Word positions where a phrase starts; ``joined``: the words with one
    space around each."""
    needle, out, at = b" " + phrase.encode() + b" ", [], -1
    word = seen = 0
    while (at := joined.find(needle, at + 1)) >= 0:
        word += joined.count(b" ", seen, at)
        seen = at
        out.append(word)
    return out


def _scanner(templates):
    automata = [Automaton(label, t) for label, t in templates]

    def scan(text):
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        found = [(p, label) for phrase, label in PHRASES for p in places(joined, phrase)]
        spans = []
        for a in automata:
            if a.anchor in joined:
                i = 0
                while i < len(words):
                    end = a.accepts(words, i) if words[i] in a.starts else None
                    if end:
                        spans.append((a.label, i, end))
                    i = end or i + 1
        base = {label for _, label in found}
        labels = base | {label for label, _, _ in spans}
        at = [p for p, _ in found]
        score = 1.0 if spans else 0.5 if base else 0.0
        return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
                ",".join(sorted(labels)), score, [{"label": x, "start": i, "end": j} for x, i, j in spans])

    return lambda texts: list(zip(*map(scan, texts))) or [[]] * len(FIELDS)


FIELDS = [
    field("n_words", T.LongType()), field("n_base", T.LongType()),
    field("first_word", T.LongType()), field("last_word", T.LongType()),
    field("base_labels", T.StringType()), field("labels", T.StringType()), field("score", T.DoubleType()),
    field("spans", T.ArrayType(T.StructType([field("label", T.StringType()), field("start", T.LongType()),
                                             field("end", T.LongType())]))),
]


def scan_licenses(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                  templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``docs`` plus FIELDS: words, base places, labels and the accepted
    template runs (``spans``, word positions, end exclusive).

    ``score``: 1 if a template was accepted, 0.5 if only base phrases stand in
    the text, else 0."""
    from functools import partial
    return annotate(docs, partial(_scanner, templates), FIELDS, text, keep)
