"""License scans: template-markup matching over words.

A template is license wording with markup: `<<beginOptional>>` ... `<<endOptional>>` encloses a region that a text may
lack (regions nest), and `<<var;min=0;max=8>>` stands for replaceable wording of that many words. A template is
compiled to a nondeterministic automaton over words; it accepts a text that holds, in one run, exactly the mandatory
wording, with any of the optional regions and replacements. The automaton starts only at its first mandatory word.

Beside the templates, base phrases are found at every place where their words stand consecutively. A text's labels
are those of its base phrases and its accepted templates. The score is 1 for an accepted template, 0.5 for a
base phrase alone, 0 for neither.

Words: A to Z lower-cased, then runs of digits, a to z and characters beyond ASCII.

Defined cases: a null or empty text has no words, no labels (an empty string) and score 0; texts of any length are
read whole; equal matches of a template count once in the labels and each in `spans`; repeated rows get equal
results; columns of the documents, whatever their names, play no part, since the result is an expression over the
text alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.shared import ship_package
from tradewind.llm.words import ALPHANUMERIC, word_spans

#: Base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Public license wording as templates, by label.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0<<beginOptional>> (the \"License\"); you may not use "
    "this file except in compliance with the License<<endOptional>>",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted"
    "<<beginOptional>> (subject to the limitations in the disclaimer below)<<endOptional>> provided that the following "
    "conditions are met",
    "cc-by-nc-4.0": "Licensed under <<beginOptional>>a <<endOptional>><<beginOptional>>the <<endOptional>>CC BY-NC 4.0",
    "cc-by-nc-4.0-long": "Creative Commons Attribution-NonCommercial 4.0 International<<beginOptional>> Public<<endOptional>> License",
    "gpl-3.0-grant": "This <<var;min=1;max=4>> is licensed under the GNU General Public License, version 3",
    "gpl-notice": "under the terms of the GNU <<beginOptional>>Lesser <<endOptional>>General Public License as published "
    "by the Free Software Foundation; either version <<var;min=1;max=2>> of the License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files<<beginOptional>> (the \"Software\")<<endOptional>>, to deal in the Software without restriction",
    "mit-release": "<<beginOptional>>This <<var;min=1;max=4>> is <<endOptional>>Released under the MIT License",
    "spdx-tag": "SPDX-License-Identifier: <<var;min=1;max=6>>",
}

RESULT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")]
    + [T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType())]
    + [T.StructField("score", T.DoubleType())]
    + [
        T.StructField(
            "spans",
            T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
        )
    ]
)

_MARKUP = re.compile(r"<<(beginOptional|endOptional|var;min=(\d+);max=(\d+))>>")


def plain_words(text: bytes) -> list[bytes]:
    low = text.lower()
    starts, ends = word_spans(np.frombuffer(low, dtype=np.uint8), ALPHANUMERIC)
    return [low[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


@dataclass
class Automaton:
    """States from 0; words[s]: word -> next state; any_word[s]: next state by whatever word; free[s]: next states without one."""

    words: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    any_word: list[int | None] = field(default_factory=lambda: [None])
    free: list[set[int]] = field(default_factory=lambda: [set()])
    accept: int = 0

    def _new(self) -> int:
        self.words.append({})
        self.any_word.append(None)
        self.free.append(set())
        return len(self.words) - 1

    @classmethod
    def compiled(cls, template: str) -> Automaton:
        """Raises ValueError for regions that don't match up or a template without words."""
        made, state, open_at, at = cls(), 0, [], 0
        for mark in [*_MARKUP.finditer(template), None]:
            for word in plain_words(template[at : mark.start() if mark else None].encode()):
                made.words[state][word] = following = made._new()
                state = following
            if mark is None:
                break
            at = mark.end()
            if mark[1] == "beginOptional":
                begin = made._new()
                made.free[state].add(begin)
                open_at.append(begin)
                state = begin
            elif mark[1] == "endOptional":
                if not open_at:
                    raise ValueError(f"region ends but doesn't begin: {template}")
                end = made._new()
                made.free[state].add(end)
                made.free[open_at.pop()].add(end)
                state = end
            else:
                low, high = int(mark[2]), int(mark[3])
                exits = [state] if low == 0 else []
                for i in range(1, high + 1):
                    made.any_word[state] = following = made._new()
                    state = following
                    if i >= low:
                        exits.append(state)
                end = made._new()
                for s in exits:
                    made.free[s].add(end)
                state = end
        if open_at or not any(made.words):
            raise ValueError(f"region without end, or no words: {template}")
        made.accept = state
        return made

    def closure(self, states: set[int]) -> set[int]:
        stack, seen = list(states), set(states)
        while stack:
            for s in self.free[stack.pop()] - seen:
                seen.add(s)
                stack.append(s)
        return seen

    def first_words(self) -> set[bytes] | None:
        """Words that a match can begin with; None if any word can."""
        start = self.closure({0})
        return None if any(self.any_word[s] is not None for s in start) else {w for s in start for w in self.words[s]}

    def match(self, words: list[bytes], begin: int) -> int | None:
        """End of the longest run from `begin` that is accepted."""
        states, end = self.closure({0}), None
        for i in range(begin, len(words)):
            step = {self.words[s][words[i]] for s in states if words[i] in self.words[s]}
            step |= {self.any_word[s] for s in states if self.any_word[s] is not None}
            if not step:
                break
            states = self.closure(step)
            if self.accept in states:
                end = i + 1
        return end


class LicenseScanner:
    """Base phrases and compiled templates."""

    def __init__(self, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> None:
        self.phrases = [(tuple(plain_words(p.encode())), label) for p, label in (BASE_PHRASES if phrases is None else phrases).items()]
        self.automata = {label: Automaton.compiled(t) for label, t in (TEMPLATES if templates is None else templates).items()}
        self.by_first: dict[bytes, list[str]] = {}
        self.anywhere: list[str] = []
        for label, automaton in self.automata.items():
            first = automaton.first_words()
            if first is None:
                self.anywhere.append(label)
            for word in first or ():
                self.by_first.setdefault(word, []).append(label)
        longest = {max(words, key=len) for words, _ in self.phrases}
        #: A text that has none of these strings holds neither a phrase nor a template.
        self.needles = None if self.anywhere else sorted(longest | {_rarest(a) for a in self.automata.values()})

    def scan(self, text: bytes | None) -> dict:
        low = (text or b"").lower()
        if self.needles is not None and not any(n in low for n in self.needles):
            n_words = len(word_spans(np.frombuffer(low, dtype=np.uint8), ALPHANUMERIC)[0])
            return {"n_words": n_words, "n_base": 0, "base_labels": "", "labels": "", "score": 0.0, "spans": []}
        words = plain_words(low)
        spans, base = [], []
        for phrase, label in self.phrases:
            begin = -1
            while (begin := _index(words, phrase[0], begin + 1)) >= 0:
                if tuple(words[begin : begin + len(phrase)]) == phrase:
                    base.append((begin, label))
                    spans.append({"label": label, "start": begin, "end": begin + len(phrase)})
        accepted = set()
        starts = [(i, label) for word, labels in self.by_first.items() for i in _all(words, word) for label in labels]
        starts += [(i, label) for i in range(len(words)) for label in self.anywhere]
        for i, label in sorted(starts):
            end = self.automata[label].match(words, i)
            if end is not None:
                accepted.add(label)
                spans.append({"label": label, "start": i, "end": end})
        base_labels = {label for _, label in base}
        return {
            "n_words": len(words),
            "n_base": len(base),
            "first_word": min(base)[0] if base else None,
            "last_word": max(base)[0] if base else None,
            "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(sorted(base_labels | accepted)),
            "score": 1.0 if accepted else 0.5 if base else 0.0,
            "spans": sorted(spans, key=lambda s: (s["start"], s["label"])),
        }


def _index(words: list[bytes], word: bytes, begin: int) -> int:
    try:
        return words.index(word, begin)
    except ValueError:
        return -1


def _all(words: list[bytes], word: bytes) -> list[int]:
    found, at = [], -1
    while (at := _index(words, word, at + 1)) >= 0:
        found.append(at)
    return found


def _rarest(automaton: Automaton) -> bytes:
    """The longest word that every accepted run holds: without it, the end can't be reached."""
    every = sorted({w for table in automaton.words for w in table}, key=lambda w: (-len(w), w))
    for needle in every:
        stack, seen = [0], {0}
        while stack:
            s = stack.pop()
            steps = {t for w, t in automaton.words[s].items() if w != needle} | automaton.free[s]
            if automaton.any_word[s] is not None:
                steps.add(automaton.any_word[s])
            fresh = steps - seen
            seen |= fresh
            stack += fresh
        if automaton.accept not in seen:
            return needle
    return b""


def license_scan(scanner: LicenseScanner | None = None) -> Callable[[Column], Column]:
    """From a text column, a struct of RESULT; positions count words from 0, ends are exclusive."""
    scanner = scanner or LicenseScanner()
    arrow = pa.struct(
        [(n, pa.int64()) for n in RESULT.names[:4]]
        + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
        + [("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]
    )

    ship_package()

    @F.arrow_udf(RESULT)
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([scanner.scan(t) for t in texts.cast(pa.binary()).to_pylist()], arrow)

    return scan
