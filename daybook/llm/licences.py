"""Licence scans by templates of mandatory wording.

A template is a licence's wording in lower-case words, with marked-up regions: ``[...]`` is optional, ``{a-b}`` is replaceable
by a to b words of any kind. All templates are compiled into one automaton over words. A text holds a licence where the
automaton accepts a run of its words: every mandatory word stands there, in order, with nothing between that the markup
does not allow. Two words that can begin a template tell where the automaton needs to start.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import slices

# The phrases that are looked for in any case, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# The wording of licences and notices, with their labels. A label may have several templates.
TEMPLATES = (
    ("mit", "[this [software|work|project|code|file|package] is] [licensed|released|distributed|available] under the [terms of the] mit license"),
    ("mit", """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the rights
        to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to
        whom the software is furnished to do so subject to the following conditions the above copyright notice and this
        permission notice [including the next paragraph] shall be included in all copies or substantial portions of the
        software [the software is provided as is without warranty of any kind express or implied including but not limited
        to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall {1-12} be
        liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out
        of or in connection with the software or the use or other dealings in the software]"""),
    ("isc", """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby
        granted provided that the above copyright notice and this permission notice appear in all copies"""),
    ("bsd", """redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met [1] redistributions of source code must retain the above copyright notice this list of
        conditions and the following disclaimer [2] redistributions in binary form must reproduce the above copyright notice
        this list of conditions and the following disclaimer in the documentation and or other materials provided with the
        distribution"""),
    ("bsd-3-clause", """neither the name of [the] {1-12} nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission"""),
    ("apache-2.0", "licensed under the apache license version 2 0 [the license]"),
    ("apache-2.0", "[released|distributed|available] under the [terms of the] apache license version 2 0"),
    ("gpl-2.0", "[licensed|released|distributed|available] under [the terms of] the gnu general public license version 2"),
    ("gpl-3.0", "[licensed|released|distributed|available] under [the terms of] the gnu general public license version 3"),
    ("gpl", """is free software you can redistribute it and or modify it under the terms of the gnu general public
        license as published by the free software foundation either version {1-2} of the license or at your option any
        later version"""),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2.0", """this source code form is subject to the terms of the mozilla public license v 2 0 [if a copy of the mpl was
        not distributed with this file you can obtain one at {1-8}]"""),
    ("cc-by-nc", "[is] licensed under [a|the] [creative commons] cc by nc [4 0|3 0|2 5|2 0]"),
    ("cc-by-sa", "[is] licensed under [a|the] [creative commons] cc by sa [4 0|3 0|2 5|2 0]"),
    ("cc-by-nc-sa", "[is] licensed under [a|the] [creative commons] cc by nc sa [4 0|3 0|2 5|2 0]"),
    ("cc-by-nc-nd", "[is] licensed under [a|the] [creative commons] cc by nc nd [4 0|3 0|2 5|2 0]"),
    ("cc-by", "[is] licensed under [a|the] creative commons attribution {0-3} license"),
    ("cc0", "cc0 1 0 universal"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", """this software is provided as is without any express or implied warranty in no event will the {1-6} be held
        liable for any damages arising from the use of this software"""),
    ("spdx", "spdx license identifier {1-1}"),
    ("all-rights-reserved", "copyright [c] {1-12} all rights reserved"),
)

#: Ends of runs that are remembered for a state and a word; beyond that they are worked out again.
REMEMBERED = 1 << 16
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARKUP = re.compile(r"\s*(\[|\]|\||\{(\d+)-(\d+)\}|[^\s\[\]|{}]+)")


@dataclass(frozen=True)
class Automaton:
    """Templates over numbered words: edges by state and word, edges by any word, and the templates a state accepts."""

    words: dict[bytes, int]
    moves: dict[int, dict[int, frozenset[int]]]
    free: dict[int, frozenset[int]]
    starts: tuple[frozenset[int], ...]
    accepts: dict[int, frozenset[int]]
    pairs: np.ndarray


def parsed(markup: str) -> list:
    """A template as a sequence of words, (least, most) for replaceable regions, and lists of alternatives for optional ones."""
    stack: list[list[list]] = [[[]]]
    at = 0
    text = markup.strip()
    while at < len(text):
        found = _MARKUP.match(text, at)
        if not found:
            raise ValueError(f"not a template from {text[at : at + 20]!r}")
        at = found.end()
        mark = found.group(1)
        if mark == "[":
            stack.append([[]])
        elif mark == "]":
            if len(stack) < 2:
                raise ValueError("a region ends that did not begin")
            region = stack.pop()
            stack[-1][-1].append(region)
        elif mark == "|":
            if len(stack) < 2:
                raise ValueError("alternatives stand in optional regions")
            stack[-1].append([])
        elif found.group(2) is not None:
            least, most = int(found.group(2)), int(found.group(3))
            if least > most:
                raise ValueError(f"no region of {least} to {most} words")
            stack[-1][-1].append((least, most))
        else:
            if not re.fullmatch(r"[0-9a-z\x80-\U0010ffff]+", mark):
                raise ValueError(f"{mark!r} is no word of a text in lower case")
            stack[-1][-1].append(mark)
    if len(stack) != 1:
        raise ValueError("a region does not end")
    return stack[0][0]


def mandatory(parts: list) -> int:
    """Words that a text must have: those outside optional and replaceable regions."""
    return sum(isinstance(p, str) for p in parts)


def compiled(templates: tuple[str, ...]) -> Automaton:
    """One automaton for all templates; a state without a mandatory word before it accepts nothing."""
    words: dict[bytes, int] = {}
    by_word: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
    by_any: dict[int, set[int]] = defaultdict(set)
    none: dict[int, set[int]] = defaultdict(set)
    states = 0

    def state() -> int:
        nonlocal states
        states += 1
        return states - 1

    def sequence(parts: list, first: int) -> int:
        for part in parts:
            last = state()
            if isinstance(part, str):
                by_word[first][words.setdefault(part.encode(), len(words) + 1)].add(last)
            elif isinstance(part, tuple):
                at = first
                for i in range(part[1]):
                    if i >= part[0]:
                        none[at].add(last)
                    step = state()
                    by_any[at].add(step)
                    at = step
                none[at].add(last)
            else:
                none[first].add(last)
                for alternative in part:
                    none[sequence(alternative, first)].add(last)
            first = last
        return first

    starts, ends = [], {}
    for i, markup in enumerate(templates):
        parts = parsed(markup)
        if not mandatory(parts):
            raise ValueError(f"{markup!r} has no mandatory wording")
        starts.append(state())
        ends[sequence(parts, starts[-1])] = i

    @cache
    def closed(s: int) -> frozenset[int]:
        seen, todo = {s}, [s]
        while todo:
            new = none[todo.pop()] - seen
            seen |= new
            todo += new
        return frozenset(seen)

    def reach(targets: set[int]) -> frozenset[int]:
        return frozenset().union(*map(closed, targets))

    moves = {s: {w: reach(t) for w, t in edges.items()} for s, edges in by_word.items()}
    free = {s: reach(t) for s, t in by_any.items()}
    accepts = {s: frozenset(ends[e] for e in closed(s) if e in ends) for s in range(states)}
    begin = tuple(closed(s) for s in starts)
    pairs = np.zeros((len(words) + 1, len(words) + 1), dtype=bool)
    for s in frozenset().union(*begin):
        for word, after in [*moves.get(s, {}).items(), *([(slice(None), free[s])] if s in free else [])]:
            for t in after:
                pairs[word, list(moves.get(t, {}))] = True
                if t in free or accepts[t]:
                    pairs[word, :] = True
    return Automaton(words, moves, free, begin, {s: a for s, a in accepts.items() if a}, pairs)


class Scanner:
    """Finds where templates stand in numbered words; remembers the steps it took."""

    def __init__(self, templates: tuple[str, ...]):
        self.automaton = compiled(templates)
        self._steps: dict[tuple[frozenset[int], int], tuple[frozenset[int], frozenset[int]]] = {}

    def _step(self, states: frozenset[int], word: int) -> tuple[frozenset[int], frozenset[int]]:
        """(states after a word, templates accepted there)."""
        known = self._steps.get((states, word))
        if known is None:
            a, after = self.automaton, set()
            for s in states:
                after |= a.moves.get(s, {}).get(word, frozenset()) | a.free.get(s, frozenset())
            found = frozenset().union(*(a.accepts.get(s, frozenset()) for s in after))
            known = frozenset(after), found
            if len(self._steps) >= REMEMBERED:
                self._steps.clear()
            self._steps[states, word] = known
        return known

    def numbered(self, words: list[bytes]) -> np.ndarray:
        """A number for each word that a template names, 0 for all others, and a 0 behind the last."""
        number = self.automaton.words.get
        return np.fromiter((number(w, 0) for w in words), np.int32, len(words))

    def places(self, numbers: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, first word, last word + 1) of every place, the shortest run from each first word."""
        if not numbers.any():
            return []
        beside = np.append(numbers[1:], 0)
        found, everything = [], frozenset().union(*self.automaton.starts)
        for first in np.flatnonzero(self.automaton.pairs[numbers, beside]):
            states, seen = everything, set()
            for at in range(first, len(numbers)):
                states, accepted = self._step(states, int(numbers[at]))
                found += ((t, int(first), at + 1) for t in accepted - seen)
                seen |= accepted
                if not states:
                    break
        return found


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(row, n_words, spans) of each row of ``docs``; a span is (template, label, base, mandatory, first, last) in words.

    Words are runs of ASCII letters, lower-cased, digits, and characters beyond ASCII. Base phrases are templates
    without regions. A span is the shortest run that its template accepts from its first word; runs may overlap. Whole
    texts are read, of any length; null texts are empty, without words or spans. Rows are looked at one by one, so
    repeated rows and ids change nothing; an empty table gives none. Other columns are only carried, in ``row``.
    """
    base = PHRASES if phrases is None else phrases
    markups = (*base, *(markup for _, markup in templates))
    labels = (*base.values(), *(label for label, _ in templates))
    lengths = [mandatory(parsed(m)) for m in markups]

    def of(texts: pa.Array) -> pa.Array:
        scanner = Scanner(markups)
        counts, bounds, spans = [], [0], []
        for part in slices(texts):
            for text in pc.ascii_lower(part).cast(pa.binary()):
                words = _WORD.findall(text.as_buffer())
                counts.append(len(words))
                spans += scanner.places(scanner.numbered(words))
                bounds.append(len(spans))
        template, first, last = (np.array([s[i] for s in spans], dtype=np.int64) for i in range(3))
        columns = {
            "template": pa.array(template, pa.int32()),
            "label": pa.array([labels[t] for t in template], pa.string()),
            "base": pa.array(template < len(base), pa.bool_()),
            "mandatory": pa.array([lengths[t] for t in template], pa.int32()),
            "first": pa.array(first, pa.int64()),
            "last": pa.array(last - 1, pa.int64()),
        }
        flat = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat)
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), lists], names=["n_words", "spans"])

    kind = "n_words long, spans array<struct<template int, label string, base boolean, mandatory int, first long, last long>>"
    rows = docs.select(F.struct("*").alias("row"), F.arrow_udf(of, kind)(F.coalesce("text", F.lit(""))).alias("found"))
    return rows.select("row", "found.n_words", "found.spans")


def licences(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of each row of ``docs``.

    The score is w / (w + 1) for the longest wording found, of w mandatory words, and 0 without any: the more words
    agree, the surer the licence. Labels are empty text where there is none. See :func:`scan` for nulls and the rest.
    """
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    longest = F.array_max(F.transform("spans", lambda s: s["mandatory"]))
    firsts = F.transform(base, lambda s: s["first"])
    return scan(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("spans")).alias("labels"),
        F.coalesce(longest / (longest + 1), F.lit(0.0)).alias("score"),
    )
