"""Licence scans with a generalised suffix automaton over the words of templates.

The automaton of all templates is walked with the words of a file; at every word it
gives the longest run ending there that any template contains (matching statistics),
and its suffix links give the longest run of every other template place. Runs of
``MIN_RUN`` words or more that cannot be longer in their own template are chained per
template, in the order of both texts, into spans; a template whose words a chain covers
to ``MIN_COVER`` adds its label and a span for each place where one does. Short base phrases are templates too: each place where one stands is found as
a suffix of the current run.

Only words that stand beside each other in some template can lie in a run of two, so
array operations pick those stretches out of a slice of texts and only they are
walked; everything between resets the automaton. Templates are a parameter of checked
size and travel with the task; nothing is shuffled.

Defined results: a null or wordless text has no words, no places and score 0; equal
phrases under several labels give each label; places may overlap and all count;
repeated rows are scanned alike; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kindred.llm import blocks
from kindred.llm.decontaminate import normal_words

MIN_RUN = 4
MIN_COVER = 0.75
#: Words between the runs of a chain, in the file, at most.
MAX_GAP = 12
#: Words of all templates at most (every state is a few hundred bytes in each worker).
MAX_TEMPLATE_WORDS = 200_000

#: The base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Notices by which the public licences are recognised.
TEMPLATES = (
    ("licensed under the apache license version 2.0", "apache-2.0"),
    ("you may obtain a copy of the license at http www apache org licenses license 2.0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files to deal in the software without restriction", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met", "bsd"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation", "gpl"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu "
     "lesser general public license", "lgpl"),
    ("licensed under cc by 4.0", "cc-by-4.0"),
    ("licensed under cc by nc 4.0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4.0", "cc-by-sa-4.0"),
    ("this work is licensed under a creative commons attribution 4.0 international license", "cc-by-4.0"),
    ("this source code form is subject to the terms of the mozilla public license v 2.0", "mpl-2.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)


@dataclass
class State:
    length: int = 0
    link: int = -1
    next: dict[int, int] = field(default_factory=dict)
    ends: list[tuple[int, int]] = field(default_factory=list)  # template, its word after the run
    bases: list[tuple[int, int]] = field(default_factory=list)  # base phrase and its length, ending here


class Automaton:
    """Generalised suffix automaton of word lists; the first ``bases`` lists are base phrases."""

    def __init__(self, lists: Sequence[Sequence[bytes]], bases: int):
        if sum(map(len, lists)) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words: deal them into several scans")
        self.words = {w: i for i, w in enumerate(dict.fromkeys(w for words in lists for w in words))}
        self.lengths = [len(words) for words in lists]
        self.states = [State()]
        for number, words in enumerate(lists):
            last = 0
            for place, word in enumerate(words):
                last = self._add(last, self.words[word])
                self.states[last].ends.append((number, place + 1))
        by_length = sorted(range(1, len(self.states)), key=lambda s: self.states[s].length)
        for s in reversed(by_length):  # ends of a run are ends of its suffixes
            up = self.states[self.states[s].link]
            up.ends = list(dict.fromkeys([*up.ends, *self.states[s].ends]))
        for number, words in enumerate(lists[:bases]):
            s = 0
            for word in words:
                s = self.states[s].next[self.words[word]]
            self.states[s].bases.append((number, len(words)))
        for s in by_length:
            self.states[s].bases += self.states[self.states[s].link].bases
        ids = self.ids = [[self.words[w] for w in words] for words in lists]
        self.beside = np.zeros((len(self.words), len(self.words)), bool)
        for words in ids:
            self.beside[words[:-1], words[1:]] = True
        names = list(self.words)
        ends = np.cumsum([len(w) for w in names])
        hashes = blocks.word_hashes(np.frombuffer(b"".join(names), np.uint8), ends - [len(w) for w in names], ends)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def _add(self, last: int, word: int) -> int:
        states = self.states
        if word in states[last].next:
            q = states[last].next[word]
            return q if states[q].length == states[last].length + 1 else self._split(last, q, word)
        new = len(states)
        states.append(State(states[last].length + 1))
        p = last
        while p != -1 and word not in states[p].next:
            states[p].next[word] = new
            p = states[p].link
        if p == -1:
            states[new].link = 0
        else:
            q = states[p].next[word]
            states[new].link = q if states[q].length == states[p].length + 1 else self._split(p, q, word)
        return new

    def _split(self, p: int, q: int, word: int) -> int:
        states, copy = self.states, len(self.states)
        states.append(State(states[p].length + 1, states[q].link, dict(states[q].next)))
        while p != -1 and states[p].next.get(word) == q:
            states[p].next[word] = copy
            p = states[p].link
        states[q].link = copy
        return copy

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for words of no template."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def statistics(self, words: Sequence[int]) -> list[tuple[int, int]]:
        """State and length of the longest run that ends at each word."""
        out, state, length, states = [], 0, 0, self.states
        for w in words:
            while state and w not in states[state].next:
                state = states[state].link
                length = states[state].length
            if w in states[state].next:
                state, length = states[state].next[w], length + 1
            else:
                length = 0
            out.append((state, length))
        return out

    def runs(self, words: Sequence[int], found: Sequence[tuple[int, int]], least: int
             ) -> Iterator[tuple[int, int, int, int]]:
        """Template, start in ``words``, start in the template and length of every run of
        ``least`` words or more that is longer on neither side; ``found``: statistics of ``words``."""
        for i, (state, length) in enumerate(found):
            following, seen = words[i + 1] if i + 1 < len(words) else -1, set()
            while length >= least:  # shorter suffixes stand at more places
                for number, end in self.states[state].ends:
                    if (number, end) not in seen:
                        seen.add((number, end))
                        own = self.ids[number]
                        if end == len(own) or own[end] != following:
                            yield number, i + 1 - length, end - length, length
                state = self.states[state].link
                length = self.states[state].length


def _best(runs: list[tuple[int, int, int]], max_gap: int) -> list[tuple[int, int, int]]:
    """Template words covered, file start and file end of the best chain that ends with
    each of the sorted ``runs`` (file start, template start, length)."""
    found: list[tuple[int, int, int]] = []
    near: list[tuple[int, int, int, int]] = []  # heap: file end, covered, file start, template end
    for at, place, size in runs:
        while near and near[0][0] < at - max_gap:  # no later run can join
            heappop(near)
        end = (size, at)
        for upto, covered, begin, used in near:
            skip = max(0, used - place, upto - at)  # overlap counts once
            if skip < size and place + size > used:
                end = max(end, (covered + size - skip, begin))
        heappush(near, (at + size, *end, place + size))
        found.append((*end, at + size))
    return found


def _outside(runs: list[tuple[int, int, int]], spans: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
    """What ascending, disjoint ``spans`` of the file leave of ``runs``: before, between and after them."""
    starts = [a for a, _ in spans]
    left: list[list[tuple[int, int, int]]] = [[] for _ in range(len(spans) + 1)]
    for at, place, size in runs:
        k, end = bisect_right(starts, at), at + size
        begin = max(at, spans[k - 1][1]) if k else at
        while begin < end:
            upto = min(end, spans[k][0]) if k < len(spans) else end
            if upto - begin >= MIN_RUN:
                left[k].append((begin, place + begin - at, upto - begin))
            if k == len(spans):
                break
            begin, k = spans[k][1], k + 1
    return left


def chains(runs: list[tuple[int, int, int]], least: float, max_gap: int = MAX_GAP) -> list[tuple[int, int, int]]:
    """Template words covered, file start and file end of disjoint chains that cover
    ``least`` words or more, in the order of the file. The best one is taken, then the
    best of what lies outside it, and so on; chains never reach across a taken one."""
    found: list[tuple[int, int, int]] = []
    pieces = [sorted(runs)]
    while pieces:
        piece = pieces.pop()
        ends = _best(piece, max_gap)
        top = max((covered for covered, _, _ in ends), default=0)
        if top < least:
            continue
        taken: list[tuple[int, int]] = []  # equally good ones at once, the last first
        for begin, upto in sorted(((b, u) for covered, b, u in ends if covered == top), reverse=True):
            if not taken or upto <= taken[-1][0]:
                taken.append((begin, upto))
        found += [(top, *span) for span in taken]
        pieces += [sorted(rest) for rest in _outside(piece, taken[::-1]) if rest]
    return sorted(found, key=lambda c: c[1])


def scan(docs: DataFrame, base: Sequence[tuple[str, str]] = BASE, templates: Sequence[tuple[str, str]] = TEMPLATES,
         text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels
    (both comma-joined), score and spans (label, start, end in words, cover)."""
    lists = [normal_words(t.encode()) for t, _ in (*base, *templates)]
    names = [label for _, label in (*base, *templates)]
    built: list[Automaton] = []

    def of(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        if not built:
            built.append(Automaton(lists, len(base)))
        auto = built[0]
        starts, ends, first = blocks.spans(data, offsets, blocks.ALPHANUMERIC)
        words = auto.known(blocks.word_hashes(data, starts, ends, blocks.LOWER))
        # Neighbours of one text that are neighbours in a template.
        pair = np.zeros(len(words), bool)
        pair[:-1] = (words[:-1] >= 0) & (words[1:] >= 0) & auto.beside[words[:-1], words[1:]]
        pair[first[1:][first[1:] > 0] - 1] = False
        rise = np.flatnonzero(pair & ~np.concatenate([[False], pair[:-1]]))
        fall = np.flatnonzero(~pair & np.concatenate([[False], pair[:-1]])) + 1
        owner = np.searchsorted(first, rise, "right") - 1
        places: dict[int, list[tuple[int, int]]] = {}
        runs: dict[int, dict[int, list[tuple[int, int, int]]]] = {}
        for a, b, row in zip(rise.tolist(), fall.tolist(), owner.tolist(), strict=True):
            stretch = words[a:b].tolist()
            at, found = a - int(first[row]), auto.statistics(stretch)
            for i, (state, length) in enumerate(found):
                for number, size in auto.states[state].bases:
                    if size <= length:
                        places.setdefault(row, []).append((at + i + 1 - size, number))
            for number, start, place, size in auto.runs(stretch, found, MIN_RUN):
                if number >= len(base):
                    runs.setdefault(row, {}).setdefault(number, []).append((at + start, place, size))
        table = []
        for row in range(part.num_rows):
            held = places.get(row, [])
            own = {names[n] for _, n in held}
            spans = []
            for number, some in runs.get(row, {}).items():
                for covered, begin, upto in chains(some, MIN_COVER * auto.lengths[number]):
                    spans.append({"label": names[number], "start": begin, "end": upto,
                                  "cover": covered / auto.lengths[number]})
            score = 1.0 if held else max((s["cover"] for s in spans), default=0.0)
            table.append((int(first[row + 1] - first[row]), len(held), min((p for p, _ in held), default=None),
                          max((p for p, _ in held), default=None), ",".join(sorted(own)),
                          ",".join(sorted(own | {s["label"] for s in spans})), score, spans))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([
            ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())]))]
        return [pa.array([r[i] for r in table], kind) for i, kind in enumerate(kinds)]

    return blocks.add_columns(docs, _COLUMNS, of, text)


_COLUMNS = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
            "score double, spans array<struct<label:string,start:bigint,end:bigint,cover:double>>")
