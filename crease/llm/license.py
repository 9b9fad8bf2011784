"""License scan: a generalised suffix automaton over the words of license
templates streams every text, gives its matching statistics, and long matches
are chained into covered template spans."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from crease.llm.common import frugal, small_batches

# The base phrases and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Wording of public license notices, by label.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and or sell copies "
            "of the software"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License "
               "at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("gpl", "is licensed under the GNU General Public License, version 3"),
    ("gpl", "is free software: you can redistribute it and or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or at your "
            "option any later version"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

#: Bytes between words become spaces, A-Z their lower case; digits, a-z and all above 0x7F are word bytes.
_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c > 0x7F else 32
               for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_WORDS).split()


class Automaton:
    """Generalised suffix automaton of token sequences.

    ``step`` maps a state and the length matched so far over one token to the
    longest suffix that still occurs in some sequence: the matching statistic.
    ``ends[state]`` has, by sequence, all end positions of the state's strings, for
    states whose longest string has ``least`` tokens or more.
    """

    def __init__(self, sequences: list[list[int]], least: int = 1):
        self.next, self.link, self.size, self.ends = [{}], [-1], [0], [{}]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, token in enumerate(sequence):
                last = self._extend(last, token)
                self.ends[last].setdefault(number, set()).add(at)
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            if self.size[self.link[state]] >= least:
                parent = self.ends[self.link[state]]
                for number, at in self.ends[state].items():
                    parent.setdefault(number, set()).update(at)

    def _new(self, size: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.size.append(size)
        self.ends.append({})
        return len(self.size) - 1

    def _extend(self, last: int, token: int) -> int:
        known = self.next[last].get(token)
        if known is not None:
            return known if self.size[known] == self.size[last] + 1 else self._split(last, token, known)
        state, p = self._new(self.size[last] + 1, {}, 0), last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[state] = q if self.size[q] == self.size[p] + 1 else self._split(p, token, q)
        return state

    def _split(self, p: int, token: int, q: int) -> int:
        copy = self._new(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = copy
            p = self.link[p]
        return copy

    def step(self, state: int, length: int, token: int) -> tuple[int, int]:
        while state and token not in self.next[state]:
            state = self.link[state]
            length = self.size[state]
        to = self.next[state].get(token)
        return (0, 0) if to is None else (to, length + 1)


class Scanner:
    """Templates and phrases as one automaton, and the scan of one text."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES, anchor: int = 3, share: float = 0.6, gap: int = 8):
        named = [(label, words_of(t.encode())) for t, label in phrases] + \
                [(label, words_of(t.encode())) for label, t in templates]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in named for w in ws}))}
        self.labels = [label for label, _ in named]
        self.sequences = [[self.vocabulary[w] for w in ws] for _, ws in named]
        self.phrases, self.anchor, self.share, self.gap = len(phrases), anchor, share, gap
        self.automaton = Automaton(self.sequences, anchor)
        a = self.automaton
        # phrases that end where a state's longest string ends
        self.closing: list[tuple] = [()] * len(a.size)
        whole = {}
        for number in range(self.phrases):
            state = 0
            for token in self.sequences[number]:
                state = a.next[state][token]
            whole.setdefault(state, []).append(number)
        for state in sorted(range(1, len(a.size)), key=a.size.__getitem__):
            own = tuple(n for n in whole.get(state, ()))
            self.closing[state] = own + self.closing[a.link[state]]
        self.shortest = min([anchor, *(len(s) for s in self.sequences)])

    def scan(self, text: bytes):
        """(number of words, [(start, label)] of phrases, [(label, start, end, share)] of templates)."""
        words = words_of(text)
        n = len(words)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int32, n)
        hits, anchors = [], []
        edge = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        long = ends - starts >= self.shortest  # no shorter run of known words can hold a phrase or an anchor
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            self._run(ids[start:end].tolist(), start, hits, anchors)
        return n, hits, self._chain(anchors) if anchors else []

    def _run(self, tokens, start, hits, anchors) -> None:
        """Phrases, and by template the longest matches: those that the next word
        does not lengthen.  The states on the suffix links of the present one tell
        what of the text's end stands in the other templates."""
        a, state, length = self.automaton, 0, 0
        step, closing, least = a.step, self.closing, self.anchor
        known: dict[int, tuple[int, int]] = {}
        for at, token in enumerate([*tokens, -1], start):
            state, length = step(state, length, token)
            now: dict[int, tuple[int, int]] = {}
            s, size = state, length
            while size >= least:
                for number in a.ends[s]:
                    now.setdefault(number, (size, s))
                s = a.link[s]
                size = a.size[s]
            for number, (size, s) in known.items():
                if number >= self.phrases and now.get(number, (0, 0))[0] <= size:
                    anchors.append((number, at - size, size, s))
            known = now
            for number in closing[state]:
                if len(self.sequences[number]) <= length:
                    hits.append((at + 1 - len(self.sequences[number]), self.labels[number]))

    def _chain(self, anchors):
        """Chains of matches that cover at least ``share`` of their template.

        Matches of a chain follow each other in text and template, at most ``gap``
        words apart in both; words that two of them share count once.  The heaviest
        chains are kept, each match in one of them.  Among the matches before a match
        only those that end at most ``gap`` words before it can be its predecessor.
        """
        spans, by_template = [], {}
        for number, start, length, state in anchors:
            for end in self.automaton.ends[state][number]:
                by_template.setdefault(number, []).append((start, end + 1 - length, length))
        for number, own in by_template.items():
            own.sort()
            size, weight, before, active = len(self.sequences[number]), [], [], []
            for j, (start, place, length) in enumerate(own):
                best, from_ = length, -1
                active = [i for i in active if own[i][0] + own[i][2] >= start - self.gap]
                for i in active:
                    ahead, above = start - own[i][0] - own[i][2], place - own[i][1] - own[i][2]
                    gain = length + min(0, ahead, above)
                    if own[i][0] < start and own[i][1] < place and above <= self.gap and gain > 0 \
                            and start + length > own[i][0] + own[i][2] and weight[i] + gain > best:
                        best, from_ = weight[i] + gain, i
                weight.append(best)
                before.append(from_)
                active.append(j)
            used: set[int] = set()
            for j in sorted(range(len(own)), key=lambda j: (-weight[j], j)):
                if weight[j] < self.share * size:
                    break
                trail = [j]
                while before[trail[-1]] >= 0:
                    trail.append(before[trail[-1]])
                if used.isdisjoint(trail):
                    used.update(trail)
                    spans.append((self.labels[number], own[trail[-1]][0], own[j][0] + own[j][2], min(1.0, weight[j] / size)))
        return sorted(spans, key=lambda s: (s[1], s[2], s[0]))


_SPAN = StructType([StructField("label", StringType()), StructField("start", LongType()),
                    StructField("end", LongType()), StructField("share", DoubleType())])
_HIT = StructType([StructField("start", LongType()), StructField("label", StringType())])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``(id_col, n_words, phrases, spans)``, one row per row of ``docs``:
    ``phrases`` are the places (start, label) of the base phrases, ``spans`` the
    covered template spans (label, start, end, share), in words from 0.

    Null and empty texts have no words and empty lists; repeated rows give a row
    each; a null id stays null; an empty table stays empty; other columns are not
    read.  Every text is streamed whole; a task holds one text at a time.

    ``settings`` are those of ``Scanner``; ``templates`` may be a table (label,
    text) of license wordings, which goes to every task, so it is read up to
    ``most_templates`` (default 20,000) rows and more are an error.
    """
    small_batches(docs.sparkSession)
    most = settings.pop("most_templates", 20_000)
    if isinstance(settings.get("templates"), DataFrame):
        rows = settings["templates"].dropna().distinct().orderBy("label", "text").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"more than {most} templates")
        settings["templates"] = [(r["label"], r["text"]) for r in rows]
    out = StructType([docs.schema[id_col], StructField("n_words", LongType()), StructField("phrases", ArrayType(_HIT)),
                      StructField("spans", ArrayType(_SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(**settings)
        for batch in batches:
            rows = [scanner.scan(t.as_py() or b"") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([[{"start": s, "label": x} for s, x in r[1]] for r in rows], to_arrow_type(out[2].dataType)),
                 pa.array([[dict(zip(("label", "start", "end", "share"), s)) for s in r[2]] for r in rows],
                          to_arrow_type(out[3].dataType))], out.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("t")).mapInArrow(frugal(run), out)


def report(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per scanned row: counts, first and last base place, labels and a
    score: the best covered share of a template, 1 where a base phrase stands."""
    base, spans = F.col("phrases"), F.col("spans")
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    starts = base["start"]
    return scanned.select(
        id_col, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base["label"]).alias("base_labels"),
        joined(F.concat(base["label"], spans["label"])).alias("labels"),
        F.when(F.size(base) > 0, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce(F.array_max(spans["share"]), F.lit(0.0))))
        .alias("score"))
