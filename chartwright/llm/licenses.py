"""License scans (2): an exact set-similarity join of text blocks with license templates.

A text's blocks are the runs of ``block`` words that begin at every ``block / 2``
words, so each run of at most half a block lies whole in one.  A block matches a
template when it has at least ``threshold`` of the template's distinct words.
All pairs that match are found, without comparing all pairs:

* the templates' words are ordered by their count in all documents, rarest
  first (one aggregation; its result is bounded by the templates);
* prefix: a match shares one of the template's first
  ``n - ceil(threshold * n) + 1`` words, so blocks are found by those alone;
* length: a block of fewer distinct words than needed is skipped;
* position: the words left after the first shared one, in the order of both
  sides, bound what can still be shared;
* what remains is compared exactly.

Templates are a small fixed list, so their index travels with the task.

Beside it, ``PHRASES`` are looked for as consecutive words.

Defined cases: a null or empty text has no words, no labels and score 0.  Equal
containments keep the template first by name.  Repeated rows give repeated
results.  Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwright.llm.words import PLAIN, Words, plain_words, slices, split_words

#: Phrases and the labels they prove.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Notices of public licenses, (label, text).
TEMPLATES = [
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License."),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
BLOCK = 64
THRESHOLD = 0.95


def _tokens(text: str) -> list[bytes]:
    return plain_words(text.encode())


def word_counts(docs: DataFrame, words: set[bytes], *, text_col: str = "text") -> dict[bytes, int]:
    """How often each of some words stands in all documents."""
    listed = sorted(words)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(listed), np.int64)
        number = {w: i for i, w in enumerate(listed)}
        for _, texts in slices(batches, 0):
            found = split_words(texts, PLAIN)
            own = np.bincount(found.codes, minlength=len(found.vocabulary))
            for code, word in enumerate(found.vocabulary):
                if word in number:
                    counts[number[word]] += own[code]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(listed))), pa.array(counts)], ["i", "n"])

    made = docs.select(text_col).mapInArrow(task, "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
    return {w: 0 for w in listed} | {listed[r["i"]]: r["n"] for r in made.collect()}


class Templates:
    """The templates' inverted index over one global word order."""

    def __init__(self, templates: list[tuple[str, str]], counts: dict[bytes, int], threshold: float):
        vocabulary = sorted({w for _, t in templates for w in _tokens(t)}, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(vocabulary)}
        self.sets = [(label, sorted({self.rank[w] for w in _tokens(t)})) for label, t in templates]
        self.need = [ceil(threshold * len(s) - 1e-9) for _, s in self.sets]
        self.index: dict[int, list[tuple[int, int]]] = {}
        for i, (_, s) in enumerate(self.sets):
            for place, r in enumerate(s[: len(s) - self.need[i] + 1]):
                self.index.setdefault(r, []).append((i, place))

    def match(self, block: list[int], n_distinct: int) -> list[tuple[int, float]]:
        """(template, containment) of all that the block matches; ``block``: its ranks, ascending."""
        have = set(block)
        found, tried = [], set()
        for at, r in enumerate(block):
            for i, place in self.index.get(r, ()):
                if i in tried:
                    continue
                tried.add(i)  # the first shared word decides on length and position
                s, need = self.sets[i][1], self.need[i]
                if n_distinct < need or 1 + min(len(s) - place - 1, len(block) - at - 1) < need:
                    continue
                shared = sum(x in have for x in s)
                if shared >= need:
                    found.append((i, shared / len(s)))
        return found


def phrase_starts(words: Words, phrase: str) -> np.ndarray:
    """Where the phrase's words stand consecutively inside one text."""
    tokens = _tokens(phrase)
    codes = [words.code(w) for w in tokens]
    if min(codes) < 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(words.codes == codes[0])
    at = at[at + len(codes) <= len(words.codes)]
    for j, code in enumerate(codes):
        at = at[words.codes[at + j] == code]
    owner = np.searchsorted(words.starts, [at, at + len(codes) - 1], side="right")
    return at[owner[0] == owner[1]]


def block_matches(words: Words, templates: Templates, block: int) -> dict[int, list[tuple[int, int, float]]]:
    """For each text with any: (template, first word of the block, containment)."""
    rank = np.array([templates.rank.get(w, -1) for w in words.vocabulary] or [-1], np.int64)[words.codes]
    at = np.flatnonzero(rank >= 0)
    owner = np.searchsorted(words.starts, at, side="right") - 1
    half = block // 2
    step = (at - words.starts[owner]) // half
    # each word lies in the block that begins at its half and in the one before
    row = np.concatenate((owner, owner[step > 0]))
    number = np.concatenate((step, step[step > 0] - 1))
    ranks = np.concatenate((rank[at], rank[at[step > 0]]))
    prefix = np.isin(ranks, np.fromiter(templates.index, np.int64, len(templates.index)))
    if not prefix.any():
        return {}
    wide = int(number.max()) + 1
    key = row * wide + number
    wanted = np.isin(key, np.unique(key[prefix]))
    pairs = np.unique(np.stack((key[wanted], ranks[wanted])), axis=1)
    cuts = np.flatnonzero(np.diff(pairs[0])) + 1
    found: dict[int, list[tuple[int, int, float]]] = {}
    for keys, own in zip(np.split(pairs[0], cuts), np.split(pairs[1], cuts), strict=True):
        text, first = int(keys[0]) // wide, int(keys[0]) % wide * half
        start = int(words.starts[text]) + first
        distinct = len(np.unique(words.codes[start : min(start + block, int(words.starts[text + 1]))]))
        for i, share in templates.match(own.tolist(), distinct):
            found.setdefault(text, []).append((i, first, share))
    return found


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double,"
    " blocks array<struct<label: string, first_word: long, containment: double>>"
)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None,
         phrases: dict[str, str] | None = None, block: int = BLOCK, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: phrase places, labels, the best containment and every matching block.

    Two passes over the texts (word counts, then the join) and no shuffle of texts.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    if block < 2 * max((len(_tokens(t)) for _, t in templates), default=1):
        raise ValueError("a block must hold twice the longest template")
    counts = word_counts(docs, {w for _, t in templates for w in _tokens(t)}, text_col=text_col)
    index = Templates(templates, counts, threshold)
    source = docs.select(id_col, text_col)
    kind = dict(source.dtypes)[id_col]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"]
    types = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(),
             pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("containment", pa.float64())]))]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            words = split_words(texts, PLAIN)
            blocks = block_matches(words, index, block)
            places: dict[int, list[tuple[int, str]]] = {}
            for phrase, label in phrases.items():
                for at in phrase_starts(words, phrase).tolist():
                    text = int(np.searchsorted(words.starts, at, side="right")) - 1
                    places.setdefault(text, []).append((at - int(words.starts[text]), label))
            made = []
            for i, n in enumerate(words.counts().tolist()):
                base, own = places.get(i, []), blocks.get(i, [])
                proven = {label for _, label in base}
                labels = proven | {index.sets[t][0] for t, _, _ in own}
                starts = [at for at, _ in base]
                score = max([1.0 if base else 0.0, *(share for _, _, share in own)])
                made.append((n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(proven)),
                             ",".join(sorted(labels)), score,
                             [{"label": index.sets[t][0], "first_word": at, "containment": share} for t, at, share in own]))
            columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, *names])

    return source.mapInArrow(task, f"`{id_col}` {kind}, {SCHEMA}")
