"""Licence scans by a positional index of rare words.

The index lists, for each word of the licence templates, the templates and
positions it stands at.  Words weigh by how rare they are in the corpus:
``license_word_counts`` counts, over all texts, in how many each of the
templates' words occurs (the only words counted, so the table has at most
as many rows as the templates have distinct words).

A file looks up its highest-IDF licence words: for each template the RARE
words with the highest IDF among those that both hold.  Each occurrence
votes for where the template would begin (its position in the file less
that in the template).  Votes are intersected by this relative position,
in windows of WINDOW words, each half covered by the next, so a few words
added or left out do no harm; a window in which at least half of the
template's rarest words agree is a candidate.  It is accepted if all the
template's key phrases stand in the stretch of the file it covers, and at
least MIN_SHARE of the template's words stand at their place.  That share
is the match's score.  No candidate is left out, and a text may match many
templates at many places.

Beside the templates there are base phrases, found at all places where
their words follow each other.

A word is a run of bytes other than those of the ASCII characters that are
no letters or digits, after lower-casing A-Z.

Defined results: a null text is the empty text, without words and labels;
repeated rows each give a row; an empty table gives no rows; words are
looked up as they pass, so a long text keeps a number per word only;
equally rare words are taken in byte order; other columns of the input are
not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import col, ship_package, text_of
from tripflow.llm.hashing import text_buffer

RARE = 8
WINDOW = 8
MIN_SHARE = 0.6
SLICE_BYTES = 1 << 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_IN_WORD = np.array([bool(_WORD.match(bytes([b]))) for b in range(256)])


class Template(NamedTuple):
    label: str
    text: str
    phrases: tuple[str, ...]


# Base phrases and their labels.
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Notices of public licences, and the phrases that each must hold.
TEMPLATES = (
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so",
        ("permission is hereby granted", "without restriction"),
    ),
    Template(
        "apache", "Licensed under the Apache License, Version 2.0", ("apache license", "version 2 0")
    ),
    Template(
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
        ("required by applicable law", "conditions of any kind"),
    ),
    Template(
        "gpl",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public license",),
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        ("gnu general public license", "free software foundation"),
    ),
    Template(
        "lgpl",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation",
        ("gnu lesser general public license",),
    ),
    Template(
        "agpl",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation",
        ("gnu affero general public license",),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        ("redistribution and use in source", "following conditions are met"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        ("permission to use copy modify", "with or without fee"),
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license",),
    ),
    Template("cc-by", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-nd", "Licensed under CC BY-ND 4.0", ("cc by nd",)),
    Template(
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution 4 0",),
    ),
    Template(
        "cc-by-sa",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        ("creative commons attribution sharealike",),
    ),
    Template(
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        ("creative commons attribution noncommercial",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ("free and unencumbered software", "public domain"),
    ),
    Template(
        "boost",
        "Distributed under the Boost Software License, Version 1.0",
        ("boost software license",),
    ),
)


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


class Match(NamedTuple):
    label: str
    start: int
    score: float


class Vocabulary:
    """The words of templates and base phrases, numbered in byte order."""

    def __init__(self, templates: Sequence[Template], phrases: Sequence[tuple[str, str]]):
        texts = [p for p, _ in phrases] + [t.text for t in templates] + [p for t in templates for p in t.phrases]
        self.words = sorted({w for text in texts for w in words_of(text)})
        self.number = {w: i for i, w in enumerate(self.words)}
        self.base = [(self.ids(p), label) for p, label in phrases]
        self.templates = [(t.label, self.ids(t.text), [self.ids(p) for p in t.phrases]) for t in templates]

    def ids(self, text: str) -> np.ndarray:
        return np.array([self.number[w] for w in words_of(text)], np.int32)

    def look_up(self, data: bytes) -> np.ndarray:
        """The number of each word of a text (UTF-8), -1 for other words;
        words are held a slice at a time."""
        found, begin, get = [], 0, self.number.get
        while begin < len(data):
            end = min(len(data), begin + SLICE_BYTES)
            part = data[begin:end].lower()
            if end < len(data):  # up to the last byte that is in no word
                other = np.flatnonzero(~_IN_WORD[np.frombuffer(part, np.uint8)])
                if len(other):
                    part = part[: int(other[-1]) + 1]
                else:  # one word longer than a slice
                    word = _WORD.match(data[begin:].lower())
                    part = word.group()
            words = _WORD.findall(part)
            found.append(np.fromiter((get(w, -1) for w in words), np.int32, len(words)))
            begin += len(part)
        return np.concatenate(found) if found else np.zeros(0, np.int32)


def phrase_starts(ids: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the words of ``phrase`` follow each other in ``ids``."""
    if not len(phrase) or len(ids) < len(phrase):
        return np.zeros(0, np.int64)
    at = np.flatnonzero(ids[: len(ids) - len(phrase) + 1] == phrase[0])
    for i in range(1, len(phrase)):
        at = at[ids[at + i] == phrase[i]]
    return at


class RareWordIndex:
    """Postings of the templates' words, with the words' IDF."""

    def __init__(self, vocabulary: Vocabulary, counts: dict[int, int], n_texts: int):
        self.vocabulary = vocabulary
        idf = [math.log((n_texts + 1) / (counts.get(i, 0) + 1)) for i in range(len(vocabulary.words))]
        #: words by falling IDF; equally rare ones in byte order
        order = sorted(range(len(idf)), key=lambda i: (-idf[i], i))
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self.postings: list[dict[int, np.ndarray]] = []
        self.holders: list[list[int]] = [[] for _ in order]
        for t, (_, words, _) in enumerate(vocabulary.templates):
            own = {int(w): np.flatnonzero(words == w) for w in np.unique(words)}
            self.postings.append(own)
            for w in own:
                self.holders[w].append(t)
        #: the words of each template's key phrases, without which it can't match
        self.required = [{w for k in keys for w in k.tolist()} for _, _, keys in vocabulary.templates]

    def rarest(self, ids: np.ndarray) -> dict[int, list[int]]:
        """For each template, its highest-IDF words that the file holds;
        templates with a key word that it doesn't hold are left out."""
        present = np.unique(ids[ids >= 0])
        held = set(present.tolist())
        chosen: dict[int, list[int]] = {t: [] for t, words in enumerate(self.required) if words <= held}
        if chosen:
            for w in present[np.argsort(self.rank[present])].tolist():
                for t in self.holders[w]:
                    if t in chosen and len(chosen[t]) < RARE:
                        chosen[t].append(w)
        return chosen

    def matches(self, ids: np.ndarray) -> list[Match]:
        """Accepted templates in a file's word numbers, by start and label."""
        chosen = self.rarest(ids)
        places: dict[int, np.ndarray] = {}
        phrases: dict[bytes, np.ndarray] = {}
        found = set()
        for t, rare in chosen.items():
            label, words, keys = self.vocabulary.templates[t]
            need = max(2, -(-min(RARE, len(self.postings[t])) // 2))
            if len(rare) < need:
                continue
            starts, voter = [], []
            for w in rare:
                if w not in places:
                    places[w] = np.flatnonzero(ids == w)
                for p in self.postings[t][w].tolist():
                    starts.append(places[w] - p)
                    voter.append(np.full(len(places[w]), w, np.int64))
            start, voter = np.concatenate(starts), np.concatenate(voter)
            half = WINDOW // 2
            cell = np.floor_divide(start, half)
            cell = np.concatenate([cell, cell - 1])  # windows [cell * half, cell * half + WINDOW)
            base = int(cell.min())
            votes = np.unique((cell - base) * len(self.rank) + np.concatenate([voter, voter]))
            window, agree = np.unique(votes // len(self.rank), return_counts=True)
            for low in ((window[agree >= need] + base) * half).tolist():
                if not all(self._holds(ids, k, low, low + WINDOW + len(words), phrases) for k in keys):
                    continue
                share, at = self._share(ids, words, low)
                if share >= MIN_SHARE:
                    found.add(Match(label, at, share))
        return sorted(found, key=lambda m: (m.start, m.label, -m.score))

    @staticmethod
    def _holds(ids, phrase, low, high, known) -> bool:
        key = phrase.tobytes()
        if key not in known:
            known[key] = phrase_starts(ids, phrase)
        at = known[key]
        i = np.searchsorted(at, low)
        return i < len(at) and at[i] + len(phrase) <= high

    @staticmethod
    def _share(ids, words, low) -> tuple[float, int]:
        """Share of the template's words that stand at their place for some
        start in the window, and the first of those places."""
        there = np.zeros(len(words), bool)
        first = len(ids)
        for start in range(low, low + WINDOW):
            a, b = max(0, -start), min(len(words), len(ids) - start)
            if a < b:
                same = ids[start + a : start + b] == words[a:b]
                there[a:b] |= same
                if same.any():
                    first = min(first, start + a + int(np.argmax(same)))
        return float(there.mean()), first


def _texts(batch: pa.RecordBatch, at: int) -> Iterator[bytes]:
    data, offsets = text_buffer(batch.column(at))
    for i in range(batch.num_rows):
        yield data[offsets[i] : offsets[i + 1]].tobytes()


def license_word_counts(df: DataFrame, text_col: str, vocabulary: Vocabulary) -> tuple[dict[int, int], int]:
    """Texts that hold each word of the vocabulary, and the number of texts.

    A task counts its own texts; at most one row per vocabulary word
    reaches the driver.
    """
    ship_package(df.sparkSession)

    def count(batches):
        total, n = np.zeros(len(vocabulary.words) + 1, np.int64), 0
        for batch in batches:
            for data in _texts(batch, 0):
                ids = vocabulary.look_up(data)
                total[np.unique(ids[ids >= 0])] += 1
                n += 1
        total[-1] = n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["word", "n"])

    counted = df.select(text_of(text_col).alias("text")).mapInArrow(count, "word int, n long")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r.word: r.n for r in rows}
    return counts, counts.pop(len(vocabulary.words), 0)


_PLACE = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType())])
_MATCH = T.StructType([*_PLACE.fields, T.StructField("score", T.DoubleType())])


def scan_licenses(
    df: DataFrame,
    id_col: str,
    text_col: str,
    templates: Sequence[Template] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = BASE_PHRASES,
) -> DataFrame:
    """One row per input row: the id column, n_words, ``places`` (label and
    first word of each base phrase, by start) and ``matches`` (label, first
    word and score of each template found).  Two passes over the texts:
    word counts, then the scan."""
    ship_package(df.sparkSession)
    vocabulary = Vocabulary(templates, phrases)
    index = RareWordIndex(vocabulary, *license_word_counts(df, text_col, vocabulary))
    rows = df.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    out = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("places", T.ArrayType(_PLACE)),
            T.StructField("matches", T.ArrayType(_MATCH)),
        ]
    )
    place = pa.struct([("label", pa.string()), ("start", pa.int64())])
    match = pa.struct([("label", pa.string()), ("start", pa.int64()), ("score", pa.float64())])

    def scan(batches):
        for batch in batches:
            n_words, places, matches = [], [], []
            for data in _texts(batch, 1):
                ids = vocabulary.look_up(data)
                n_words.append(len(ids))
                own = [(int(s), label) for p, label in vocabulary.base for s in phrase_starts(ids, p)]
                places.append([{"label": label, "start": s} for s, label in sorted(own)])
                matches.append([m._asdict() for m in index.matches(ids)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(places, pa.list_(place)),
                    pa.array(matches, pa.list_(match)),
                ],
                out.fieldNames(),
            )

    return rows.mapInArrow(scan, out).withColumnRenamed("id", id_col)


def license_labels(found: DataFrame, id_col: str) -> DataFrame:
    """The report of ``scan_licenses``: n_base (places of base phrases),
    first_word and last_word (their smallest and largest start),
    base_labels, labels (the templates' too; both distinct, sorted and
    joined by commas) and score (the best match's, 0 without one)."""
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return found.select(
        col(id_col),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"),
        joined(F.col("places.label")).alias("base_labels"),
        joined(F.concat("places.label", "matches.label")).alias("labels"),
        F.coalesce(F.array_max("matches.score"), F.lit(0.0)).alias("score"),
    )
