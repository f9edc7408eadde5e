"""License scan by a positional index of rare template words.

Every template (a clause or a notice of a licence) is words in a row. A word's IDF counts the templates
it occurs in; the highest-IDF places of a template are its anchors. A text's words that are anchors of
some template are looked up: each posting (template, place) says where the template would begin, and
beginnings on which enough anchors of one template meet are candidates. A candidate holds if enough of
the template's IDF stands within a few words of its place and every mandatory key phrase stands inside.

Texts never move; the index has the size of the templates and is sent to all tasks.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import chunks, ragged, texts_of


class Template(NamedTuple):
    label: str
    text: str
    keys: tuple[str, ...]


# Phrases that label a text wherever they stand.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of public licences, with the phrases that must be there.
TEMPLATES = (
    Template("mit-notice", "released under the MIT License", ("mit license",)),
    Template("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", ("permission is hereby granted", "deal in the software without restriction")),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("apache-2.0-text", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ("in compliance with the license", "apache org licenses license 2 0")),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("gpl-2.0", "licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("gpl-text", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version", ("gnu general public license", "free software foundation")),
    Template("lgpl-text", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license", "free software foundation")),
    Template("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "following conditions are met")),
    Template("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission", ("endorse or promote products derived from this software",)),
    Template("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("for any purpose with or without fee is hereby granted",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license v 2 0",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
)

#: Anchors of a template, share of them that must meet, words by which a place may be off, share of the
#: template's IDF that must stand at its place.
ANCHORS, MEET, DRIFT, SHARE = 8, 0.5, 2, 0.7
#: Bytes of a text that are cut into words at once.
CUT_BYTES = 4 << 20

#: A-Z in lower case, letters, digits and bytes of other letters as they are, anything else a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class SortedPlaces:
    """Beginnings of stretches of one size, none over another."""

    def __init__(self) -> None:
        self.begins: list[int] = []

    def add(self, begin: int, size: int) -> bool:
        k = bisect_left(self.begins, begin - size + 1)
        free = k == len(self.begins) or self.begins[k] >= begin + size
        if free:
            self.begins.insert(k, begin)
        return free


class Index:
    """Postings of the templates' anchors, and what verifies a candidate."""

    def __init__(self, templates: Sequence[Template], base: dict[str, str], anchors: int, meet: float, drift: int, share: float):
        self.drift, self.share = drift, share
        self.labels = [t.label for t in templates]
        texts = [words_of(t.text.encode()) for t in templates]
        keys = [[words_of(k.encode()) for k in t.keys] for t in templates]
        phrases = [(words_of(p.encode()), label) for p, label in base.items()]
        said = [w for words in (*texts, *(k for own in keys for k in own), *(p for p, _ in phrases)) for w in words]
        self.number = {w: k for k, w in enumerate(dict.fromkeys(said))}
        coded = lambda words: np.array([self.number[w] for w in words], np.int32)
        self.templates = [coded(words) for words in texts]
        self.keys = [[coded(k) for k in own] for own in keys]
        self.base = [(coded(p), label) for p, label in phrases if p]
        found = Counter(w for words in self.templates for w in set(words.tolist()))
        self.idf = np.zeros(len(self.number))
        for w, n in found.items():
            self.idf[w] = math.log((1 + len(texts)) / n)
        postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.need = []
        for t, words in enumerate(self.templates):
            chosen = sorted(range(len(words)), key=lambda q, words=words: (-self.idf[words[q]], q))[:anchors]
            self.need.append(max(1, math.ceil(meet * len(chosen))))
            for q in chosen:
                postings[int(words[q])].append((t, q))
        flat = [(t, q) for w in range(len(self.number)) for t, q in postings[w]]
        self.posted = np.array(flat, np.int64).reshape(-1, 2)
        self.many = np.array([len(postings[w]) for w in range(len(self.number))] + [0], np.int64)  # at -1: none
        self.first = np.cumsum(self.many) - self.many

    def phrase_starts(self, ids: np.ndarray, phrase: np.ndarray) -> np.ndarray:
        here = np.arange(max(len(ids) - len(phrase) + 1, 0))
        for k, w in enumerate(phrase):
            here = here[ids[here + k] == w]
        return here

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """``(template, beginning)`` on which enough anchors meet."""
        at = np.flatnonzero(self.many[ids])
        if not len(at):
            return []
        many = self.many[ids[at]]
        posted = self.posted[ragged(self.first[ids[at]], many)]
        begin = np.repeat(at, many) - posted[:, 1]
        both, votes = np.unique(np.stack([posted[:, 0], begin], axis=1), axis=0, return_counts=True)
        return [(t, o) for (t, o), n in zip(both.tolist(), votes.tolist(), strict=True) if n >= self.need[t]]

    def share_at(self, ids: np.ndarray, t: int, begin: int) -> float:
        """Share of the template's IDF that stands within the drift of its place; 0 if a key phrase is missing."""
        words, off = self.templates[t], self.drift
        near = ids[max(begin - off, 0) : max(begin + len(words) + off, 0)]
        if any(not len(self.phrase_starts(near, k)) for k in self.keys[t]):
            return 0.0
        held = np.full(len(words) + 2 * off, -1, np.int64)
        a = max(off - begin, 0)
        held[a : a + len(near)] = near
        stands = np.zeros(len(words), bool)
        for e in range(2 * off + 1):
            stands |= held[e : e + len(words)] == words
        weight = self.idf[words]
        return float(weight[stands].sum() / weight.sum())

    def places(self, ids: np.ndarray) -> list[tuple[str, int, int, float]]:
        """``(label, start, past the end, share)`` of the templates found, none over another of its kind."""
        held: dict[int, list[tuple[float, int]]] = defaultdict(list)
        for t, begin in self.candidates(ids):
            if (share := self.share_at(ids, t, begin)) >= self.share:
                held[t].append((-share, begin))
        out = []
        for t, own in held.items():
            size, taken = len(self.templates[t]), SortedPlaces()
            for less, begin in sorted(own):
                if taken.add(begin, size):
                    out.append((self.labels[t], max(begin, 0), min(begin + size, len(ids)), -less))
        return sorted(out, key=lambda p: (p[1], p[0]))


def _coded(index: Index, text: bytes) -> np.ndarray:
    """Numbers of a text's words, -1 for words of no template."""
    parts, a = [], 0
    while a < len(text):
        b = min(a + CUT_BYTES, len(text))
        while b < len(text) and _TABLE[text[b]] != 32:  # not inside a word
            b += 1
        words = words_of(text[a:b])
        parts.append(np.fromiter(map(index.number.get, words, repeat(-1)), np.int32, len(words)))
        a = b
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


_ADDED = "n_words long, base array<struct<label:string,start:bigint>>, places array<struct<label:string,start:bigint,end:bigint,share:double>>"


def _scan(index_of, text: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of.value
        known = np.zeros(len(index.number) + 1, bool)  # words that begin anything
        known[: len(index.number)] = index.many[:-1] > 0
        for phrase, _ in index.base:
            known[phrase[0]] = True
        for batch in chunks(batches, text):
            sizes, bases, places = [], [], []
            for t in texts_of(batch, text):
                ids = _coded(index, t)
                sizes.append(len(ids))
                if not known[ids].any():
                    bases.append([]), places.append([])
                    continue
                starts = [(int(p), label) for phrase, label in index.base for p in index.phrase_starts(ids, phrase)]
                bases.append([{"label": label, "start": p} for p, label in sorted(starts)])
                places.append([dict(zip(("label", "start", "end", "share"), p, strict=True)) for p in index.places(ids)])
            made = {"n_words": sizes, "base": bases, "places": places}
            columns = [pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name).cast(f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    templates: Sequence[Template] = TEMPLATES,
    base: dict[str, str] = BASE_PHRASES,
    anchors: int = ANCHORS,
    meet: float = MEET,
    drift: int = DRIFT,
    share: float = SHARE,
) -> DataFrame:
    """The input columns but the text, with ``n_words, base, places, labels, score``.

    ``base`` lists where the base phrases stand, ``places`` where templates do (words from 0, past the
    end, and the share of the template's IDF found), ``labels`` all labels of both, sorted, and
    ``score`` is the largest share, 0 if no template was found. Equal places of one template are
    taken by falling share, then by beginning; one that overlaps a taken one is left out. A template
    that begins before the text or ends past it may hold. NULL and empty texts have no words; long ones
    are read whole, four bytes a word; repeated rows stay. An empty table gives no rows. Input columns
    that bear an added name are replaced.
    """
    for t in templates:
        if not t.keys or any(k not in b" ".join(words_of(t.text.encode())).decode() for k in t.keys):
            raise ValueError(f"{t.label}: key phrases must be words of the template")
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    added = ("n_words", "base", "places", "labels", "score")
    carried = [c for c in docs.columns if c.lower() not in (*added, text.lower())]
    source = docs.select(*carried, F.col(text).cast("string").alias("__text"))
    fields = ", ".join([*(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in carried), _ADDED])
    sent = spark.sparkContext.broadcast(Index(templates, base, anchors, meet, drift, share))
    arrow = to_arrow_schema(spark.createDataFrame([], fields).schema)
    found = source.mapInArrow(_scan(sent, "__text", arrow), fields)
    every = F.array_sort(F.array_distinct(F.concat(F.transform("base", lambda b: b["label"]), F.transform("places", lambda p: p["label"]))))
    best = F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0))
    return found.withColumn("labels", every).withColumn("score", best)
