"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

Templates and texts are cut into lower-cased words and five-word shingles (a template of fewer
words is one shingle of that length). Templates are put into classes by their number of shingles;
for each class a text is covered by overlapping windows, a quarter of their length apart, and a
window's MinHash signature has BANDS bands of ROWS values each. A window that shares a band with
a template is a candidate. Around it the greatest share of the template's distinct shingles that
one stretch of (1 + SLACK) times the template's length holds is computed exactly; a match holds
at least CONTAINED of them.

With containment c >= 0.8, a window of up to RATIO times the template's length and an offset of
at most an eighth of the window, the Jaccard similarity is at least ``worst_jaccard()``, so that
a band meets with probability ``collision(worst_jaccard())``, over 0.999. Templates of one
shingle are found by that shingle's hash itself.

A class has one band table, so a window is looked up by its BANDS values, however many templates
there are.

Null and empty texts have no match and give no row; repeated rows give their matches again; a very
long text is covered by windows whole; an empty table gives none; extra columns are ignored. Of
equally good matches the first in the text counts. A row per document and license.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.scratch import small_batches
from weftline.llm.textcode import U, column_bytes, constants, grams, lower_table, mix, ranges, slices, span_hashes, word_spans

SHINGLE = 5
CONTAINED = 0.8
SLACK = 0.25
BANDS, ROWS = 24, 1
RATIO = 1.5
_TABLE = lower_table(word=bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))
_HASH = constants(BANDS * ROWS, 61)

# Notices that name or open public licenses.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "all-rights-reserved": ["All rights reserved."],
}


def collision(jaccard: float) -> float:
    """The probability that a window and a template share a band."""
    return 1 - (1 - jaccard**ROWS) ** BANDS


def worst_jaccard(contained: float = CONTAINED, ratio: float = RATIO) -> float:
    """The least similarity of the best placed window to a template that a text contains."""
    shared = contained - ratio / 8  # the window may miss an eighth of its length at one end
    return shared / (1 + ratio - shared)


class Templates:
    def __init__(self, texts: dict[str, list[str]]):
        self.names = sorted(texts)
        self.sets: list[tuple[int, np.ndarray, int]] = []  # license, distinct shingles, words of a shingle
        for i, name in enumerate(self.names):
            for t in texts[name]:
                h, _ = _words(column_bytes(pa.array([t])))
                k = min(SHINGLE, len(h))
                if k:
                    self.sets.append((i, np.unique(grams(h, k)), k))
        # classes of one shingle length whose numbers of shingles differ by RATIO at most
        self.classes: list[tuple[int, int, list[int]]] = []  # words of a shingle, shingles of a window, templates
        for t in sorted(range(len(self.sets)), key=lambda t: (self.sets[t][2], -len(self.sets[t][1]))):
            _, s, k = self.sets[t]
            if self.classes and self.classes[-1][0] == k and self.classes[-1][1] <= RATIO * len(s):
                self.classes[-1][2].append(t)
            else:
                self.classes.append((k, len(s), [t]))
        self.bands = [Bands(size, [self.sets[t][1] for t in members]) if size > 1 else None for _, size, members in self.classes]


def _words(bytes_: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    flat, start, end, first = word_spans(*bytes_, _TABLE)
    return span_hashes(flat, start, end), first


class Bands:
    """The band table of templates that go with one size of window: for each band its values and whose they are."""

    def __init__(self, size: int, sets: list[np.ndarray]):
        self.size, self.count = size, len(sets)
        self.values, self.owners = [], []
        for band in range(BANDS):
            of = np.array([_band(np.array([mix(s ^ c).min() for c in _HASH[band * ROWS : band * ROWS + ROWS]], np.uint64)[:, None])[0] for s in sets], np.uint64)
            order = np.argsort(of, kind="stable")
            self.values.append(of[order])
            self.owners.append(order)

    def windows(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(template, start) of every window of ``size`` hashes that shares a band with a template."""
        stride = max(1, self.size // 4)
        lead = np.arange(0, len(h), stride)
        most = -(-self.size // stride)
        found = []
        for band, (values, owners) in enumerate(zip(self.values, self.owners)):
            rows = []
            for c in _HASH[band * ROWS : band * ROWS + ROWS]:
                block = np.minimum.reduceat(mix(h ^ c), lead)
                least = block.copy()
                for j in range(1, min(most, len(lead))):
                    least[: len(lead) - j] = np.minimum(least[: len(lead) - j], block[j:])
                rows.append(least)
            key = _band(np.stack(rows))
            first = np.searchsorted(values, key)
            count = np.searchsorted(values, key, "right") - first
            at = np.flatnonzero(count)
            found.append(owners[ranges(first[at], count[at])] * len(lead) + np.repeat(at, count[at]))
        both = np.unique(np.concatenate(found))
        return both // len(lead), lead[both % len(lead)]


def _band(rows: np.ndarray) -> np.ndarray:
    """One value of the ROWS minima of a band."""
    return rows[0] if len(rows) == 1 else grams(rows.T.ravel(), len(rows), 62)[:: len(rows)]


def _candidates(h: np.ndarray, size: int, sets: list[np.ndarray], bands: Bands | None = None) -> list[np.ndarray]:
    """For each template the starts of windows of ``size`` hashes that share a band with it."""
    if size == 1:
        return [np.flatnonzero(h == s[0]) for s in sets]
    which, start = (bands or Bands(size, sets)).windows(h)
    return [start[which == k] for k in range(len(sets))]


def best_containment(h: np.ndarray, shingles: np.ndarray, width: int) -> tuple[float, int, int]:
    """The greatest share of ``shingles`` in ``width`` consecutive hashes, and where its first and last stand."""
    at = np.minimum(np.searchsorted(shingles, h), len(shingles) - 1)
    place = np.flatnonzero(shingles[at] == h)
    which = at[place].tolist()
    count: dict[int, int] = {}
    best, lo = (0.0, 0, 0), 0
    for hi, w in enumerate(which):
        count[w] = count.get(w, 0) + 1
        while place[hi] - place[lo] >= width:
            count[which[lo]] -= 1
            if not count[which[lo]]:
                del count[which[lo]]
            lo += 1
        if len(count) / len(shingles) > best[0]:
            best = len(count) / len(shingles), int(place[lo]), int(place[hi])
    return best


def find(templates: Templates, bytes_: tuple[np.ndarray, np.ndarray]) -> dict[tuple[int, int], tuple[float, int, int, int]]:
    """(text, license) -> (containment, windows that match, first word, last word) of its best match."""
    words, first = _words(bytes_)
    out: dict[tuple[int, int], tuple[float, int, int, int]] = {}
    for (k, size, members), bands in zip(templates.classes, templates.bands):
        h = grams(words, k)
        if not len(h):
            continue
        found = _candidates(h, size, [templates.sets[t][1] for t in members], bands)
        for t, starts in zip(members, found):
            name, shingles, _ = templates.sets[t]
            width = int(np.ceil(len(shingles) * (1 + SLACK)))
            text = np.searchsorted(first, starts, "right") - 1
            seen: dict[int, set[tuple[int, int]]] = {}
            for d, a in zip(text.tolist(), starts.tolist()):
                # a window may begin in the text before; look at both
                for doc in {d, min(d + 1, len(first) - 2)}:
                    lo, hi = max(int(first[doc]), a - width), min(int(first[doc + 1]) - k + 1, a + size + width)
                    if hi <= lo:
                        continue
                    share, x, y = best_containment(h[lo:hi], shingles, width)
                    if share < CONTAINED:
                        continue
                    spans = seen.setdefault(doc, set())
                    spans.add((lo + x, lo + y))
                    best = out.get((doc, name), (0.0, 0, 0, 0))
                    if share > best[0] or share == best[0] and lo + x < best[2] + int(first[doc]):
                        out[doc, name] = share, best[1], lo + x - int(first[doc]), lo + y + k - 1 - int(first[doc])
            for doc, spans in seen.items():
                share, n, x, y = out[doc, name]
                out[doc, name] = share, n + len(spans), x, y
    return out


def licenses(docs: DataFrame, texts: dict[str, list[str]] = TEMPLATES, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """``doc_id, license, containment, n_matches, first_word, last_word``, a row per document and license found."""
    small_batches(docs.sparkSession)
    base = docs.select(F.col(ident).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(texts)
        for batch in batches:
            for piece in slices(batch, "text"):
                found = sorted(find(templates, column_bytes(piece.column("text"))).items())
                rows = pa.array([d for (d, _), _ in found], pa.int64())
                cols = [piece.column("doc_id").take(rows), pa.array([templates.names[x] for (_, x), _ in found], pa.string()), pa.array([v[0] for _, v in found], pa.float64())]
                cols += [pa.array([v[j] for _, v in found], pa.int64()) for j in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "license", "containment", "n_matches", "first_word", "last_word"])

    return base.mapInArrow(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, license string, containment double, n_matches long, first_word long, last_word long")


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    """All ``documents``: a row per document and license found; null and empty texts, and an empty table, give none."""
    return licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
