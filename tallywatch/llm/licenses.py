"""License texts and notices in documents: MinHash bands over overlapping windows, then exact containment.

A window of a document has as many shingles (three words) as the template it is held against, and windows begin every
quarter of that, so some window lies within an eighth of a copy's place. A copy with CONTAINMENT of the template's
shingles then has a Jaccard similarity of at least `least_similarity()` with that window, and the BANDS of ROWS draws
miss it with a probability below `miss_probability()`; exact copies are missed less than once in a million. The
minimum over a window of any length is that of two shorter ones with a power of two of shingles, so all templates share
one pass per draw.

Where a band agrees, the share of the template's shingles found in the window and half its length on both sides decides.
Words are compared in lower case and without punctuation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm.decontaminate import plain_words
from tallywatch.llm.words import mix, rows_of, slices, whole_windows, window_hashes

SHINGLE = 3
BANDS = 20
ROWS = 2
CONTAINMENT = 0.8

# Public notices and the paragraphs that identify a license.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
                 "License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("BSD", "Released under the BSD License."),
    ("BSD", "Licensed under the BSD License."),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Licensed under the ISC License."),
    ("All rights reserved", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)


def least_similarity(containment: float = CONTAINMENT) -> float:
    """Jaccard similarity of a template with the best window over a copy that holds `containment` of its shingles."""
    shared = containment - 1 / 8
    return shared / (2 - shared)


def miss_probability(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    return (1 - similarity ** rows) ** bands


@dataclass
class Template:
    license: str
    shingles: np.ndarray
    size: int  # shingles, repeated ones included

    @property
    def step(self) -> int:
        return max(1, self.size // 4)


def _shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words, first = plain_words(texts)
    return window_hashes(words, SHINGLE), first


def templates(named: tuple[tuple[str, str], ...] = TEMPLATES) -> list[Template]:
    """Templates of three words or more."""
    out = []
    for name, text in named:
        found, _ = _shingles(pa.array([text.lower()]))
        if len(found):
            out.append(Template(name, np.unique(found), len(found)))
    return out


def _levels(drawn: np.ndarray, longest: int) -> list[np.ndarray]:
    """Minima over 1, 2, 4 ... values from each position on."""
    levels = [drawn]
    while 2 << (len(levels) - 1) <= longest:
        half = 1 << (len(levels) - 1)
        last = levels[-1]
        levels.append(np.minimum(last[: max(0, len(last) - half)], last[half:]))
    return levels


def _minima(levels: list[np.ndarray], size: int, at: np.ndarray) -> np.ndarray:
    """Minimum over `size` values from each of the positions on."""
    level = size.bit_length() - 1
    return np.minimum(levels[level][at], levels[level][at + size - (1 << level)])


class Index:
    """Templates with the keys of their bands, per window size and band in order, so that the search of a window's key
    takes as long with many templates of a size as with few."""

    def __init__(self, known: list[Template]):
        self.known = known
        self.sizes = sorted({t.size for t in known})
        self.bands: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        keys = np.zeros((BANDS, len(known)), np.uint64)
        for band in range(BANDS):
            for row in range(ROWS):
                lowest = np.array([mix(t.shingles, _salt(band, row)).min() for t in known], np.uint64)
                keys[band] = mix(keys[band] ^ lowest)
        # Which upper bits the keys of a size and band have: nearly all windows are ruled out by one look.
        self.coarse: dict[int, list[np.ndarray]] = {}
        for size in self.sizes:
            own = np.array([i for i, t in enumerate(known) if t.size == size])
            orders = [np.argsort(keys[band][own], kind="stable") for band in range(BANDS)]
            self.bands[size] = [(keys[band][own][order], own[order]) for band, order in enumerate(orders)]
            self.coarse[size] = [np.zeros(1 << 16, dtype=bool) for _ in range(BANDS)]
            for band in range(BANDS):
                self.coarse[size][band][(keys[band][own] >> np.uint64(48)).astype(np.int64)] = True

    def sizes_of(self, band: int) -> list[int]:
        """Window sizes that a band looks at: a window of one shingle is found by the first band if by any."""
        return [size for size in self.sizes if size > 1 or not band]

    def look_up(self, size: int, band: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the keys, and the templates of that size that have them."""
        wanted, template = self.bands[size][band]
        some = np.flatnonzero(self.coarse[size][band][(keys >> np.uint64(48)).astype(np.int64)])
        low, high = (np.searchsorted(wanted, keys[some], side) for side in ("left", "right"))
        n = high - low
        which = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(some, n), template[which]


def _salt(band: int, row: int) -> int:
    return band * ROWS + row + 1


def scan(texts: pa.Array, index: Index, containment: float = CONTAINMENT) -> list[tuple[int, int, int, float]]:
    """Row, template, position (words before the first shared shingle) and containment of the best place of each."""
    known, sizes = index.known, index.sizes
    found, first = _shingles(texts)
    rows = rows_of(first)
    n_shingles = np.diff(first) - SHINGLE + 1
    if not len(found) or not known:
        return []
    places = {}
    inside = np.arange(len(rows)) - first[:-1][rows]
    for size in sizes:
        step = max(1, size // 4)
        # Windows begin every `step` shingles of a row, and one ends with it; a shorter row is one window.
        last = np.maximum(n_shingles - size, 0)[rows]
        places[size] = np.flatnonzero((n_shingles[rows] > 0) & ((inside % step == 0) & (inside < last) | (inside == last)))
    whole = whole_windows(first, SHINGLE)
    candidates: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
    longest = max(sizes)
    for band in range(BANDS):
        looked_at = index.sizes_of(band)
        keys = {size: np.zeros(len(places[size]), np.uint64) for size in looked_at}
        for row in range(ROWS):
            drawn = np.where(whole, mix(found, _salt(band, row)), np.uint64(2**64 - 1))  # no shingle reaches into the next row
            padded = np.concatenate([drawn, np.full(longest, 2**64 - 1, np.uint64)])
            levels = _levels(padded, longest)
            for size in looked_at:
                keys[size] = mix(keys[size] ^ _minima(levels, size, places[size]))
        for size in looked_at:
            at, which = index.look_up(size, band, keys[size])
            candidates.append(np.column_stack([which, places[size][at]]))
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for i, start in np.unique(np.concatenate(candidates), axis=0).tolist():
        template, row = known[i], int(rows[start])
        low = max(int(first[row]), start - template.size // 2)
        high = min(int(first[row]) + int(n_shingles[row]), start + template.size + template.size // 2)
        shared = np.isin(found[low:high], template.shingles)
        share = len(np.unique(found[low:high][shared])) / len(template.shingles)
        if share >= containment - 1e-9:
            place = low + int(np.argmax(shared)) - int(first[row])
            best[i, row] = max(best.get((i, row), (0.0, 0)), (share, -place))
    return [(row, i, -place, share) for (i, row), (share, place) in best.items()]


def find_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", named: tuple[tuple[str, str], ...] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per row of `docs` and license found in it: key, license, begin (words before it) and containment.

    Of several templates of a license the best match counts. NULL texts and texts of fewer than three words hold none;
    keys may be NULL or repeated. The templates, a fixed list, go to every task; no shuffle.
    """
    known = templates(named)
    index = Index(known)
    schema = T.StructType([
        T.StructField("key", docs.schema[key].dataType), T.StructField("license", T.StringType()),
        T.StructField("begin", T.LongType()), T.StructField("containment", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                best: dict[tuple[int, str], tuple[float, int]] = {}
                for row, i, place, share in scan(part["text"], index, containment):
                    at = (row, known[i].license)
                    best[at] = max(best.get(at, (0.0, 0)), (share, -place))
                yield pa.RecordBatch.from_arrays([
                    part["key"].take(pa.array([row for row, _ in best], pa.int64())),
                    pa.array([name for _, name in best], pa.string()),
                    pa.array([-place for _, place in best.values()], pa.int64()),
                    pa.array([share for share, _ in best.values()], pa.float64()),
                ], names=["key", "license", "begin", "containment"])

    lowered = docs.select(docs[key].alias("key"), F.lower(docs[text]).alias("text"))
    return lowered.mapInArrow(run, schema).withColumnRenamed("key", key)
