"""License scans: MinHash bands over overlapping windows, verified by shingle containment.

Templates are grouped by the size of their shingle set into classes up to a power of two
``s``. For each class a text is covered by windows of ``2 s`` shingles that begin every ``s``,
so that any passage of ``s`` shingles lies in one window. A window that holds 80 percent of a
template of the class has a Jaccard similarity of at least 0.19 with it, so ``BANDS`` bands of
one MinHash each meet with a chance of more than 1 - 2e-9. Windows without any shingle of a
template have similarity 0 and are not hashed. Every retrieved pair is then verified by
counting the template's distinct shingles in the window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.words import LOWER_DIGITS, batches, mix, shingles, text_buffer, words

WORDS = 5
BANDS = 96
#: The templates are settings that every task holds; more than this is an error.
MAX_TEMPLATE_BYTES = 32 << 20

# Everything in ASCII but letters and digits parts words.
_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_SEEDS = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

# Customary wordings of public license notices.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("LGPL", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND", "Licensed under CC BY-ND 4.0."),
    ("CC0", "This work has been dedicated to the public domain under CC0 1.0 Universal."),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced without permission."),
]


def _read(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Shingle hashes, which are whole, first shingle of each text, and first bytes and ends of the words."""
    data, at = text_buffer(column)
    hashes, first, end, starts = words(data, at, _APART, LOWER_DIGITS)
    found, whole = shingles(hashes, starts, WORDS)
    return found, whole, starts, first, end, at


def _band_keys(least: np.ndarray) -> np.ndarray:
    """Keys of MinHash values, one row per band, under which a band's values meet no other band's."""
    return mix(least + np.arange(1, len(least) + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15))


class Templates:
    """Shingle sets and MinHashes of the templates, by size class."""

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        found, whole, starts, *_ = _read(pa.array([t for _, t in rows], pa.string()))
        self.names = [n for n, _ in rows]
        self.sets = [np.unique(found[a:b][whole[a:b]]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        every = np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64)
        self.every = np.unique(every)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.every & np.uint64((1 << 20) - 1)] = True
        # Per class, the bands as one index: sorted (band, value) keys, and the template of each.
        self.classes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in sorted({self._class(s) for s in self.sets if len(s)}):
            own = np.array([i for i, s in enumerate(self.sets) if len(s) and self._class(s) == size])
            least = np.array([[mix(self.sets[i] ^ seed).min() for seed in _SEEDS] for i in own])
            keys = _band_keys(least.T)
            order = np.argsort(keys, axis=None, kind="stable")
            self.classes[size] = keys.ravel()[order], np.broadcast_to(own, keys.shape).ravel()[order]

    @staticmethod
    def _class(tokens: np.ndarray) -> int:
        return 1 << (len(tokens) - 1).bit_length()

    def hits(self, found: np.ndarray) -> np.ndarray:
        """Places of shingles that any template has."""
        at = np.flatnonzero(self.maybe[found & np.uint64((1 << 20) - 1)])
        if not len(at) or not len(self.every):
            return at[:0]
        where = np.searchsorted(self.every, found[at])
        where[where == len(self.every)] = 0
        return at[self.every[where] == found[at]]


def window_ranges(size: int, n: int) -> list[tuple[int, int]]:
    """Windows of a text of ``n`` shingles for the class of ``size``."""
    return [(a, min(a + 2 * size, n)) for a in range(0, max(n, 0), size)]


def _candidates(templates: Templates, found: np.ndarray, hits: np.ndarray, a: int, n: int, size: int):
    """Windows with a hit of the text whose ``n`` shingles begin at ``a``, and the templates they meet in a band."""
    block = np.unique((hits - a) // size)
    window = np.unique(np.concatenate([block, block - 1]))
    window = window[window >= 0]
    lo, hi = window * size, np.minimum(window * size + 2 * size, n)
    keys, owner = templates.classes[size]
    inside = np.concatenate([np.arange(x, y) for x, y in zip(lo + a, hi + a, strict=True)])
    cuts = np.concatenate(([0], np.cumsum(hi - lo)[:-1]))
    tokens = found[inside]
    low = _band_keys(np.stack([np.minimum.reduceat(mix(tokens ^ seed), cuts) for seed in _SEEDS]))
    left, right = np.searchsorted(keys, low, "left"), np.searchsorted(keys, low, "right")
    met = np.nonzero(right > left)
    pairs = {(w, int(t)) for w, x, y in zip(met[1].tolist(), left[met], right[met], strict=True) for t in owner[x:y]}
    for w, t in sorted(pairs):
        yield int(lo[w]) + a, int(hi[w]) + a, t


def scan_licenses(
    df: DataFrame, templates: DataFrame, id_col: str = "doc_id", text: str = "text", num: int = 80, den: int = 100
) -> DataFrame:
    """``doc_id``, ``license``, ``template``, ``n_shared``, ``n_template``, ``start`` and ``end`` per found template.

    ``templates(license, text)`` holds the wordings. Words are runs of letters and digits (all
    bytes above ASCII count as letters), A-Z lower-cased, with all digits alike so that versions
    don't matter; shingles have five words. A template is found in a row if a window holds
    ``num / den`` of its distinct shingles; the row reports its window with the most of them (the
    first of several), ``template`` numbering the distinct wordings by license and text, and
    ``start`` and ``end`` the bytes from the first to the last shared shingle there. Null, empty
    and shorter texts and templates have no shingles and are never found. Rows without an id
    are reported with a null id, repeated rows each on their own; other columns are ignored and
    empty tables give no rows. One pass over whole texts, no shuffle.
    """
    bound = templates.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    if bound > MAX_TEMPLATE_BYTES:
        raise ValueError(f"templates hold {bound} bytes, more than {MAX_TEMPLATE_BYTES}")
    rows = templates.select("license", "text").na.drop().distinct().collect()
    shared = df.sparkSession.sparkContext.broadcast(Templates(sorted((r["license"], r["text"]) for r in rows)))
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches(parts):
            found, whole, starts, first, end, at = _read(batch.column(1))
            out: list[tuple] = []
            hits = known.hits(found)
            hits = hits[whole[hits]]
            doc_of = np.searchsorted(starts, hits, "right") - 1
            for doc in np.unique(doc_of).tolist():
                a, n = int(starts[doc]), int(starts[doc + 1] - starts[doc]) - WORDS + 1
                best: dict[int, tuple] = {}
                for size in known.classes:
                    for lo, hi, t in _candidates(known, found, hits[doc_of == doc], a, n, size):
                        tokens = known.sets[t]
                        held = np.isin(found[lo:hi], tokens)
                        count = len(np.unique(found[lo:hi][held]))
                        if den * count >= num * len(tokens) and count > best.get(t, (0,))[0]:
                            places = np.flatnonzero(held) + lo
                            span = first[places[0]] - at[doc], end[places[-1] + WORDS - 1] - at[doc]
                            best[t] = (count, len(tokens), *map(int, span))
                number = batch.column(0)[doc].as_py()
                out += [(number, known.names[t], t, *v) for t, v in sorted(best.items())]
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "license", "template", "n_shared", "n_template", "start", "end"],
            )

    schema = "doc_id long, license string, template long, n_shared long, n_template long, start long, end long"
    return docs.mapInArrow(run, schema)
