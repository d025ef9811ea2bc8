"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Words are lower-cased and freed of marks around them.  The hashes of ``GRAM`` words in a row are
winnowed (the least of each ``WINDOW`` neighbours stays), so any passage of GRAM + WINDOW - 1 words
shared with a template shares a fingerprint.  The templates' fingerprints form an inverted index,
a fixed table.  Hits on nearby diagonals make a candidate, and a local alignment of the template
within a band around the diagonal gives the words matched and the span in the text.

A template is reported where it covers ``COVERAGE`` of its words; of overlapping reports the one
with more words matched stays.  Null and empty texts and texts with no license give no rows.
Of equal reports the earlier span and then the first template in the list stays.  Rows are
independent: repeated rows are reported each, and an empty table gives none.  Texts of any length
are scanned whole.  Only doc_id and text are read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import _text as t
from ._session import table

GRAM, WINDOW = 3, 2
COVERAGE = 0.8
#: Words by which a template may drift off its diagonal, at least, and as a share of its words; but
#: twice that is less than its words, so that a notice next to this one lies outside the band.
DRIFT, DRIFT_SHARE = 3, 0.15
MATCH, MISMATCH, GAP = 2, -1, -1

#: License notices, and openings of license texts, as they are published.
TEMPLATES = {
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
        "Released under the MIT License.",
        "Licensed under the MIT License.",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "BSD-3-Clause": ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        "Licensed under the Apache License, Version 2.0.",
        'Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. "Licensor" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.',
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble The licenses for most software are designed to take away your freedom to share and change it.",
    ),
    "LGPL-2.1": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        'Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.',
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
}
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def word_hashes(block: t.Block) -> tuple[t.Words, np.ndarray]:
    """The words of a block and the hash of each, in lower case and without marks around it."""
    words = t.words(block)
    a, b = words.start.copy(), words.end.copy()
    while (move := (a < b - 1) & _MARK[block.data[a]]).any() if len(a) else False:
        a += move
    while (move := (a < b - 1) & _MARK[block.data[b - 1]]).any() if len(a) else False:
        b -= move
    return words, t.span_hash(block.data, a, b, lower=True)


def winnowed(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and the word at which each starts."""
    grams = t.mix(t.ngrams(hashes, GRAM))
    ok = t.whole(at, GRAM, len(grams))
    keep = np.zeros(len(grams), bool)
    single = ok.copy()
    for shift in range(1, WINDOW):
        both = ok[:-shift] & ok[shift:]
        single[:-shift] &= ~both
        single[shift:] &= ~both
        first = grams[:-shift] < grams[shift:]
        keep[:-shift] |= both & first
        keep[shift:] |= both & ~first
    where = np.flatnonzero(keep | single)
    return grams[where], where


@cache
def _index():
    """The templates' names and word hashes, and their fingerprints in order."""
    names = [k for k, texts in TEMPLATES.items() for _ in texts]
    block = next(t.blocks(pa.array([x for texts in TEMPLATES.values() for x in texts]), 1 << 40))
    words, hashes = word_hashes(block)
    grams, where = winnowed(hashes, words.at)
    order = np.argsort(grams, kind="stable")
    return names, [hashes[a:b] for a, b in zip(words.at[:-1], words.at[1:], strict=True)], grams[order], words.doc[where][order], (where - words.at[words.doc[where]])[order]


def align(template: np.ndarray, text: np.ndarray, shift: int, drift: int) -> tuple[int, int, int]:
    """Words matched and the first and last word of text of the best local alignment in which
    word i of the template stays within ``drift`` of word i + shift of the text."""
    m, n, width = len(template), len(text), 2 * drift + 1
    score = np.zeros((m + 1, width + 2), np.int64)  # column d + 1: text word i + shift + d - drift
    step = np.zeros((m + 1, width + 2), np.int8)  # 1 both, 2 template only, 3 text only
    best, at = 0, None
    for i in range(1, m + 1):
        j = i - 1 + shift + np.arange(width) - drift
        inside = (j >= 0) & (j < n)
        same = inside & (text[np.clip(j, 0, max(n - 1, 0))] == template[i - 1])
        both = np.where(inside, score[i - 1, 1:-1] + np.where(same, MATCH, MISMATCH), 0)
        skip = score[i - 1, 2:] + GAP
        row = np.maximum(0, np.maximum(both, skip))
        kind = np.where(row == 0, 0, np.where(both >= skip, 1, 2))
        ramp = np.arange(width) * GAP
        run = np.maximum.accumulate(row - ramp) + ramp  # text words left out one after another
        kind = np.where(run > row, 3, kind)
        score[i, 1:-1], step[i, 1:-1] = run, kind
        if run.max() > best:
            best, at = int(run.max()), (i, int(run.argmax()) + 1)
    if at is None:
        return 0, 0, 0
    i, d = at
    stop, matched = i - 1 + shift + d - 1 - drift, 0
    first = stop
    while i > 0 and step[i, d]:
        kind, j = step[i, d], i - 1 + shift + d - 1 - drift
        if kind == 1:
            matched += int(text[j] == template[i - 1])
            first = j
            i -= 1
        elif kind == 2:
            i, d = i - 1, d + 1
        else:
            d -= 1
    return matched, first, stop


def find(block: t.Block, coverage: float = COVERAGE) -> list[tuple]:
    """(document, license, template words, matched words, first byte, last byte) of each report."""
    names, templates, keys, owner, place = _index()
    words, hashes = word_hashes(block)
    grams, where = winnowed(hashes, words.at)
    low, high = np.searchsorted(keys, grams, "left"), np.searchsorted(keys, grams, "right")
    hit = np.flatnonzero(high > low)
    pairs = sorted({(int(words.doc[where[h]]), int(owner[k]), int(where[h] - words.at[words.doc[where[h]]] - place[k])) for h in hit for k in range(low[h], high[h])})
    found, last = [], None
    for doc, number, shift in pairs:
        template = templates[number]
        drift = min(max(DRIFT, int(DRIFT_SHARE * len(template))), (len(template) - 1) // 2)
        if last and last[:2] == (doc, number) and shift - last[2] <= drift:
            continue  # the same candidate
        last = (doc, number, shift)
        text = hashes[words.at[doc] : words.at[doc + 1]]
        matched, first, stop = align(template, text, shift, drift + drift)
        if matched >= coverage * len(template):
            a = words.at[doc]
            found.append((doc, number, matched, int(words.start[a + first]), int(words.end[a + stop])))
    found.sort(key=lambda x: (x[0], -x[2], len(templates[x[1]]), x[3], x[1]))
    kept: list[tuple] = []
    starts, stops = [], []  # of the spans kept in the current document, which are disjoint, in order
    for x in found:
        if not kept or kept[-1][0] != x[0]:
            starts, stops = [], []
        k = bisect_right(stops, x[3])
        if k == len(starts) or starts[k] >= x[4]:
            starts.insert(k, x[3])
            stops.insert(k, x[4])
            kept.append(x)
    return [(doc, names[k], len(templates[k]), matched, a, b) for doc, k, matched, a, b in sorted(kept, key=lambda x: (x[0], x[3]))]


SCHEMA = "doc_id long, license string, template_words long, matched_words long, coverage double, start long, end long"


def scan(docs: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """A row for each license notice: its coverage and its span in code points, end exclusive."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in t.blocks(batch.column("text")):
                out = find(block, coverage)
                if out:
                    points = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
                    doc = np.array([x[0] for x in out])
                    a, b = (points[np.array([x[k] for x in out])] - points[block.at[doc]] for k in (4, 5))
                    size, matched = np.array([x[2] for x in out]), np.array([x[3] for x in out])
                    ids = batch.column("doc_id").slice(block.first, block.rows).take(pa.array(doc))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([x[1] for x in out]), pa.array(size), pa.array(matched), pa.array(matched / size), pa.array(a), pa.array(b)], [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(t.released(rows), SCHEMA)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
