"""License scan: MinHash bands over overlapping text windows, then exact
shingle containment.

A template is a license notice.  Windows are laid over the shingles that occur in
some template, in text order, and broken where more than ``max_gap`` words
without such a shingle come between two: words put into a notice, up to that many
in a place, do not make it longer.  Templates of like length share a window width
and stride, chosen so that an occurrence lies whole in some window.
Windows and templates have MinHash signatures over five-word shingles; a window
retrieves the templates with which it agrees on a whole band.  The number of
bands is set per class so that a window that holds an occurrence with
``containment`` of the template's shingles retrieves it with probability
``recall`` or more.  What is retrieved is verified by exact containment.

Text without any shingle of a template costs a lookup of its words.  Of
overlapping matches the one with most shingles of its template is reported, so a
notice is given the most specific of several alike.  No shuffle; templates
are sent to the tasks (their number is up to the caller, their size is
checked).
"""

from __future__ import annotations

import math
from bisect import bisect
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from postlake.llm.common import with_python_columns
from postlake.llm.decontaminate import WORD, normal_words

SHINGLE = 5
ROWS = 2  # hash values in a band
MAX_TEMPLATE_BYTES = 16 << 20

#: Wordings of license notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                 "(at your option) any later version."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
                     "binary form must reproduce the above copyright notice, this list of conditions and the following "
                     "disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
                     "binary form must reproduce the above copyright notice, this list of conditions and the following "
                     "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither "
                     "the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                "option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
                 "(at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                 "(at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
             "held liable for any damages arising from the use of this software."),
)


def shingles(words: list[bytes]) -> list[bytes]:
    return [b" ".join(words[i:i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def bands_for(similarity: float, recall: float) -> int:
    """Bands of ``ROWS`` values so that sets of that Jaccard similarity agree
    on one with probability ``recall``: 1 - (1 - s^ROWS)^bands >= recall."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity ** ROWS))) if similarity < 1 else 1


class Index:
    """Templates by window class and band."""

    def __init__(self, templates: list[tuple[str, str]], containment: float, recall: float):
        self.names, self.sets, self.words = [], [], set()
        by_class: dict[int, list[int]] = defaultdict(list)
        lengths = []
        for name, text in templates:
            s = shingles(normal_words(text))
            if not s:
                raise ValueError(f"template of {name} has fewer than {SHINGLE} words: {text!r}")
            by_class[len(set(s)).bit_length()].append(len(self.names))
            self.names.append(name)
            lengths.append(len(s))
            self.sets.append(frozenset(s))
            self.words.update(normal_words(text))
        self.vocabulary = frozenset().union(*self.sets) if self.sets else frozenset()
        self.classes = []
        most = 1
        for k, members in sorted(by_class.items()):
            # distinct shingles of a template in this class at least; its shingles at most, repeats included
            low, high = 1 << (k - 1), max(lengths[m] for m in members)
            # an occurrence may be longer than its template by shingles of others that come between
            longest = math.ceil(high / containment)
            stride = max(1, low // 2)
            width = longest + stride - 1
            # worst case: the shortest template with the least containment, all else in the window foreign
            least = containment * low / (width + (1 - containment) * low)
            bands = bands_for(least, recall)
            most = max(most, bands)
            self.classes.append((width, stride, bands, members))
        rng = np.random.default_rng(5)
        self.a = rng.integers(1, 1 << 63, most * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, most * ROWS, dtype=np.uint64)
        self.tables: list[dict[tuple[int, bytes], list[int]]] = []
        for _, _, bands, members in self.classes:
            found: dict[tuple[int, bytes], list[int]] = defaultdict(list)
            for m in members:
                for key in self.keys(list(self.sets[m]), bands):
                    found[key].append(m)
            self.tables.append(dict(found))

    def keys(self, own: list[bytes], bands: int) -> list[tuple[int, bytes]]:
        h = np.fromiter((xxhash.xxh64_intdigest(s) for s in own), np.uint64, len(own))
        n = bands * ROWS
        low = (h[:, None] * self.a[None, :n] + self.b[None, :n]).min(axis=0)
        return [(i, low[i * ROWS:(i + 1) * ROWS].tobytes()) for i in range(bands)]


def known_shingles(words: list[bytes], index: Index) -> list[tuple[int, bytes]]:
    """(first word, shingle) of the shingles that occur in some template."""
    known, run, hits = index.words, 0, []
    for i, w in enumerate(words):
        run = run + 1 if w in known else 0
        if run >= SHINGLE:
            s = b" ".join(words[i - SHINGLE + 1:i + 1])
            if s in index.vocabulary:
                hits.append((i - SHINGLE + 1, s))
    return hits


def stretches(hits: list[tuple[int, bytes]], max_gap: int) -> list[list[tuple[int, bytes]]]:
    """``hits`` broken where more than ``max_gap`` words lie between two."""
    out: list[list[tuple[int, bytes]]] = []
    for hit in hits:
        if out and hit[0] - out[-1][-1][0] - SHINGLE <= max_gap:
            out[-1].append(hit)
        else:
            out.append([hit])
    return out


def scan(text: str | None, index: Index, containment: float, max_gap: int = 200) -> list[tuple[str, float, int, int]]:
    """(license, containment, first word, end word) of the matches, by first
    word.  Of overlapping matches the best is reported: most shingles, then
    the highest containment."""
    best = []
    for own in stretches(known_shingles(normal_words(text), index), max_gap):
        for (width, stride, bands, _), table in zip(index.classes, index.tables):
            for a in range(0, max(1, len(own) - width + stride), stride):
                part = own[a:a + width]
                distinct = {s for _, s in part}
                for m in {m for key in index.keys(list(distinct), bands) for m in table.get(key, ())}:
                    shared = index.sets[m] & distinct
                    share = len(shared) / len(index.sets[m])
                    if share >= containment:
                        at = [p for p, s in part if s in shared]
                        best.append((share, len(shared), index.names[m], at[0], at[-1] + SHINGLE))
    out: list[tuple[str, float, int, int]] = []
    taken: list[tuple[int, int]] = []  # disjoint, sorted by start
    for share, _, name, a, b in sorted(best, key=lambda x: (-x[1], -x[0], x[4] - x[3], x[3], x[2])):
        i = bisect(taken, (a, b))
        if (i == 0 or taken[i - 1][1] <= a) and (i == len(taken) or b <= taken[i][0]):
            taken.insert(i, (a, b))
            out.append((name, share, a, b))
    return sorted(out, key=lambda x: (x[2], x[0]))


def find_licenses(docs: DataFrame, text_col: str = "text", templates: list[tuple[str, str]] | None = None,
                  containment: float = 0.8, recall: float = 0.999, max_gap: int = 200,
                  keep: list[str] | None = None) -> DataFrame:
    """License notices in each text.

    Returns the input rows with the columns in ``keep`` (default: all),
    ``licenses`` (distinct names, sorted) and ``matches``: license,
    containment (share of the template's distinct five-word shingles found),
    start and end (code points of the original text, end exclusive), by start.
    Words are compared as in decontamination: runs of letters and digits, A-Z
    lower-cased.  An input column of one of these names is replaced.

    Defined cases: a NULL, empty or short text has no matches; without
    templates nothing has; a template of fewer than five words is refused, and
    so are templates of more than 16 MB together.
    """
    templates = list(TEMPLATES if templates is None else templates)
    if sum(len(t.encode()) for _, t in templates) > MAX_TEMPLATE_BYTES:
        raise ValueError("templates exceed 16 MB; scan with parts of them")
    Index(templates, containment, recall)  # refuses short templates here, not in a task
    sent = docs.sparkSession.sparkContext.broadcast(templates)

    def make():
        index = Index(sent.value, containment, recall)

        def run(texts):
            names, matches = [], []
            for text in texts:
                found = scan(text, index, containment, max_gap)
                at = [m.span() for m in WORD.finditer(text)] if found else []
                names.append(sorted({f[0] for f in found}))
                matches.append([{"license": n, "containment": s, "start": at[a][0], "end": at[b - 1][1]} for n, s, a, b in found])
            return names, matches
        return run
    match = StructType([StructField("license", StringType()), StructField("containment", DoubleType()),
                        StructField("start", IntegerType()), StructField("end", IntegerType())])
    return with_python_columns(docs, [text_col], StructType([StructField("licenses", ArrayType(StringType())),
                                                             StructField("matches", ArrayType(match))]), make, keep=keep)
