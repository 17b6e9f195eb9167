"""License scans: winnowed template fingerprints find candidates, banded alignment measures them.

Texts are reduced to lower-cased words of letters and digits.  A template's
character grams are winnowed: of every ``WINDOW`` neighbouring grams the least
is kept, so any ``WINDOW + Q - 1`` characters that a document shares with it
include a kept gram.  The kept grams of all templates form an inverted index;
a template becomes a candidate on a diagonal band with enough of them, and is
aligned word by word there.  Reported are the share of its words that the
document has in order (coverage) and the span that they take.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grams

Q, WINDOW = 8, 5
#: Least coverage reported, least share of a template's kept grams in a band, and widest shift within a band.
COVERAGE, CANDIDATE, DRIFT = 0.8, 0.1, 120
CHUNK = 500_000
_WORD = re.compile(r"[^\W_]+")

#: The public licenses' own wording, with their SPDX identifiers.
TEMPLATES = {
    ("Apache-2.0", "line"): "Licensed under the Apache License, Version 2.0",
    ("Apache-2.0", "notice"): """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    ("MIT", "line"): "Released under the MIT License",
    ("MIT", "licensed line"): "Licensed under the MIT License",
    ("MIT", "text"): """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ("BSD-2-Clause", "text"): """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    ("BSD-3-Clause", "third clause"): """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    ("ISC", "text"): """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ("GPL-2.0", "line"): "This work is licensed under the GNU General Public License, version 2",
    ("GPL-3.0", "line"): "This work is licensed under the GNU General Public License, version 3",
    ("GPL-3.0-or-later", "notice"): """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    ("MPL-2.0", "notice"): """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ("CC-BY-4.0", "line"): "Licensed under CC BY 4.0",
    ("CC-BY-SA-4.0", "line"): "Licensed under CC BY-SA 4.0",
    ("CC-BY-NC-4.0", "line"): "Licensed under CC BY-NC 4.0",
    ("CC-BY-4.0", "notice"): "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ("CC0-1.0", "notice"): "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    ("Unlicense", "text"): "This is free and unencumbered software released into the public domain",
    ("Zlib", "text"): """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely""",
}


def winnow(codes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the grams that are least in some window; ties go to the last."""
    if not len(codes):
        return np.zeros(0, np.int64)
    window = min(window, len(codes))
    view = np.lib.stride_tricks.sliding_window_view(codes, window)[:, ::-1]
    return np.unique(np.arange(len(view)) + window - 1 - view.argmin(1))


def align(template: list[str], words: list[str]) -> list[tuple[int, int]]:
    """The longest common subsequence of two word lists, as pairs of places; early matches win ties."""
    number: dict[str, int] = {}
    a, b = (np.array([number.setdefault(w, len(number)) for w in x], np.int64) for x in (template, words))
    rows = [np.zeros(len(b) + 1, np.int64)]
    for c in a:
        take = rows[-1][:-1] + (b == c)
        rows.append(np.maximum.accumulate(np.maximum(rows[-1], np.append(0, take))))
    out, j = [], int(rows[-1].argmax())
    for i in range(len(a), 0, -1):
        while j and rows[i][j] == rows[i][j - 1]:
            j -= 1
        if j and rows[i][j] > rows[i - 1][j]:
            out.append((i - 1, j - 1))
            j -= 1
    return out[::-1]


class Scanner:
    """Templates: ``{(license_id, kind): text}``."""

    def __init__(self, templates: dict[tuple[str, str], str] = TEMPLATES, coverage: float = COVERAGE):
        self.coverage, self.names = coverage, list(templates)
        self.words = [_WORD.findall(t.lower()) for t in templates.values()]
        joined = [grams.points(" ".join(w)) for w in self.words]
        found = [(i, (c := grams.codes(p, Q))[k := winnow(c)], k) for i, p in enumerate(joined)]
        self.length = np.array([len(p) for p in joined], np.int64)
        self.need = np.array([max(1, int(CANDIDATE * len(k))) for _, _, k in found], np.int64)
        self.widths = np.minimum(DRIFT, 4 + self.length // 2)
        self.index = grams.Index(found)

    def find(self, texts: list[str]) -> Iterator[tuple[int, str, str, float, int, int]]:
        """(place in ``texts``, license_id, kind, coverage, start, end in code points): the best templates that don't overlap."""
        split = [_WORD.findall(t.lower()) for t in texts]
        parts = [grams.points(" ".join(w)) for w in split]
        ends = np.cumsum([len(p) + 1 for p in parts])
        whole = np.zeros(int(ends[-1]) if parts else 0, np.uint32)
        for p, e in zip(parts, ends):
            whole[e - 1 - len(p) : e - 1] = p
        pattern, low, count = self.index.bands(grams.codes(whole, Q), self.widths)
        keep = count >= self.need[pattern]
        found: dict[int, list[tuple]] = {}
        for i, d in zip(pattern[keep].tolist(), low[keep].tolist()):
            first, last = d, d + int(2 * self.widths[i] + self.length[i])
            doc = int(np.searchsorted(ends, min(max((first + last) // 2, 0), len(whole) - 1), "right"))
            for k in {doc, int(np.searchsorted(ends, min(max(first, 0), len(whole) - 1), "right")), int(np.searchsorted(ends, min(last, len(whole) - 1), "right"))}:
                begin = int(ends[k]) - 1 - len(parts[k])
                starts = np.cumsum([0, *(len(w) + 1 for w in split[k])])[:-1]
                a, b = np.searchsorted(starts, [first - begin, last - begin])
                a = max(0, int(a) - 1)
                pairs = align(self.words[i], split[k][a : int(b)])
                # A word far from the rest is chance: the span is that of the densest run.
                if pairs and len(pairs) >= self.coverage * len(self.words[i]) and pairs[-1][1] - pairs[0][1] < 2 * len(self.words[i]):
                    found.setdefault(k, []).append((len(pairs), len(pairs) / len(self.words[i]), i, a + pairs[0][1], a + pairs[-1][1]))
        for k, rows in sorted(found.items()):
            place = [m.span() for m in _WORD.finditer(texts[k].lower())]
            taken: list[tuple[int, int]] = []
            for _, share, i, a, b in sorted(set(rows), key=lambda r: (-r[0], -r[1], r[2:])):
                if all(b < c or a > d for c, d in taken):
                    taken.append((a, b))
                    yield k, *self.names[i], share, place[a][0], place[b][1]


def scan(docs: DataFrame, templates: dict[tuple[str, str], str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per license passage: doc_id, license_id, template, coverage, span_start, span_end.

    Spans are code points of the lower-cased text.  Null and empty texts have
    no passage and no rows give none; repeated rows and null doc_ids report as
    others do; a text of any length is scanned whole, by one task; of templates
    that fit equally well the longer is reported, then the first; other columns
    are ignored.
    """

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates, coverage)
        for f in frames:
            rows, ids, batch, size, first = [], f["doc_id"].to_numpy(), [], 0, 0
            for n, t in enumerate([*f["text"], None]):
                if size > CHUNK or n == len(f):
                    rows += [(ids[first + d], *r) for d, *r in scanner.find(batch)]
                    batch, size, first = [], 0, n
                batch.append(t or "")
                size += len(batch[-1])
            yield pd.DataFrame(rows, columns=["doc_id", "license_id", "template", "coverage", "span_start", "span_end"])

    slim = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = slim.mapInPandas(search, "doc_id string, license_id string, template string, coverage double, span_start long, span_end long")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
