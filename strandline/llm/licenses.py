"""License scans: winnowed fingerprints of templates in an inverted index pick candidates, banded alignment settles them."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import rolling_hashes, sliding_argmin, span_hashes, text_bytes, text_slices

#: Public license notices and short license texts, by SPDX identifier; fixed values.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "GPL-2.0-or-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "SPDX-License-Identifier: GPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "BSD-3-Clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-3.0": ("Licensed under CC BY 3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License"),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", "SPDX-License-Identifier: CC-BY-ND-4.0"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0-only"),
    "GPL-3.0-or-later": ("SPDX-License-Identifier: GPL-3.0-or-later",),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",),
}
GRAM, WINDOW = 3, 2
#: Templates of fewer words are notices: what lies between their first and last word that isn't one of these names the
#: license, and has to stand in the text without gap or mismatch.
NOTICE_WORDS = 20
COMMON_WORDS = frozenset("a by international is license licensed released spdx identifier the this under unported version work".split()) - {"by"}

#: Letters and digits (any byte over 0x7F too) make words, in lower case; all else separates.
_FOLD = np.full(256, 0x20, np.uint8)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _FOLD[_b] = _b
for _b in range(0x41, 0x5B):
    _FOLD[_b] = _b + 0x20


@dataclass(frozen=True)
class Match:
    license: str
    template: int
    coverage: float
    matched: int
    first_word: int
    last_word: int


class Words:
    """Folded words of some texts: hashes, byte spans, and the first word of each text."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = text_bytes(texts)
        folded = _FOLD[self.data]
        word = folded != 0x20
        edge = np.zeros(len(word) + 1, bool)
        edge[self.offsets] = True
        before = np.concatenate([[False], word[:-1]]) & ~edge[:-1]
        after = np.concatenate([word[1:], [False]]) & ~edge[1:]
        self.starts, self.ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.hashes = span_hashes(folded, self.starts, self.ends)


def fingerprints(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winnowing: the least of each few neighbouring word-gram hashes, with its place. Two texts that share a run of
    GRAM + WINDOW - 1 words share a fingerprint."""
    grams = rolling_hashes(hashes, GRAM)
    if len(grams) < WINDOW:
        return grams, np.arange(len(grams))
    at = np.unique(sliding_argmin(grams, WINDOW))
    return grams[at], at


class TemplateIndex:
    """Inverted index: fingerprint to the templates and places that have it."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]]):
        self.entries: list[tuple[str, int, np.ndarray]] = []
        self.cores: list[list[int]] = []
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for name, texts in templates.items():
            for k, text in enumerate(texts):
                hashes = Words(pa.array([text])).hashes
                for f, at in zip(*(x.tolist() for x in fingerprints(hashes)), strict=True):
                    self.places[f].append((len(self.entries), at))
                self.entries.append((name, k, hashes))
                words = re.findall(r"[a-z0-9]+", text.lower())
                own = [i for i, x in enumerate(words) if x not in COMMON_WORDS]
                self.cores.append(hashes[own[0] : own[-1] + 1].tolist() if own and len(words) < NOTICE_WORDS else [])
        self.known = np.array(sorted(self.places), np.uint64)

    def scan(self, hashes: np.ndarray, hits: list[tuple[int, int]], least: float) -> list[Match]:
        """Matches in one text from its fingerprint hits (fingerprint, place), best first where they overlap."""
        by_entry: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for f, at in hits:
            for entry, place in self.places[f]:
                by_entry[entry].append((at - place, at))
        found: list[Match] = []
        for entry, seen in by_entry.items():
            name, k, template = self.entries[entry]
            band, reach = max(4, len(template) // 10), max(4, len(template) // 4)
            seen.sort()
            at = 0
            while at < len(seen):  # hits on diagonals near each other are one occurrence
                to = at + 1
                while to < len(seen) and seen[to][0] - seen[to - 1][0] <= band and seen[to][0] - seen[at][0] <= reach:
                    to += 1
                rest = [(seen[at:to], 0, len(hashes))]
                while rest:  # or several, where they follow each other closely
                    chain, lo, hi = rest.pop()
                    middle, width = (chain[0][0] + chain[-1][0]) // 2, band + chain[-1][0] - chain[0][0]
                    lo, hi = max(lo, middle - width), min(hi, middle + len(template) + width)  # all of the text in the band
                    matched, first, last = align(template, hashes[lo:hi], middle - lo, width)
                    if matched < least * len(template):
                        continue
                    first, last = first + lo, last + lo
                    if holds(hashes[first : last + 1].tolist(), self.cores[entry]):
                        found.append(Match(name, k, matched / len(template), matched, first, last))
                    for part, a, b in (([x for x in chain if x[1] < first], lo, first), ([x for x in chain if x[1] > last], last + 1, hi)):
                        if part:
                            rest.append((part, a, b))
                at = to
        found.sort(key=lambda m: (-m.matched, -m.coverage, m.first_word, m.license))
        kept: list[Match] = []  # by place
        for m in found:
            at = bisect_left(kept, m.first_word, key=lambda o: o.last_word)  # the first that ends at or after its start
            if at == len(kept) or kept[at].first_word > m.last_word:
                kept.insert(at, m)
        return kept


def holds(words: list[int], core: list[int]) -> bool:
    """Whether a run of words has another in it, without a gap."""
    return any(words[i : i + len(core)] == core for i in range(len(words) - len(core) + 1))


def align(template: np.ndarray, text: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """Local alignment of a template with the words of a text within a band around a diagonal: matched words, and the first
    and last word of the text in it. A match scores 2, a mismatch or gap -1."""
    rows, words = template.tolist(), text.tolist()
    best = (0, 0, -1, -1)
    empty = (0, 0, -1)
    above: dict[int, tuple[int, int, int]] = {}
    for i, t in enumerate(rows):
        row: dict[int, tuple[int, int, int]] = {}
        left = empty
        for j in range(max(0, i + diagonal - band), min(len(words), i + diagonal + band + 1)):
            score, matched, first = above.get(j - 1, empty)
            if words[j] == t:
                cell = (score + 2, matched + 1, first if score else j)
            else:
                cell = (score - 1, matched, first)
            up = above.get(j, empty)
            cell = max(cell, (up[0] - 1, up[1], up[2]), (left[0] - 1, left[1], left[2]), key=lambda c: c[0])
            left = cell if cell[0] > 0 else empty
            if left[0]:
                row[j] = left
                if left[0] > best[0]:
                    best = (*left, j)
        above = row
    return best[1], best[2], best[3]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Mapping[str, tuple[str, ...]] = TEMPLATES, least_coverage: float = 0.8) -> DataFrame:
    """One row for each license notice found: the id, license, template (its number), coverage (matched words of the
    template), matched_words, start_char and end_char (code points of the whole text, end exclusive).

    A notice of under NOTICE_WORDS words must hold the words that name its license and version, without a gap; the others,
    and long texts, may differ as far as `least_coverage` allows. Words are runs of letters and digits in lower case. Where found notices overlap, that with more matched words stays.
    Null and empty texts have none; each row is scanned by itself, so null and repeated ids are carried as they are. Other
    columns are ignored, an empty table gives no rows. The work grows with a text's length. The index is as large as the templates and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(TemplateIndex(templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in text_slices(batches, "text"):
            words = Words(batch.column("text"))
            values, at = fingerprints(words.hashes)
            near = np.minimum(np.searchsorted(index.known, values), len(index.known) - 1)
            hit = index.known[near] == values
            values, at = values[hit], at[hit]
            text = np.searchsorted(words.first, at, side="right") - 1
            out: list[tuple] = []
            bounds = np.searchsorted(text, np.arange(batch.num_rows + 1))
            for k in np.unique(text).tolist():
                mine = slice(bounds[k], bounds[k + 1])
                lo, hi = int(words.first[k]), int(words.first[k + 1])
                matches = index.scan(words.hashes[lo:hi], list(zip(values[mine].tolist(), (at[mine] - lo).tolist(), strict=True)), least_coverage)
                if matches:
                    begin = words.offsets[k]
                    points = np.concatenate([[0], np.cumsum((words.data[begin : words.offsets[k + 1]] & 0xC0) != 0x80)])
                for m in matches:
                    start, end = words.starts[lo + m.first_word] - begin, words.ends[lo + m.last_word] - begin
                    out.append((k, m.license, m.template, m.coverage, m.matched, int(points[start]), int(points[end])))
            if out:
                columns = list(zip(*out, strict=True))
                kinds = (pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(columns[0])), *[pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True)]], ["id", "license", "template", "coverage", "matched_words", "start_char", "end_char"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, license string, template int, coverage double, matched_words long, start_char long, end_char long"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
