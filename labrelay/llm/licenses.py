"""License scan by patience alignment.

Each whole text is aligned with license notices in one pass of Arrow batches.
A text is looked at only around words that a match cannot do without: of each
template's rarest words so many are watched that a text without any of them
cannot reach the coverage. Around such a word a window of the text is aligned
with the template: words unique to both are anchors, the longest increasing
subsequence of them is kept, and the gaps between anchors are aligned in turn.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_arrow

COVERAGE = 0.8
#: Share of a matched span's words that must be the template's.
DENSITY = 0.6
#: License notices as they stand at the head of works (fixed texts).
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "MIT-notice": "Released under the MIT License",
    "BSD-notice": "Released under the BSD License",
    "GPL-notice": "Released under the GPL License",
    "Apache-notice": "Released under the Apache License",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software."),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "BSD-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0",
    "CC-BY-ND-4.0-notice": "Licensed under CC BY-ND 4.0",
    "CC-BY-NC-SA-4.0-notice": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-4.0-sentence": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0-sentence": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC0-1.0-sentence": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
}
#: Words that tell licenses of one family apart: a match must have the same ones.
VARIANTS = frozenset("nc nd sa sharealike noncommercial noderivatives agpl lgpl lesser affero".split())
#: Words that name a license: of those in a template, each must be matched where it first stands.
NAMING = frozenset("mit bsd gpl apache gnu general mozilla mpl cc creative commons attribution".split())
#: Words that tell licenses and their versions apart.
TELLING = VARIANTS | NAMING | frozenset("0 2 3 4".split())
#: A version in a license's name, and one that follows a word of a text.
VERSION = re.compile(r"\d+\.\d+")
NUMBER = re.compile(r"\W{0,8}(?:v(?:er(?:sion)?)?\W{0,3})?(\d+(?:\.\d+)*)", re.IGNORECASE)
WORD = re.compile(r"[^\W_]+")


def longest_increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence (patience sorting)."""
    tops, ends, back = [], [], []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            ends.append(i)
        else:
            tops[k], ends[k] = v, i
        back.append(ends[k - 1] if k else -1)
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Longest common subsequence of two short lists."""
    m, n = len(a), len(b)
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(m - 1, -1, -1):
        for j in range(n - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < m and j < n:
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def patience(a: list[str], b: list[str], a0: int = 0, b0: int = 0) -> list[tuple[int, int]]:
    """Aligned positions of two word lists. Equal ends are taken off; words that
    occur once in either list are anchors, their longest increasing subsequence is
    kept, and the gaps are aligned in turn; a gap without anchors gets its longest
    common subsequence."""
    out = []
    while a and b and a[0] == b[0]:
        out.append((a0, b0))
        a, b, a0, b0 = a[1:], b[1:], a0 + 1, b0 + 1
    tail = 0
    while tail < min(len(a), len(b)) and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    ends = [(a0 + len(a) - k, b0 + len(b) - k) for k in range(tail, 0, -1)]
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if a and b:
        ca, cb = Counter(a), Counter(b)
        at = {w: j for j, w in enumerate(b) if cb[w] == 1}
        anchors = [(i, at[w]) for i, w in enumerate(a) if ca[w] == 1 and w in at]
        if anchors:
            anchors = [anchors[k] for k in longest_increasing([j for _, j in anchors])]
            i0 = j0 = 0
            for i, j in [*anchors, (len(a), len(b))]:
                out += patience(a[i0:i], b[j0:j], a0 + i0, b0 + j0)
                if i < len(a):
                    out.append((a0 + i, b0 + j))
                i0, j0 = i + 1, j + 1
        else:
            out += [(a0 + i, b0 + j) for i, j in _common(a, b)]
    return out + ends


class Licenses:
    """Templates with the words that are watched for each, where their naming words
    first stand, and where the version is that their name tells."""

    def __init__(self, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE):
        self.coverage = coverage
        self.templates = {name: WORD.findall(text.lower()) for name, text in templates.items()}
        self.known = {w for words in self.templates.values() for w in words}
        everywhere = Counter(w for words in self.templates.values() for w in set(words))
        self.names = {name: {words.index(w) for w in NAMING & set(words)} for name, words in self.templates.items()}
        self.version: dict[str, tuple[str, range]] = {}
        for name, words in self.templates.items():
            own, first = VERSION.search(name), next((i for i, w in enumerate(words) if w.isdigit()), None)
            if own and first is not None:
                end = next((i for i in range(first, len(words)) if not words[i].isdigit()), len(words))
                self.version[name] = (own.group(), range(first, end))
        self.watch: dict[str, list[tuple[str, int]]] = {}
        for name, words in self.templates.items():
            n = len(words)
            # A match lacks at most n - ceil(coverage * n) words, so one of these is in it.
            need = n - ceil(coverage * n) + 1
            rare = sorted(range(n), key=lambda i: (words[i].isdigit(), len(words[i]) < 4, everywhere[words[i]], -len(words[i]), i))
            for i in rare[:need]:
                self.watch.setdefault(words[i], []).append((name, i))

        # What a match needs in its window: words (the version's aside) as often as the template has them, and all naming words.
        self.words = {name: Counter(w for i, w in enumerate(words) if i not in self.version.get(name, ("", range(0)))[1])
                      for name, words in self.templates.items()}
        self.least = {name: ceil(coverage * len(words)) - len(self.version.get(name, ("", range(0)))[1]) for name, words in self.templates.items()}

    def promising(self, name: str, lows: np.ndarray, highs: np.ndarray, places: dict[str, np.ndarray]) -> np.ndarray:
        """Of windows of words those that hold enough of the template's words, in whatever
        order, for a match; ``places`` has the positions of each word of the text."""
        naming = {self.templates[name][i] for i in self.names[name]}
        total, named = np.zeros(len(lows), np.int64), np.ones(len(lows), bool)
        for w, most in self.words[name].items():
            if w in places:
                n = np.searchsorted(places[w], highs) - np.searchsorted(places[w], lows)
                total += np.minimum(n, most)
                if w in naming:
                    named &= n > 0
            elif w in naming:
                return np.zeros(len(lows), bool)
        return named & (total >= self.least[name])

    def version_at(self, name: str, text: str, spans: list[tuple[int, int]], at: dict[int, int]) -> tuple[str, int] | None:
        """The version that a text has in the place of the template's, as major.minor, and its
        end in characters; ``at`` has the text's word of each matched word of the template."""
        first = self.version[name][1][0]
        starts = [spans[at[i]][1] for i in (first - 1, first - 2) if i in at] + [spans[at[i]][0] for i in (first,) if i in at]
        for start in starts:
            number = NUMBER.match(text, start)
            if number:
                return number.group(1) + ("" if "." in number.group(1) else ".0"), number.end()
        return None

    def found(self, text: str) -> Iterator[tuple[str, float, int, int]]:
        """(license, coverage, start, end) in characters of each notice in a text, in
        order of their start; of notices that overlap, the one that matches most words.
        A notice of another version gets that version's name, its number counting as matched."""
        low_text = text.lower()
        if not any(w in low_text for w in self.watch):
            return
        spans = [m.span() for m in WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        lists: dict[str, list[int]] = {}
        for at, w in enumerate(words):
            if w in self.known:
                lists.setdefault(w, []).append(at)
        places = {w: np.array(at) for w, at in lists.items()}
        hits: dict[str, list[np.ndarray]] = {}
        for w, at in places.items():
            for name, i in self.watch.get(w, ()):
                hits.setdefault(name, []).append(at - i)
        matches = []
        for name, found in hits.items():
            template = self.templates[name]
            n = len(template)
            slack = n // 4 + 2
            if not self.promising(name, np.zeros(1, np.int64), np.array([len(words)]), places)[0]:
                continue
            starts = np.unique(np.concatenate(found))
            starts = starts[self.promising(name, np.maximum(0, starts - slack), starts + n + slack, places)]
            done, refused = -1, None
            for start in starts.tolist():
                # The window around a start holds any notice that begins up to ``slack`` words beside it.
                if refused is not None and start <= refused + slack // 2:
                    continue
                low, refused = max(0, start - slack, done + 1), start
                window = words[low:start + n + slack]
                pairs = patience(template, window)
                own, numbers = self.version.get(name, ("", range(0)))
                others = [p for p in pairs if p[0] not in numbers]
                if len(others) + len(numbers) < self.coverage * n:
                    continue
                at = {i: low + j for i, j in pairs}
                if not self.names[name] <= at.keys():
                    continue
                first, last, size, called = low + pairs[0][1], low + pairs[-1][1], len(pairs), name
                if numbers:
                    version = self.version_at(name, text, spans, at)
                    if version is None:
                        continue
                    if version[0] != own:
                        size, called = len(others) + len(numbers), name.replace(own, version[0], 1)
                        last = max(low + others[-1][1], bisect_left(spans, (version[1], 0)) - 1)
                inside = set(words[first:last + 1]) & VARIANTS
                if size < self.coverage * n or size < DENSITY * (last - first + 1) or inside != set(template) & VARIANTS:
                    continue
                matches.append((size, -size / n, first, last, called))
                done, refused = last, None
        taken: list[tuple[int, int]] = []
        out = []
        for size, cover, first, last, name in sorted(matches, key=lambda m: (-m[0], m[1], m[2], m[4])):
            if all(last < a or first > b for a, b in taken):
                taken.append((first, last))
                out.append((name, -cover, spans[first][0], spans[last][1]))
        yield from sorted(out, key=lambda m: m[2])


def scan(docs: DataFrame, keep: list[str], templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """A row for each notice of each text: ``keep``, license, coverage, start_char and
    end_char. Null and empty texts give none; a document repeated in full gives its
    notices again; an empty table gives none."""
    text = fresh(keep, "text")
    rows = docs.select(*keep, F.col("text").cast("string").alias(text))
    own = {"license": "string", "coverage": "double", "start_char": "int", "end_char": "int"}
    schema = rows.select(*keep, *[F.lit(None).cast(t).alias(c) for c, t in own.items()]).schema

    def run(batches):
        known = Licenses(templates, coverage)
        for batch in batches:
            data = batch.column(batch.num_columns - 1)
            found = [(i, *m) for i, t in enumerate(data) if t.is_valid for m in known.found(t.as_py())]
            at = pa.array([x[0] for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(at) for i in range(batch.num_columns - 1)]
                + [pa.array([x[k + 1] for x in found], t) for k, t in
                   enumerate((pa.string(), pa.float64(), pa.int32(), pa.int32()))], names=[*keep, *own])

    return map_arrow(rows, run, schema)


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, license, coverage, start_char, end_char of every notice."""
    return scan(docs, ["doc_id"])
