"""License scans by patience alignment of texts with templates.

A template is anchored on words that occur once in it and once in a stretch of text;
of these the longest run that keeps both orders is taken, and the gaps between its
members are aligned in the same way. The share of the template's words so matched is
its coverage.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Short notices, and the opening terms of common licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."
    ),
}

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words: what stands between ASCII characters that are no letters or digits."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs, sorted by their first number, whose second numbers rise."""
    tops: list[int] = []
    last: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back[k] = last[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(j)
            last.append(k)
        else:
            tops[pile], last[pile] = j, k
    found, k = [], last[-1] if last else -1
    while k >= 0:
        found.append(pairs[k])
        k = back[k]
    return found[::-1]


def align(template: list[bytes], words: list[bytes]) -> list[tuple[int, int]]:
    """Matched (template position, text position) pairs, rising in both.

    Equal words at either end are matched first; then words unique to both sides
    anchor the rest. A gap without such a word is left unmatched.
    """
    found: list[tuple[int, int]] = []
    todo = [(0, len(template), 0, len(words))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and template[a] == words[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == words[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        once = {w for w, n in Counter(template[a:b]).items() if n == 1}
        once &= {w for w, n in Counter(words[c:d]).items() if n == 1}
        if not once:
            continue
        place = {w: c + k for k, w in enumerate(words[c:d]) if w in once}
        anchors = _longest_rising([(k, place[template[k]]) for k in range(a, b) if template[k] in once])
        found += anchors
        for (i, j), (k, m) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)]):
            todo.append((i + 1, k, j + 1, m))
    return sorted(found)


class Scanner:
    """Templates prepared for scanning texts."""

    def __init__(self, templates: Mapping[str, str], least: float, stretch: float = 1.5) -> None:
        self._least, self._stretch = least, stretch
        self._templates = []
        for name, text in sorted(templates.items()):
            words = words_of(text)
            self._templates.append((name, words, frozenset(words), Counter(words)))

    def span(self, template: list[bytes]) -> int:
        """The words of a window in which an occurrence of the template is sought."""
        return int(np.ceil(self._stretch * len(template))) + 2

    def scan(self, text: str | None) -> tuple[int, list[tuple[str, float, int, int]]]:
        """Number of words, and (template, coverage, first word, word after the last) of all occurrences.

        An occurrence is the alignment of a template with a window of ``stretch`` times its
        words (and two more) that covers ``least`` of it. Windows with too few words of the
        template are passed over. From the first that is enough on, all windows that begin
        inside it are tried, and those inside the best of them, until coverage stops rising.
        Occurrences of one template do not overlap.
        """
        words = words_of(text)
        there = set(words)
        found = []
        for name, template, distinct, counts in self._templates:
            need = int(np.ceil(self._least * len(template) - 1e-9))
            shared = distinct & there
            if not template or sum(counts[w] for w in shared) < need:
                continue
            hit = np.fromiter((w in shared for w in words), np.int64, len(words))
            span = self.span(template)
            total = np.append(0, np.cumsum(hit))
            ends = np.minimum(np.arange(len(words)) + span, len(words))
            starts = np.flatnonzero((hit > 0) & (total[ends] - total[:-1] >= need))
            at = 0
            while at < len(starts):
                best = self._alignment(template, words, int(starts[at]), span)
                if best[0] < need:
                    at += 1
                    continue
                limit = starts[at] + span
                while at + 1 < len(starts) and starts[at + 1] < limit and best[0] < len(template):
                    at += 1
                    other = self._alignment(template, words, int(starts[at]), span)
                    if other[0] > best[0]:
                        best, limit = other, starts[at] + span
                found.append((name, best[0] / len(template), best[1], best[2]))
                at = int(np.searchsorted(starts, best[2]))
        return len(words), found

    @staticmethod
    def _alignment(template: list[bytes], words: list[bytes], at: int, span: int) -> tuple[int, int, int]:
        pairs = align(template, words[at : at + span])
        return (len(pairs), at + pairs[0][1], at + pairs[-1][1] + 1) if pairs else (0, at, at)


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    *,
    least: float = 0.8,
    stretch: float = 1.5,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_found, license, coverage, first_word, end_word, found.

    ``license`` and the columns after it describe the occurrence of greatest coverage
    (then of most words, then the first); ``found`` has all. Null and empty texts, and
    texts without an occurrence, have n_found 0 and nulls. Null ids and repeated rows
    are scanned like any other. Very long texts are scanned whole; of occurrences of one
    coverage in overlapping windows the first counts. Columns besides key and text are not read; an empty
    table gives an empty result. Nothing is shuffled.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    prepared = Scanner(templates, least, stretch)
    one = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = one.names
        for batch in batches:
            results = [prepared.scan(t) for t in batch.column("_text").to_pylist()]
            best = [max(f, key=lambda x: (x[1], x[3] - x[2], -x[2]), default=(None,) * 4) for _, f in results]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([n for n, _ in results], pa.int64()),
                    pa.array([len(f) for _, f in results], pa.int32()),
                    *(pa.array([b[k] for b in best], one.field(k).type) for k in range(4)),
                    pa.array([[dict(zip(names, x)) for x in f] for _, f in results], pa.list_(one)),
                ],
                names=["doc_id", "n_words", "n_found", *names, "found"],
            )

    schema = (
        f"doc_id {kind}, n_words long, n_found int, license string, coverage double, first_word long, end_word long, "
        "found array<struct<license: string, coverage: double, first_word: long, end_word: long>>"
    )
    return rows.mapInArrow(scanned, schema)
