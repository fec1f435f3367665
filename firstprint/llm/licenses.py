"""License scans: winnowed template fingerprints find candidates, banded alignment measures them.

The templates are cut into words and every K-word gram is hashed; the smallest hash of each W grams on end is kept
(winnowing, so that every run of W + K - 1 words of a template leaves a mark). An inverted index holds template and place
of each mark. A text's gram hashes are looked up in the index; each mark found gives a template and a diagonal (place in
the text less place in the template). Marks of one template on near diagonals make one candidate, and only its
neighbourhood is aligned: a local alignment of words, within BAND of the diagonal, which allows replaced, added and missing
words. Pieces of one template that follow each other in template and text, with no more words between them than the
template has, are chained: their covered words are added and the span reaches from the first to the last, so a block put
into a license does not hide it. Chains that cover enough of a template are reported; of those that overlap by more than
half, the one with more covered words.

The index has a few thousand numbers, whatever the corpus; texts are scanned whole in the tasks that read them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame

from firstprint.llm.caching import Remembered
from firstprint.llm.frames import frame

K = 3
W = 2
BAND = 6
LEAST_COVERAGE = 0.7

# Public license notices and texts.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC-opening": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    "BSD-opening": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
        IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
        INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
        SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
        THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
        ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to
        endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
        IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
        INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
        SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
        THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
        ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
        IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
    "GPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
        License for more details.""",
    "MPL-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Unlicense-opening": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or
        authors of this software dedicate any and all copyright interest in the software to the public domain. We make this
        dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this
        dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under
        copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
        THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more
        information, please refer to http://unlicense.org/""",
}

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and other non-ASCII characters, with A-Z in lower case."""
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def gram_hashes(words: list[bytes], hashes: Remembered, k: int = K) -> np.ndarray:
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    value = np.zeros(max(len(codes) - k + 1, 0), np.uint64)
    for i in range(k):
        value = (value ^ codes[i:i + len(value)]) * np.uint64(0x9E3779B97F4A7C15)
        value = value ^ (value >> np.uint64(29))
    return value


class Index:
    """Marks of the templates: sorted hashes, with template and place of each."""

    def __init__(self, templates: dict[str, str], k: int = K, w: int = W):
        self.names = sorted(templates)
        self.words = [words_of(templates[name]) for name in self.names]
        hashes, rows = Remembered(xxhash.xxh64_intdigest), []
        for number, words in enumerate(self.words):
            grams = gram_hashes(words, hashes, k)
            for start in range(max(len(grams) - w + 1, min(len(grams), 1))):
                window = grams[start:start + w]
                rows.append((int(window.min()), number, start + int(window.argmin())))
        rows = sorted(set(rows))
        self.marks = np.array([r[0] for r in rows], np.uint64)
        self.template, self.place = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))

    def candidates(self, grams: np.ndarray, band: int = BAND) -> list[tuple[int, int, int]]:
        """(template, lowest diagonal, highest diagonal) of the marks that a text has, joined while diagonals are near."""
        low, high = np.searchsorted(self.marks, grams, "left"), np.searchsorted(self.marks, grams, "right")
        at = np.flatnonzero(high > low)
        found = sorted({(int(self.template[j]), int(i - self.place[j])) for i in at for j in range(low[i], high[i])})
        joined: list[list[int]] = []
        for template, diagonal in found:
            if joined and joined[-1][0] == template and diagonal - joined[-1][2] <= band:
                joined[-1][2] = diagonal
            else:
                joined.append([template, diagonal, diagonal])
        return [tuple(x) for x in joined]


def matches(template: list[bytes], text: list[bytes], low: int, high: int, first: int, stop: int) -> list[tuple[int, int]]:
    """The matching words, as (template place, text place), of the best local alignment with text place - template place
    between low and high.

    Only the words from `first` up to `stop` of the text are looked at.
    A matching word counts 2, a replaced, added or missing one -1; of equal scores the earliest in the template wins.
    """
    best, top = None, 0
    width = high - low + 1
    none = (0, 0, None)  # score, covered words, the last match and those before it
    above = [none] * (width + 2)
    for i, word in enumerate(template):
        row = [none] * (width + 2)
        for d in range(width):
            j = i + low + d
            if not first <= j < stop:
                continue
            same = word == text[j]
            before = above[d + 1]
            if same:
                cell = (before[0] + 2, before[1] + 1, (i, j, before[2]))
            else:
                cell = max(((x[0] - 1, x[1], x[2]) for x in (before, above[d + 2], row[d])), key=lambda x: (x[0], x[1]))
                if cell[0] <= 0:
                    cell = none
            row[d + 1] = cell
            if cell[0] > top:
                top, best = cell[0], cell[2]
        above = row
    found = []
    while best:
        found.append(best[:2])
        best = best[2]
    return found[::-1]


def align(template: list[bytes], text: list[bytes], low: int, high: int, first: int, stop: int) -> tuple[int, int, int]:
    """(covered, start, end) of the best local alignment; see `matches`."""
    found = matches(template, text, low, high, first, stop)
    return (len(found), found[0][1], found[-1][1] + 1) if found else (0, 0, 0)


def chains(pieces: list[list[tuple[int, int]]], most_gap: int, cost: int = BAND) -> list[tuple[int, int, int]]:
    """(covered, start, end) of the pieces of one template, joined where one goes on after another in template and text.

    Between two joined pieces lie `most_gap` words of the text at most, and a join costs `cost` words, so that a chance
    phrase does not stretch a span. Words that two pieces share count once. Each piece is in one chain: the best first.
    """
    pieces = sorted(pieces, key=lambda p: (p[0][1], p[-1][1], p[0][0]))
    longest = max((p[-1][1] - p[0][1] for p in pieces), default=0)
    score, added, before = [len(p) for p in pieces], [len(p) for p in pieces], [-1] * len(pieces)
    for q, piece in enumerate(pieces):
        for p in range(q - 1, -1, -1):
            if piece[0][1] - pieces[p][0][1] > longest + most_gap + 1:
                break
            i, j = pieces[p][-1]
            rest = [x for x in piece if x[0] > i and x[1] > j]
            if rest and rest[0][1] - j - 1 <= most_gap and score[p] + len(rest) - cost > score[q]:
                score[q], added[q], before[q] = score[p] + len(rest) - cost, len(rest), p
    found, used = [], set()
    for q in sorted(range(len(pieces)), key=lambda q: (-score[q], q)):
        if q in used:
            continue
        covered, end, at = 0, pieces[q][-1][1] + 1, q
        while True:
            used.add(at)
            if before[at] < 0 or before[at] in used:
                covered += len(pieces[at])
                break
            covered += added[at]
            at = before[at]
        found.append((covered, pieces[at][0][1], end))
    return found


def scan(words: list[bytes], grams: np.ndarray, index: Index, band: int = BAND,
         least_coverage: float = LEAST_COVERAGE) -> list[tuple[str, int, int, int, float]]:
    """(template, start, end, covered words, coverage) of each license found, by place; words are counted from 0."""
    pieces: dict[int, list[list[tuple[int, int]]]] = {}
    for number, low, high in index.candidates(grams, band):
        template = index.words[number]
        stretches = [(max(0, low - band), min(len(words), high + band + len(template)))]
        while stretches:  # what lies before and after a piece may hold another
            first, stop = stretches.pop()
            piece = matches(template, words, low - band, high + band, first, stop)
            if piece and (len(piece) > band or len(piece) >= least_coverage * len(template)):
                pieces.setdefault(number, []).append(piece)
                stretches += [(first, piece[0][1]), (piece[-1][1] + 1, stop)]
    found = [(index.names[number], start, end, covered, covered / len(index.words[number]))
             for number, parts in pieces.items() for covered, start, end in chains(parts, len(index.words[number]))
             if covered >= least_coverage * len(index.words[number])]
    kept: list[tuple[str, int, int, int, float]] = []
    for one in sorted(found, key=lambda x: (-x[3], -x[4], x[1], x[0])):
        if all(2 * (min(one[2], other[2]) - max(one[1], other[1])) <= min(one[2] - one[1], other[2] - other[1]) for other in kept):
            kept.append(one)
    return sorted(kept, key=lambda x: (x[1], x[0]))


@cache
def standard_index() -> Index:
    return Index(TEMPLATES)


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row for each license in a text: doc_id, license, start and end (word numbers, end excluded), covered, coverage.

    A text without a license, a null and an empty one give no row. Texts of any length are scanned whole; a repeated row
    gives repeated results; a null doc_id is kept; other columns are not read.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(templates) if templates else standard_index()
        hashes = Remembered(xxhash.xxh64_intdigest, most=50_000)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = words_of(text)
                rows += [(doc_id, *one) for one in scan(words, gram_hashes(words, hashes), index)]
            yield frame("doc_id license start end covered coverage", rows)

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id bigint, license string, start bigint, end bigint, covered bigint, coverage double")
