"""License scans by patience alignment of texts with license templates.

Words that are unique both in a stretch of text and in the template are anchors; the
longest increasing subsequence of the anchors is kept, and the gaps between them are
aligned in the same way. Coverage is the share of the template's words that are aligned.

Words in ``{{ }}`` tell a template from its neighbours (a name, a version): they must
stand in the text in one piece. Where several templates fit a stretch, the one with most
aligned words and least between them is reported.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.llm.frames import prepare
from shiftloom.llm.words import normal, texts, word_blocks


class Template(NamedTuple):
    license: str
    form: str
    text: str


# Names of public licenses, as notices give them.
NAMES = {
    "MIT": ["MIT License"],
    "ISC": ["ISC License"],
    "BSD": ["BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3", "GPLv3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3", "LGPLv3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3", "AGPLv3"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International"],
}
FRAMES = ["Released under the {{%s}}", "Licensed under the {{%s}}", "This work is licensed under the {{%s}}"]

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    "{thing} is free software: you can redistribute it and/or modify it under the terms of the {{{{{name}}}}} as published by "
    "the Free Software Foundation, either {{{{version {version}}}}} of the License, or (at your option) any later version. "
    "{thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
    "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
)
_GNU_NOTICES = [
    ("GPL-2.0", "This program", "GNU General Public License", "2"),
    ("GPL-3.0", "This program", "GNU General Public License", "3"),
    ("LGPL-2.1", "This library", "GNU Lesser General Public License", "2.1"),
    ("LGPL-3.0", "This library", "GNU Lesser General Public License", "3"),
    ("AGPL-3.0", "This program", "GNU Affero General Public License", "3"),
]

# Wording of public licenses and of the notices they ask for.
WORDINGS = [
    Template("MIT", "text", (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")),
    Template("ISC", "text", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.")),
    Template("BSD-2-Clause", "text", _BSD + _BSD_WARRANTY),
    Template("BSD-3-Clause", "text", _BSD + (
        "3. {{Neither the name of}} the copyright holder nor the names of its contributors may be used to {{endorse or promote "
        "products}} derived from this software without specific prior written permission. ") + _BSD_WARRANTY),
    Template("Apache-2.0", "notice", (
        "Licensed under the {{Apache License, Version 2.0}} (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied. See the License for the specific language governing permissions and limitations "
        "under the License.")),
    Template("MPL-2.0", "notice", (
        "This Source Code Form is subject to the terms of the {{Mozilla Public License, v. 2.0}}. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")),
    *(Template(i, "notice", _GNU.format(thing=t, name=n, version=v)) for i, t, n, v in _GNU_NOTICES),
]
TEMPLATES = [
    *WORDINGS,
    *(Template(i, "line", frame % name) for i, names in NAMES.items() for name in names for frame in FRAMES),
    *(Template(i, "tag", "{{SPDX-License-Identifier: %s}}" % i) for i in NAMES if i != "BSD"),
]
MIN_COVERAGE = 0.8
HINT = 4  # letters of a word that may point to a template; two in a marked piece


def templates_in(spark: SparkSession, path: str) -> list[Template]:
    """Templates from a folder of text files, one whole license in each, named after its file.

    They are parameters of a scan and travel with it to every task; marks may stand in them.
    """
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[A-Za-z]+$", "")
    return [Template(r["name"], "text", r["value"]) for r in
            spark.read.text(path, wholetext=True).select(name.alias("name"), "value").sort("name").toLocalIterator()]


def increasing(values: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        p = bisect_left(tops, v)
        if p == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[p], piles[p] = v, i
        back[i] = piles[p - 1] if p else -1
    chain, i = [], piles[-1] if piles else -1
    while i >= 0:
        chain.append(i)
        i = back[i]
    return chain[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Aligned places (in a, in b), increasing in both."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        unique = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place]
        anchors = [unique[k] for k in increasing([j for _, j in unique])]
        pairs += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        if anchors:
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(pairs)


class Shape:
    """A template, prepared: its words, the marked pieces, and the words that point to it."""

    def __init__(self, template: Template, min_coverage: float):
        self.license, self.form = template.license, template.form
        self.words: list[bytes] = []
        self.pieces: list[range] = []
        for k, part in enumerate(template.text.replace("}}", "{{").split("{{")):
            words = normal(part.encode()).split()
            if k % 2 and words:
                self.pieces.append(range(len(self.words), len(self.words) + len(words)))
            self.words += words
        self.size = len(self.words)
        self.least = min_coverage * self.size - 1e-9
        marked = {j for piece in self.pieces for j in piece}
        count = Counter(self.words)
        once = {w: j for j, w in enumerate(self.words) if count[w] == 1}
        self.hints = {w: j for w, j in once.items() if len(w) >= HINT or (j in marked and len(w) >= 2)} or once
        self.must = {w for w, j in self.hints.items() if j in marked}
        self.need = max(1, len(self.hints) - int(self.size - self.least))  # hints that coverage leaves at least
        self.width = max(1, self.size // 2)

    def fits(self, pairs: list[tuple[int, int]]) -> bool:
        """Enough words are aligned, and every marked piece is there in one piece."""
        if not pairs or len(pairs) < self.least:
            return False
        at = {j: i for i, j in pairs}
        return all(at.get(j) == at.get(p.start, -self.size) + j - p.start for p in self.pieces for j in p)


class Found(NamedTuple):
    license: str
    form: str
    first: int
    n: int
    aligned: int
    coverage: float


class Scanner:
    """Templates, prepared; finds stretches that align with one of them."""

    def __init__(self, templates: Iterable[Template], min_coverage: float):
        self.shapes = [s for s in (Shape(t, min_coverage) for t in templates) if s.size]
        self.places: dict[bytes, list[tuple[int, int]]] = {}
        for t, shape in enumerate(self.shapes):
            for w, j in shape.hints.items():
                self.places.setdefault(w, []).append((t, j))
        self.longest = max((s.size for s in self.shapes), default=0)

    def possible(self, words: list[bytes]) -> set[int]:
        """Templates of which enough hints occur anywhere in ``words``."""
        common = self.places.keys() & set(words)
        seen = Counter(t for w in common for t, _ in self.places[w])
        return {t for t, n in seen.items() if n >= self.shapes[t].need and self.shapes[t].must <= common}

    def windows(self, words: list[bytes], at: int) -> Iterator[tuple[int, int, int]]:
        """(template, first, end): where enough hints lie as far apart as in the template.

        A hint at word i that is word j of the template votes for a copy that begins at
        i - j. Votes are counted over two neighbouring ranges of half the template's size,
        so words may be missing or added up to that many.
        """
        possible = self.possible(words)
        if not possible:
            return
        wanted = {w: [(t, j) for t, j in self.places[w] if t in possible] for t in possible for w in self.shapes[t].hints}
        votes: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for i, w in enumerate(words):
            for t, j in wanted.get(w, ()):
                votes[t, (at + i - j) // self.shapes[t].width].append((i - j, j))
        for t, b in votes:
            shape = self.shapes[t]
            both = votes[t, b] + votes.get((t, b + 1), []) if (t, b + 1) in votes else votes[t, b]
            seen = {j for _, j in both}
            if len(seen) >= shape.need and all(shape.hints[w] in seen for w in shape.must):
                margin = shape.size // 10
                yield t, max(0, min(both)[0] - margin), max(both)[0] + shape.size + margin

    def scan(self, words: list[bytes], at: int = 0) -> set[Found]:
        """Every stretch of ``words`` that fits a template; ``at`` is the place of the first word in its text."""
        found = set()
        for t, first, end in self.windows(words, at):
            shape = self.shapes[t]
            pairs = align(words[first:end], shape.words)
            if shape.fits(pairs):
                found.add(Found(shape.license, shape.form, at + first + pairs[0][0], pairs[-1][0] - pairs[0][0] + 1,
                                len(pairs), len(pairs) / shape.size))
        return found


def best(found: Iterable[Found]) -> list[Found]:
    """Of stretches that overlap one stays: that with most aligned words, less the words between them, then that covered best."""
    starts: list[int] = []
    kept: list[Found] = []
    for f in sorted(found, key=lambda f: (f.n - 2 * f.aligned, -f.coverage, f.first, f.license, f.form)):
        k = bisect_left(starts, f.first)
        if (k == 0 or starts[k - 1] + kept[k - 1].n <= f.first) and (k == len(starts) or f.first + f.n <= starts[k]):
            starts.insert(k, f.first)
            kept.insert(k, f)
    return kept


def scan(docs: DataFrame, *keep: str, templates: Iterable[Template] = TEMPLATES, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """A row per license found: the columns ``keep``, license, form, first_word, n_words, coverage.

    Texts are compared in lower case and without punctuation. A null or empty text has
    no licenses; a license that stands in a text twice is found twice; repeated rows
    come back as often as they came. Stretches do not overlap. A template without words
    that occur once in it is never found. Long texts are read in blocks that overlap by
    three templates.
    """
    prepare(docs.sparkSession)
    scanner = Scanner(templates, min_coverage)
    overlap = 3 * scanner.longest
    source = docs.select(*keep, "text")
    added = [("license", T.StringType()), ("form", T.StringType()), ("first_word", T.LongType()), ("n_words", T.LongType()),
             ("coverage", T.DoubleType())]
    schema = T.StructType([*source.schema.fields[:-1], *(T.StructField(*f) for f in added)])

    def of_text(data: bytes) -> list[Found]:
        at, found = 0, set()
        for words in word_blocks(normal(data), overlap):
            found |= scanner.scan(words, at)
            at += max(0, len(words) - overlap)
        return best(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for r, data in enumerate(texts(batch)):
                for f in of_text(data):
                    rows.append(r)
                    found.append((f.license, f.form, f.first, f.n, f.coverage))
            part = batch.take(pa.array(rows, pa.int64()))
            columns = list(zip(*found)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64())
            kept = [part.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, k) for c, k in zip(columns, kinds))], names=schema.names)

    return source.mapInArrow(run, schema)
