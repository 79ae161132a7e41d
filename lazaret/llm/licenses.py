"""Licence scan: every window of a text against licence templates by the Dice coefficient of their word bigrams.

The text is normalised to words: runs of letters and digits, A-Z folded; so line ends, comment marks and punctuation do not matter. For a
template of w words all windows of w words are compared (a shorter text is one window), wherever they begin: a notice is found on a line
of its own, wrapped over lines, inside a paragraph, or as the whole text of a licence. Dice is 2 * |A and B| / (|A| + |B|) over the distinct
bigrams of window and template, and ``threshold`` or more is a match. Of matches that overlap the highest value stays (ties: the template with
more bigrams, the first name, the first place), then the highest of those left, and so on.

Sizes bound the work: a template of b bigrams can only be reached by a window that shares threshold / (2 - threshold) * b of them, and
by a text of that many bigrams at least. An inverted index from bigrams to templates counts the shared ones, first per text, then per window; only
windows that may reach the threshold are scored.

A text that is null or has no bigram has no match. Repeated notices match each on their own, repeated rows and null ids too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.llm.text import NOT_ALNUM, Texts, slices, texts_of, window_hashes, words_of

THRESHOLD = 0.8

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS"""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER
OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT
OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""


def _gpl(program: str, name: str, version: str) -> str:
    return f"""{program} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software
    Foundation, either version {version} of the License, or (at your option) any later version. {program} is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."""


# Customary notices, headers and short full texts of public licences, by SPDX identifier; behind it a number where there are several.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0 2": _gpl("This program", "GNU Affero General Public License", "3"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 2": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
    obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed
    under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
    specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-2-Clause 2": f"{_BSD} {_BSD_WARRANTY}",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSD-3-Clause 2": f"{_BSD} {_BSD_NAMES} {_BSD_WARRANTY}",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0 2": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0 2": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0 2": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0 2": _gpl("This program", "GNU General Public License", "2"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 2": _gpl("This program", "GNU General Public License", "3"),
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
    copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO
    THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
    CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
    ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "LGPL-2.1": _gpl("This library", "GNU Lesser General Public License", "2.1"),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0 2": _gpl("This program", "GNU Lesser General Public License", "3"),
    "MIT": "Released under the MIT License.",
    "MIT 2": f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to
    deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
    copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
    this permission notice shall be included in all copies or substantial portions of the Software. {_WARRANTY} OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
    DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
    DEALINGS IN THE SOFTWARE.""",
    "MIT 3": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to
    deal in the Software without restriction""",
    "MPL-2.0": "This work is licensed under the Mozilla Public License, version 2.0.",
    "MPL-2.0 2": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You
    can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense": "Released into the public domain under the Unlicense.",
    "Unlicense 2": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
    distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from
    the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
    redistribute it freely""",
}


class Templates:
    """Bigrams of the templates, with an inverted index from bigrams to templates."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = sorted(templates)
        words = words_of(texts_of(pa.array([templates[n] for n in self.names], pa.string())), NOT_ALNUM)
        at, hashes = window_hashes(words, 2)
        pairs = np.unique(np.column_stack([hashes, words.row[at].astype(np.uint64)]), axis=0)
        self.hashes, self.owners = pairs[:, 0].copy(), pairs[:, 1].astype(np.int64)
        #: Distinct bigrams, and bigrams of a window, of each template.
        self.sizes = np.bincount(self.owners, minlength=len(self.names))
        self.lengths = np.bincount(words.row[at], minlength=len(self.names))

    def matches(self, texts: Texts, threshold: float) -> Iterator[tuple[int, int, int, int, float]]:
        """(row, first word, words, template, Dice) of each match that stays."""
        words = words_of(texts, NOT_ALNUM)
        at, hashes = window_hashes(words, 2)
        low, high = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
        hit = np.flatnonzero(high > low)
        if not len(hit):
            return
        # Every pair of a known bigram's place and a template that holds it.
        many = high[hit] - low[hit]
        place = np.repeat(hit, many)
        owner = self.owners[np.repeat(low[hit] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())]
        least = np.ceil(threshold / (2 - threshold) * self.sizes - 1e-9).astype(np.int64)
        row = words.row[at[place]]
        seen = np.unique(np.column_stack([row, owner, hashes[place].view(np.int64)]), axis=0)
        pairs, counts = np.unique(seen[:, :2], axis=0, return_counts=True)
        pairs = pairs[counts >= least[pairs[:, 1]]]
        if not len(pairs):
            return
        first = np.searchsorted(words.row[at], np.arange(len(texts) + 1))
        order = np.lexsort((place, owner, row))
        key = row[order] * len(self.names) + owner[order]
        held: dict[int, list[tuple[float, int, int, int, int]]] = {}
        for r, t in pairs.tolist():
            own = place[order[slice(*np.searchsorted(key, [r * len(self.names) + t, r * len(self.names) + t + 1]))]] - first[r]
            held.setdefault(r, []).extend(self._windows(hashes[first[r] : first[r + 1]], own, t, threshold))
        for r, found in held.items():
            taken = np.zeros(first[r + 1] - first[r] + 1, bool)
            for less, _, t, start, length in sorted(found):
                if not taken[start : start + length + 1].any():
                    taken[start : start + length + 1] = True
                    yield r, start, length + 1, t, -less

    def _windows(self, hashes: np.ndarray, known: np.ndarray, t: int, threshold: float) -> Iterator[tuple[float, int, int, int, int]]:
        """(-Dice, -bigrams, template, first word, bigrams of the window) of the windows of a text that reach the threshold."""
        length, size = min(int(self.lengths[t]), len(hashes)), int(self.sizes[t])
        marks = np.zeros(len(hashes) + 1, np.int64)
        marks[known + 1] = 1
        sums = np.cumsum(marks)
        shared = sums[length:] - sums[:-length] if length else np.zeros(0, np.int64)
        is_known = marks[1:] > 0
        for start in np.flatnonzero(shared >= math.ceil(threshold / (2 - threshold) * size - 1e-9)).tolist():
            window = hashes[start : start + length]
            n = len(np.unique(window))
            dice = 2 * len(np.unique(window[is_known[start : start + length]])) / (n + size)
            if dice >= threshold:
                yield -dice, -size, t, start, length


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, word, n_words, template, dice): a row per match; ``word`` counts the words before it."""
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("word", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("template", T.StringType()),
            T.StructField("dice", T.DoubleType()),
        ]
    )
    known = Templates(templates)

    def run(batches):
        names = pa.array(known.names)
        for batch in batches:
            for piece, texts in slices(batch, text_col):
                found = list(known.matches(texts, threshold))
                if found:
                    row, word, n, best, dice = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            piece.column(id_col).take(pa.array(row, pa.int64())),
                            pa.array(word, pa.int64()),
                            pa.array(n, pa.int64()),
                            names.take(pa.array(best, pa.int64())),
                            pa.array(dice, pa.float64()),
                        ],
                        names=schema.names,
                    )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def licences(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, license, n_matches, best_dice, first_word): a row per id and licence, the templates of one licence together."""
    found = scan(docs, id_col=id_col, **options).withColumn("license", F.substring_index("template", " ", 1))
    return found.groupBy(id_col, "license").agg(
        F.count("*").alias("n_matches"), F.max("dice").alias("best_dice"), F.min("word").alias("first_word")
    )
