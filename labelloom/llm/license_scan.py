"""Licence scan: Dice coefficient over word bigrams against licence templates.

Texts and templates are normalised to lower-case words. A stretch of words matches a template with n bigrams if
2 * common / (stretch + n) reaches the threshold, common counting each bigram at most as often as either side has
it. So the stretch has between n t / (2 - t) and n (2 - t) / t bigrams, and at least n t / (2 - t) of the
template's bigrams must lie close together. These bounds prune almost every template of almost every text from
the positions of template bigrams alone; stretches that begin and end with such a bigram are then scored exactly.
Overlapping matches give way to the better one. Whole texts are scanned, line breaks do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import word_bytes

THRESHOLD = 0.8

# Public licence texts and customary notices, without copyright lines.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
THE POSSIBILITY OF SUCH DAMAGE."""


def _gnu(name: str, version: str) -> str:
    """The customary header of a file under a licence of the GNU family."""
    what, kind = ("library", "Lesser ") if name == "LGPL" else ("program", "Affero " if name == "AGPL" else "")
    return f"""This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public
License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later
version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details. You
should have received a copy of the GNU {kind}General Public License along with this {what}. If not, see
https://www.gnu.org/licenses/."""


TEMPLATES: list[tuple[str, str]] = [
    ("MIT", _MIT),
    ("ISC", _ISC),
    ("BSD-2-Clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    ("BSD-3-Clause", f"{_BSD_HEAD} {_BSD_THIRD} {_BSD_TAIL}"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details. You should have received a copy of the GNU General Public License along with this program. If not, see
https://www.gnu.org/licenses/."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("All-rights-reserved", "All rights reserved. No part of this publication may be reproduced without permission."),
    ("All-rights-reserved", "All rights reserved."),
    ("GPL-2.0-or-later", _gnu("GPL", "2")),
    ("LGPL-2.1-or-later", _gnu("LGPL", "2.1")),
    ("LGPL-3.0-or-later", _gnu("LGPL", "3")),
    ("LGPL-3.0-or-later", _gnu("LGPL", "3").replace("library", "program")),
    ("AGPL-3.0-or-later", _gnu("AGPL", "3")),
    *(
        (f"{name}-{version}", f"{begin} under the GNU {kind} General Public License, version {said}.")
        for name, kind, version, said in (
            ("LGPL", "Lesser", "3.0", "3"), ("LGPL", "Lesser", "2.1", "2.1"), ("AGPL", "Affero", "3.0", "3"),
        )
        for begin in ("Licensed", "This work is licensed")
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "This work is licensed under a Creative Commons CC0 1.0 Universal License."),
    ("CC0-1.0", """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this
work."""),
    ("CC0-1.0", """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to
this software to the public domain worldwide. This software is distributed without any warranty. You should have received a copy
of the CC0 Public Domain Dedication along with this software. If not, see https://creativecommons.org/publicdomain/zero/1.0/."""),
]


class Scanner:
    """Finds stretches of words that match a template."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float) -> None:
        self.names = [name for name, _ in templates]
        self.threshold = threshold
        words: dict[bytes, int] = {}
        lists = [[words.setdefault(w, len(words) + 1) for w in word_bytes(text.encode())] for _, text in templates]
        self.words, self.base = words, len(words) + 1
        self.counts = [Counter(a * self.base + b for a, b in zip(ids, ids[1:], strict=False)) for ids in lists]
        self.sizes = np.array([sum(c.values()) for c in self.counts], np.int64)
        if (self.sizes == 0).any():
            raise ValueError("a template needs at least two words")
        owners: dict[int, list[int]] = {}
        for t, c in enumerate(self.counts):
            for bigram in c:
                owners.setdefault(bigram, []).append(t)
        self.bigrams = np.array(sorted(owners), np.int64)
        self.first = np.r_[0, np.cumsum([len(owners[b]) for b in self.bigrams.tolist()])].astype(np.int64)
        self.owners = np.array([t for b in self.bigrams.tolist() for t in owners[b]], np.int64)

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, float, int, int]]]:
        """Per text: (template, Dice, first word, words) of its matches in order of position."""
        number = self.words.get
        ids = [np.fromiter((number(w, 0) for w in word_bytes(t)), np.int64) for t in texts]
        sizes = np.array([i.size for i in ids], np.int64)
        flat = np.concatenate([*ids, np.zeros(1, np.int64)])
        text = np.repeat(np.arange(sizes.size), sizes)
        begin = np.cumsum(sizes) - sizes
        pair = np.flatnonzero((flat[:-1] > 0) & (flat[1:] > 0))
        pair = pair[pair + 1 < (begin + sizes)[text[pair]]] if pair.size else pair
        value = flat[pair] * self.base + flat[pair + 1]
        slot = np.minimum(np.searchsorted(self.bigrams, value), self.bigrams.size - 1)
        hit = self.bigrams[slot] == value
        pair, value, slot = pair[hit], value[hit], slot[hit]
        many = np.diff(self.first)[slot]
        at = np.repeat(np.arange(pair.size), many)
        template = self.owners[np.repeat(self.first[slot] - (np.cumsum(many) - many), many) + np.arange(at.size)]
        order = np.lexsort((pair[at], template, text[pair[at]]))
        at, template = at[order], template[order]
        place, owner = pair[at] - begin[text[pair[at]]], text[pair[at]]
        group = owner * len(self.names) + template
        heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if group.size else np.zeros(0, np.int64)
        tails = np.r_[heads[1:], group.size]
        found: list[list[tuple[int, float, int, int]]] = [[] for _ in texts]
        t = self.threshold
        enough = tails - heads >= self.sizes[template[heads]] * t / (2 - t) - 1e-9 if heads.size else np.zeros(0, bool)
        for a, b in zip(heads[enough].tolist(), tails[enough].tolist(), strict=True):
            k = int(template[a])
            found[owner[a]] += self._stretches(k, place[a:b].tolist(), value[at[a:b]].tolist())
        return [self._best(f) for f in found]

    def _stretches(self, k: int, place: list[int], value: list[int]) -> list[tuple[int, float, int, int]]:
        """Best stretch from each possible first bigram that reaches the threshold."""
        n, t, counts = int(self.sizes[k]), self.threshold, self.counts[k]
        longest, needed = n * (2 - t) / t, n * t / (2 - t)
        out, end = [], 0
        for i, start in enumerate(place):
            while end < len(place) and place[end] - start + 1 <= longest:
                end += 1
            if end - i < needed - 1e-9:
                continue
            left, common, best = dict(counts), 0, (0.0, 0)
            for j in range(i, end):
                if left[value[j]] > 0:
                    left[value[j]] -= 1
                    common += 1
                    dice = 2 * common / (place[j] - start + 1 + n)
                    if dice > best[0]:
                        best = (dice, place[j] - start + 2)
            if best[0] >= t - 1e-12:
                out.append((k, best[0], start, best[1]))
        return out

    def _best(self, found: list[tuple[int, float, int, int]]) -> list[tuple[int, float, int, int]]:
        """Matches that do not overlap a better one: higher Dice first, then the longer template, then its place in the list."""
        kept: list[tuple[int, float, int, int]] = []
        taken: set[int] = set()
        for m in sorted(found, key=lambda m: (-m[1], -int(self.sizes[m[0]]), m[0], m[2])):
            span = range(m[2], m[2] + m[3])
            if taken.isdisjoint(span):
                taken.update(span)
                kept.append(m)
        return sorted(kept, key=lambda m: m[2])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """(key, license, template, dice, start, n_words): one row per match, in word positions.

    ``template`` is the template's place in the list. Texts without a match, null and empty texts give no row. Rows
    with equal keys are scanned each. Other columns are not read.
    """
    given = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(given, threshold)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for at in range(0, batch.num_rows, 256):
                rows = [
                    (keys[at + i], scanner.names[m[0]], *m)
                    for i, found in enumerate(scanner.scan([d.as_py() or b"" for d in batch.column(1)[at : at + 256]])) for m in found
                ]
                columns = list(zip(*rows, strict=True)) if rows else [()] * 6
                types = [pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "license", "template", "dice", "start", "n_words"]
                )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").cast("binary").alias("data"))
    return rows.mapInArrow(run, "key long, license string, template int, dice double, start long, n_words long").withColumnRenamed("key", key)
