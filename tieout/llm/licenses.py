"""License scans by patience alignment against templates.

Words that occur once in both texts are anchors; the longest increasing chain of them is kept
and the gaps between are aligned in the same way. Where a gap has no such word the longest
common run anchors it. The share of a template's words that are aligned is its coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import found_by_tasks

WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")

#: Notices as their licences word them.
TEMPLATES = {
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files (the \"Software\"), to deal in the Software without"
        " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
        " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
        " Software is furnished to do so, subject to the following conditions: The above copyright notice"
        " and this permission notice shall be included in all copies or substantial portions of the"
        " Software."
    ),
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in"
        " writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT"
        " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the"
        " specific language governing permissions and limitations under the License."
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the"
        " GNU General Public License as published by the Free Software Foundation, either version 3 of"
        " the License, or (at your option) any later version. This program is distributed in the hope"
        " that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
        " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for"
        " more details."
    ),
    "mit-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT"
        " NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND"
        " NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,"
        " DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,"
        " OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without"
        " fee is hereby granted, provided that the above copyright notice and this permission notice appear"
        " in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH"
        " REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO"
        " EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR"
        " ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF"
        " CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
        " PERFORMANCE OF THIS SOFTWARE."
    ),
    "bsd-2-clause-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met: 1. Redistributions of source code must retain the"
        " above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions"
        " in binary form must reproduce the above copyright notice, this list of conditions and the"
        " following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-3-clause-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse"
        " or promote products derived from this software without specific prior written permission."
    ),
    "bsd-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR"
        " IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND"
        " FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR"
        " CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL"
        " DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,"
        " DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER"
        " IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT"
        " OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the"
        " authors be held liable for any damages arising from the use of this software. Permission is"
        " granted to anyone to use this software for any purpose, including commercial applications, and to"
        " alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this"
        " software must not be misrepresented; you must not claim that you wrote the original software. If"
        " you use this software in a product, an acknowledgment in the product documentation would be"
        " appreciated but is not required. 2. Altered source versions must be plainly marked as such, and"
        " must not be misrepresented as being the original software. 3. This notice may not be removed or"
        " altered from any source distribution."
    ),
    "gpl-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation; either version 2 of the"
        " License, or (at your option) any later version. This program is distributed in the hope that it"
        " will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or"
        " FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should"
        " have received a copy of the GNU General Public License along with this program; if not, write to"
        " the Free Software Foundation, Inc."
    ),
    "lgpl-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " Lesser General Public License as published by the Free Software Foundation; either version 2.1 of"
        " the License, or (at your option) any later version. This library is distributed in the hope that"
        " it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY"
        " or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "agpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " Affero General Public License as published by the Free Software Foundation, either version 3 of"
        " the License, or (at your option) any later version. This program is distributed in the hope that"
        " it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY"
        " or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of"
        " the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy,"
        " modify, publish, use, compile, sell, or distribute this software, either in source code form or"
        " as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
}


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence that increases in both places; ``pairs`` come by first place."""
    tails: list[int] = []
    ends: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        j = bisect_left(tails, b)
        back[i] = ends[j - 1] if j else -1
        if j == len(tails):
            tails.append(b)
            ends.append(i)
        else:
            tails[j], ends[j] = b, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places (in a, in b), increasing in both. Gaps wait on a list, not on the stack."""
    out = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place_b = {w: i for i, w in enumerate(b[b0:b1], b0) if once_b[w] == 1}
        pairs = [(i, place_b[w]) for i, w in enumerate(a[a0:a1], a0) if once_a[w] == 1 and w in place_b]
        anchors = chain(pairs)
        if not anchors:
            if not once_a.keys() & once_b.keys():
                continue
            run = SequenceMatcher(None, a, b, autojunk=False).find_longest_match(a0, a1, b0, b1)
            anchors = [(run.a + i, run.b + i) for i in range(run.size)]
        out += anchors
        before_a, before_b = a0, b0
        for i, j in [*anchors, (a1, b1)]:
            gaps.append((before_a, i, before_b, j))
            before_a, before_b = i + 1, j + 1
    return sorted(out)


class Template:
    def __init__(self, name: str, text: str):
        self.name, self.words = name, words(text)
        self.counts = Counter(self.words)


def stretches(own: list[str], template: Template) -> Iterator[list[int]]:
    """Places of template words, cut where a break of other words is longer than the template."""
    size, counts = len(template.words), template.counts
    hits = [i for i, w in enumerate(own) if w in counts]
    start = 0
    for end in range(1, len(hits) + 1):
        if end == len(hits) or hits[end] - hits[end - 1] > size:
            yield hits[start:end]
            start = end


def cores(own: list[str], hits: list[int], template: Template, least: float) -> list[tuple[int, int]]:
    """Shortest parts (from, to) that hold enough of the template's words, apart from each other.

    Whatever covers the template to ``least`` holds such a part or meets one, however many words
    are inserted. Where parts overlap the shorter one is taken, then the first.
    """
    need = least * len(template.words) - 1e-9
    counts = template.counts
    held: Counter[str] = Counter()
    have, left, parts = 0, 0, []
    for i in hits:
        w = own[i]
        held[w] += 1
        have += held[w] <= counts[w]
        if have < need:
            continue
        while True:
            first = own[hits[left]]
            if held[first] <= counts[first] and have - 1 < need:
                break
            have -= held[first] <= counts[first]
            held[first] -= 1
            left += 1
        parts.append((hits[left], i + 1))
    taken: list[tuple[int, int]] = []
    for part in sorted(parts, key=lambda p: (p[1] - p[0], p)):
        at = bisect_left(taken, part)
        if (at == 0 or taken[at - 1][1] <= part[0]) and (at == len(taken) or part[1] <= taken[at][0]):
            taken.insert(at, part)
    return taken


def best_alignment(own: list[str], template: Template, least: float) -> tuple[float, int, int] | None:
    """Largest coverage of the template, with the first and the end word; ties to the first.

    Each core is aligned with a template's length on both sides, and with more as long as that
    aligns more words. If no core of a stretch is covered, or the stretch is not much longer than
    the template, the whole stretch is aligned as well.
    """
    size, best = len(template.words), None
    for hits in stretches(own, template):
        if len(hits) < least * size - 1e-9:
            continue
        first, last = hits[0], hits[-1] + 1
        parts = cores(own, hits, template, least)
        found = []
        for start, end in parts:
            aligned: list[tuple[int, int]] = []
            while True:
                start, end = max(first, start - size), min(last, end + size)
                wider = [(start + i, j) for i, j in patience(own[start:end], template.words)]
                if len(wider) <= len(aligned):
                    break
                aligned = wider
                if len(aligned) == size or (start, end) == (first, last):
                    break
            found.append(aligned)
        short = last - first <= 4 * size  # then the whole is cheap to align too
        if short or (parts and max(map(len, found)) / size < least):
            found.append([(first + i, j) for i, j in patience(own[first:last], template.words)])
        for aligned in found:
            coverage = len(aligned) / size
            if coverage >= least and (best is None or coverage > best[0]):
                best = (coverage, aligned[0][0], aligned[-1][0] + 1)
    return best


def _scan(templates: list[Template], least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                own = words(text)
                present = set(own)
                for t in templates:
                    # aligned words are words both have
                    if sum(n for w, n in t.counts.items() if w in present) < least * len(t.words):
                        continue
                    if found := best_alignment(own, t, least):
                        rows.append((doc_id, t.name, *found))
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                names=["doc_id", "license", "coverage", "first_word", "end_word"],
            )

    return run


def find_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8
) -> DataFrame:
    """(doc_id, license, coverage, first_word, end_word) for each template that a document
    covers to ``least``; the best place, ties to the first. A text is cut where words that the
    template lacks run on for longer than the template is, so a licence with so long an insertion
    counts as its parts. Words are runs of letters and
    digits, joined by inner dots and hyphens, in lower case.

    Null and empty texts and empty templates give no row. A row without doc_id gives rows with
    a null id, repeated rows give repeated rows. Extra columns are not looked at. Templates are
    a parameter of a size fixed by the caller; documents are never shuffled.
    """
    found_by_tasks(docs.sparkSession)
    own = [Template(n, t) for n, t in (templates or TEMPLATES).items()]
    own = [t for t in own if t.words]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _scan(own, least),
        "doc_id long, license string, coverage double, first_word long, end_word long",
    )
