"""License scans by patience alignment.

A text window and a template are aligned like this: words that occur exactly once in both are anchors;
the longest increasing subsequence of anchor positions is kept; the gaps between kept anchors are
aligned in the same way, after equal words at either end of a gap have been matched.  ``coverage`` is
the share of the template's words that found a partner.  A match also holds the template's *marks*, the
phrases that tell it from other licenses (name and version), word by word and without a word between.

Each document is scanned whole, in overlapping windows of twice the template's length.  A window is
aligned only if it holds enough of the template's words to reach the threshold at all (a count that
coverage cannot exceed), so skipping loses no match.  The scan is one map; templates are a parameter.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

COVERAGE = 0.8
# Words whose number a worker remembers; a full cache starts afresh.
MAX_CACHED = 500_000

# Notices as their licenses word them (public texts).
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                         "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                         "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                         "permissions and limitations under the License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                      "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
                      "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                      "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                      "following conditions: The above copyright notice and this permission notice shall be included in all "
                      "copies or substantial portions of the Software.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                      "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                      "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
                      "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                          "that the following conditions are met: Redistributions of source code must retain the above copyright "
                          "notice, this list of conditions and the following disclaimer.",
    "bsd-line": "Released under the BSD License.",
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-3.0-line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "lgpl-2.1-line": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "agpl-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "mpl-2.0-line": "Licensed under the Mozilla Public License, Version 2.0.",
    "epl-2.0-line": "Licensed under the Eclipse Public License, Version 2.0.",
    "isc-line": "Released under the ISC License.",
    "cc-by-4.0-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-short": "Licensed under CC BY-SA 4.0.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0-line": "Licensed under CC0 1.0 Universal.",
}
_FSF = ("This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by the "
        "Free Software Foundation, either version {1} of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {0} for more details. You should have received a copy of "
        "the {0} along with this program. If not, see <https://www.gnu.org/licenses/>.")
_WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
             "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
             "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
             "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_CLAUSES = (TEMPLATES["bsd-redistribution"] + " Redistributions in binary form must reproduce the above copyright notice, this list "
                "of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_THIRD = (" Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
              "derived from this software without specific prior written permission.")
_BSD_END = (" THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
            "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
            "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
            "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
            "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
            "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
TEMPLATES |= {
    "mit-notice": TEMPLATES["mit-permission"] + " " + _WARRANTY,
    "bsd-2-clause": _BSD_CLAUSES + _BSD_END,
    "bsd-3-clause": _BSD_CLAUSES + _BSD_THIRD + _BSD_END,
    "gpl-2.0-notice": _FSF.format("GNU General Public License", "2"),
    "lgpl-3.0-notice": _FSF.format("GNU Lesser General Public License", "3"),
    "lgpl-2.1-notice": _FSF.format("GNU Lesser General Public License", "2.1"),
    "agpl-3.0-notice": _FSF.format("GNU Affero General Public License", "3"),
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                      "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "epl-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                      "which is available at https://www.eclipse.org/legal/epl-2.0/",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                  "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
                  "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
                  "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
                  "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
                  "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
}
_GNU = {"gpl": "GNU General Public License", "lgpl": "GNU Lesser General Public License", "agpl": "GNU Affero General Public License"}
# Phrases that every match of a template holds.
MARKS: dict[str, tuple[str, ...]] = {
    "apache-2.0-line": ("Apache License", "2.0"), "apache-2.0-notice": ("Apache License", "Version 2.0"),
    "mit-line": ("MIT License",), "bsd-line": ("BSD License",), "isc-line": ("ISC License",),
    "mit-notice": ("Permission is hereby granted", "THE SOFTWARE IS PROVIDED"),
    "mpl-2.0-line": ("Mozilla Public License", "2.0"), "mpl-2.0-notice": ("Mozilla Public License", "2.0"),
    "epl-2.0-line": ("Eclipse Public License", "2.0"), "epl-2.0-notice": ("Eclipse Public License 2.0",),
    "cc-by-nc-4.0-line": ("CC BY-NC 4.0",), "cc-by-4.0-short": ("CC BY 4.0",), "cc-by-sa-4.0-short": ("CC BY-SA 4.0",),
    "cc-by-4.0-line": ("Creative Commons Attribution 4.0",), "cc-by-sa-4.0-line": ("Creative Commons Attribution-ShareAlike 4.0",),
    "cc0-1.0-line": ("CC0 1.0",), "bsd-3-clause": ("Neither the name", "endorse or promote products"),
    # The third clause would stand between these words.
    "bsd-2-clause": ("with the distribution THIS SOFTWARE IS PROVIDED",),
    **{f"{name}-{version}-{kind}": (_GNU[name], "version " + version.removesuffix(".0"))
       for name, version in (("gpl", "2.0"), ("gpl", "3.0"), ("lgpl", "2.1"), ("lgpl", "3.0"), ("agpl", "3.0")) for kind in ("line", "notice")},
}


def normal_word(token: str) -> str:
    """Lower case without punctuation at either end."""
    return token.lower().strip(".,;:!?()[]{}<>\"'`*#/|&$%_-")


def words_of(text: str) -> list[str]:
    return [w for t in text.split() if (w := normal_word(t))]


def longest_increasing(values: list[int]) -> list[int]:
    """Indexes of a longest strictly increasing subsequence (patience piles with back links)."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Matched positions (i, j) of two sequences, increasing in both: patience alignment."""
    matched: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            matched.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            matched.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {w: x for x, w in enumerate(b[j:j_end], j) if in_b[w] == 1}
        anchors = [(x, place[w]) for x, w in enumerate(a[i:i_end], i) if in_a[w] == 1 and w in place]
        if not anchors:
            continue
        kept = [anchors[x] for x in longest_increasing([y for _, y in anchors])]
        matched += kept
        for (p, q), (p_end, q_end) in zip([(i - 1, j - 1), *kept], [*kept, (i_end, j_end)], strict=True):
            if p + 1 < p_end and q + 1 < q_end:
                todo.append((p + 1, p_end, q + 1, q_end))
    return sorted(matched)


def _marked(pairs: list[tuple[int, int]], places: list[list[range]]) -> bool:
    """Each mark is matched in one of its places, by words of the text that follow each other."""
    if not places:
        return True
    partner = {j: i for i, j in pairs}
    return all(any(place[0] in partner and all(partner.get(j) == partner[place[0]] + j - place[0] for j in place) for place in mark) for mark in places)


class Scanner:
    """Finds the templates in one text after another; remembers which words a template has."""

    def __init__(self, templates: dict[str, str], coverage: float, marks: dict[str, tuple[str, ...]] | None = None):
        self.coverage, self.numbers, self.cache = coverage, {}, {}
        self.templates = []
        for name, text in templates.items():
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            if ids:
                places = [self._places(ids, [self.numbers.get(w) for w in words_of(mark)]) for mark in (marks or {}).get(name, ())]
                self.templates.append((name, ids, places, Counter(ids), *np.unique(ids, return_counts=True)))

    @staticmethod
    def _places(ids: list[int], mark: list) -> list[range]:
        """Where the template holds the mark."""
        found = [range(j, j + len(mark)) for j in range(len(ids) - len(mark) + 1) if ids[j:j + len(mark)] == mark]
        if not found:
            raise ValueError("a mark is not part of its template")
        return found

    def _number(self, token: str) -> int:
        """0 of a word no template has, -1 of a token that is punctuation alone."""
        n = self.cache.get(token)
        if n is None:
            if len(self.cache) >= MAX_CACHED:
                self.cache.clear()
            word = normal_word(token)
            n = self.cache[token] = self.numbers.get(word, 0) if word else -1
        return n

    def scan(self, text: str) -> list[tuple]:
        """(template, first word, last word, matched, coverage) of the best, not overlapping matches of each template."""
        tokens = np.fromiter(map(self._number, text.split()), dtype=np.int64)
        ids = tokens[tokens >= 0]
        hits = np.flatnonzero(ids)
        if not len(hits):
            return []
        found, in_text = [], np.bincount(ids[hits], minlength=len(self.numbers) + 1)
        for name, template, places, counts, distinct, times in self.templates:
            size, need = len(template), self.coverage * len(template)
            if np.minimum(in_text[distinct], times).sum() < need:  # not even the whole text holds enough
                continue
            own = hits[np.isin(ids[hits], list(counts))]
            matches = []
            at = 0
            while at < len(own):
                # Windows start at a template word; each holds twice the template's words.
                start = int(own[at])
                end = int(np.searchsorted(own, start + 2 * size))
                inside = Counter(ids[own[at:end]].tolist())
                if sum(min(n, counts[w]) for w, n in inside.items()) >= need:
                    window = ids[start:start + 2 * size].tolist()
                    pairs = align(window, template)
                    if len(pairs) >= need and _marked(pairs, places):
                        matches.append((len(pairs), -(start + pairs[0][0]), start + pairs[-1][0]))
                at += 1
            used: list[tuple[int, int]] = []
            for matched, first, last in sorted(matches, reverse=True):
                if all(last < lo or -first > hi for lo, hi in used):
                    used.append((-first, last))
                    found.append((name, -first, last, matched, matched / size))
        return sorted(found, key=lambda x: (x[1], x[0]))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE,
                  id_col: str = "doc_id", text_col: str = "text", marks: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """A row per match: ``id_col``, license, first_word, last_word, matched_words, coverage.

    Word numbers count from 0 over the text's words (tokens of punctuation alone are none); a match of
    a short template inside a longer one is a row of its own.  Matches of one template do not overlap:
    the better covered, then the earlier stays.  NULL and empty texts match nothing; repeated rows are
    scanned each; an empty table or no templates gives no rows.  ``marks`` (by template; ``MARKS`` for the
    own templates) must be in every match.  Other columns are not read.
    """
    chosen = dict(TEMPLATES if templates is None else templates)
    required = dict(MARKS if templates is None and marks is None else marks or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen, coverage, required)
        for batch in batches:
            ids, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for match in scanner.scan(text):
                    ids.append(i)
                    rows.append(match)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64()))] + [pa.array([r[c] for r in rows], kinds[c]) for c in range(5)],
                ["_id", "license", "first_word", "last_word", "matched_words", "coverage"])

    slim = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    kind = slim.schema["_id"].dataType.simpleString()
    return (slim.mapInArrow(run, f"_id {kind}, license string, first_word long, last_word long, matched_words long, coverage double")
            .withColumnRenamed("_id", id_col))
