r"""License scans by patience alignment of texts with templates.

A text's words near a template's rarer words are aligned with the template:
words that occur once in both are anchors, the longest increasing run of them is
kept, and the gaps between anchors (and the equal words next to them) are aligned
the same way until nothing is unique. Coverage is the share of the template's
words that found a partner; 80 % or more is a finding if the words that
name the license, its version and variant are among them and none of another is. A text may hold several
licenses and several copies of one; of findings that overlap (templates that are
alike) the best covered stays, then the longest, then the first.

Texts are skipped without alignment only where no finding is possible: 80 % of a
template cannot be covered when none of a fifth of its words (plus one) is there.

Defined cases: a null or empty text has no finding (license is null, coverage 0).
Offsets count code points, ends exclusive. A text of any length is searched
whole. Repeated rows get equal rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspan.shipping import ship

MIN_COVERAGE = 0.8
#: Characters of a text that are searched at once; pieces overlap by more than any finding is long.
PIECE = 1 << 20
_WORD = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")
_COMMON = frozenset("a an and any as at be by for from in is it its no not of on or that the this to under with you your may must shall".split())

_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
# Notices, grants and whole texts of public licenses, by name. Grants stand for a license of which only the opening is there.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "lgpl-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "bsd": "Released under the BSD License.",
    "boost-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
    "boost-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "cc0-1.0": "This work is licensed under the Creative Commons CC0 1.0 Universal License.",
    "cc-by-4.0-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-short": "Licensed under CC BY-SA 4.0.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "bsd-2-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. " + _BSD_DISCLAIMER,
    "bsd-3-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _BSD_DISCLAIMER,
    "zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "boost-text": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
}
_CC = "nc nd sa noncommercial noderivatives noderivs sharealike"
#: Words of a template that a finding must hold, and words that must not stand among its others: they name another license.
MARKS = {
    "apache-2.0": ("apache 2", ""), "apache-2.0-header": ("2", ""), "mit": ("mit", ""), "bsd": ("bsd", ""), "mit-grant": ("", "organization"), "boost-grant": ("organization", ""), "boost-1.0": ("boost 1", ""),
    "gpl-2.0": ("gnu general public 2", "lesser library affero"), "gpl-3.0": ("gnu general public 3", "lesser library affero"), "lgpl-3.0": ("gnu lesser public 3", "affero"), "agpl-3.0": ("gnu affero public 3", "lesser"),
    "gpl-header": ("gnu general public", "lesser affero"), "lgpl-header": ("gnu lesser public", "affero"), "agpl-header": ("gnu affero public", "lesser"), "mpl-2.0": ("mozilla 2", ""), "epl-2.0": ("eclipse 2", ""),
    "mit-text": ("", "organization"), "bsd-2-text": ("", "neither endorse"), "bsd-3-text": ("neither endorse", ""), "boost-text": ("organization", ""), "apache-2.0-notice": ("apache 2", ""), "gpl-notice": ("gnu general public", "lesser affero"),
    "cc0-1.0": ("cc0 1", ""), "cc-by-nc-4.0": ("cc by nc 4", "nd sa"), "cc-by-4.0": ("attribution 4", _CC), "cc-by-sa-4.0": ("sharealike 4", "nc nd noncommercial noderivatives"), "cc-by-4.0-short": ("cc by 4", _CC), "cc-by-sa-4.0-short": ("cc by sa 4", "nc nd"),
}


def words(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end); a whole version is the same with and without its .0."""
    return [(w[:-2] if w.endswith(".0") and w[:-2].isdigit() else w, a, b) for w, a, b in ((m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text))]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by the first, whose seconds increase."""
    tails: list[int] = []
    last: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(tails, y)
        if k == len(tails):
            tails.append(y)
            last.append(i)
        else:
            tails[k], last[k] = y, i
        back[i] = last[k - 1] if k else -1
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs (i, j) of equal words of a and b, increasing in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        na, nb = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if nb[w] == 1}
        run = _increasing([(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if na[w] == 1 and w in place])
        if run:
            edges = [(a0 - 1, b0 - 1), *run, (a1, b1)]
            out += run
            todo += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


class Templates:
    """Templates as words, with the words that a text must share with each."""

    def __init__(self, templates: dict[str, str]):
        self.rows = []
        self.least: dict[str, int] = {}
        self.reach = 0
        for name, text in templates.items():
            t = [w for w, _, _ in words(text)]
            key = sorted(set(t) - _COMMON, key=lambda w: (-len(w), w)) or sorted(set(t))
            spare = int((1 - MIN_COVERAGE) * len(t) + 1e-9)
            self.rows.append((name, t, frozenset(key), frozenset(self._triggers(t, key, spare))))
            self.least[name] = sum(w in key for w in t) - spare
            self.reach = max(self.reach, 12 * len(text) + 1_000)
        self.triggers = sorted(frozenset().union(*(row[3] for row in self.rows)))
        self.marks = {name: [frozenset(x.split()) for x in MARKS[name]] for name, text in templates.items() if name in MARKS and text == TEMPLATES.get(name)}

    @staticmethod
    def _triggers(t: list[str], key: list[str], spare: int) -> list[str]:
        """Words of which more than spare occurrences stand in the template; a covered text has one of them."""
        n, out, held = Counter(t), [], 0
        # In a long template the longer words that it repeats, so that few are enough and ordinary texts hold none.
        first = sorted(key, key=lambda w: (len(w) < 6, -n[w], -len(w), w)) if len(t) > 40 else key
        for w in first + sorted(set(t) - set(key)):
            out.append(w)
            held += n[w]
            if held > spare:
                break
        return out

    def find(self, text: str) -> list[tuple[str, float, int, int]]:
        """(name, coverage, start, end) of every finding, in text order."""
        found: list[tuple[str, float, int, int]] = []
        for at, piece in self._pieces(text):
            found += [(name, c, at + a, at + b) for name, c, a, b in self._in(piece)]
        # Of findings that overlap the best covered stays; those that stay are disjoint, so their order is that of their ends too.
        starts: list[int] = []
        kept: list[tuple[str, float, int, int]] = []
        for f in sorted(found, key=lambda f: (-f[1], f[2] - f[3], f[2], f[0])):
            i = bisect_left(starts, f[3])
            if not i or kept[i - 1][3] <= f[2]:
                starts.insert(i, f[2])
                kept.insert(i, f)
        return kept

    def _pieces(self, text: str) -> Iterator[tuple[int, str]]:
        """Overlapping pieces of a long text; the overlap holds any finding."""
        at = 0
        while len(text) - at > PIECE + self.reach:
            end = at + PIECE + self.reach
            while text[end - 1].isalnum() and text[end].isalnum() and end < min(len(text) - 1, at + 2 * PIECE):
                end += 1
            yield at, text[at:end]
            at += PIECE
            while text[at - 1].isalnum() and text[at].isalnum() and at < end - self.reach // 2:
                at += 1
        yield at, text[at:]

    def _in(self, text: str) -> list[tuple[str, float, int, int]]:
        low = text.lower()
        there = {w for w in self.triggers if w in low}
        open_ = [row for row in self.rows if not row[3].isdisjoint(there)] if there else []
        if not open_:
            return []
        ws = words(text)
        plain = [w for w, _, _ in ws]
        where: dict[str, list[int]] = {}
        wanted = frozenset().union(*(row[2] for row in open_))
        for i, w in enumerate(plain):
            if w in wanted:
                where.setdefault(w, []).append(i)
        found = []
        for name, t, key, _ in open_:
            at = sorted(i for w in key for i in where.get(w, ()))
            # Runs of key words; a finding's key words are no further apart than the words it may lack or add.
            gap, first, last, held = len(t) + 4, -1, -1, 0
            for i in [*at, len(plain) + 2 * gap]:
                if first >= 0 and i - last > gap:
                    # A covered text holds as many key words as the template has, but for those it may lack.
                    if held >= self.least[name]:
                        found += self._aligned(name, t, plain, first, last)
                    first, held = -1, 0
                first, last, held = (first if first >= 0 else i), i, held + 1
        return [(name, c, ws[a][1], ws[b][2]) for name, c, a, b in found]

    def _aligned(self, name: str, t: list[str], plain: list[str], first: int, last: int) -> list[tuple[str, float, int, int]]:
        """(name, coverage, first word, last word) of one template's findings among plain[first..last] and its surroundings; long runs are taken in steps."""
        must, foreign = self.marks.get(name, (frozenset(), frozenset()))
        out, n, lo = [], len(t), max(0, first - len(t))
        spare = int((1 - MIN_COVERAGE) * n + 1e-9)
        opening = frozenset(t[: spare + 1])
        while lo <= last:
            # No alignment near lo can pair more words than both sides have.
            if self._shared(t, plain, lo, lo + 3 * n + 4) < MIN_COVERAGE * n:
                lo += n
                continue
            spans = [(lo, min(len(plain), lo + 3 * n))]
            # Copies side by side hide each other's unique words; then each is tried from where it may begin.
            spans += [(i, min(len(plain), i + n + spare + 4)) for i in range(lo, min(len(plain), lo + n)) if plain[i] in opening]
            for x, y in spans:
                if self._shared(t, plain, x, y) < MIN_COVERAGE * n:
                    continue
                pairs = patience(t, plain[x:y])
                held = {y for _, y in pairs}
                named = len(pairs) >= MIN_COVERAGE * n and must <= {t[i] for i, _ in pairs}
                if named and not any(plain[x + j] in foreign for j in range(pairs[0][1], pairs[-1][1]) if j not in held):
                    a, b = x + pairs[0][1], x + pairs[-1][1]
                    out.append((name, len(pairs) / n, a, b))
                    lo = b + 1
                    break
            else:
                lo += n
        return out

    @staticmethod
    def _shared(t: list[str], plain: list[str], x: int, y: int) -> int:
        """The most words that an alignment with plain[x:y] could pair."""
        return sum((Counter(t) & Counter(plain[x:y])).values())


def _scanner(templates: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Templates(templates)
        for batch in batches:
            found = [t.find(x.as_py() or "") for x in batch["text"]]
            best = [max(f, key=lambda x: (x[1], -x[2], x[0]), default=(None, 0.0, None, None)) for f in found]
            said = [",".join(f"{name}:{round(1000 * c)}:{a}:{b}" for name, c, a, b in f) for f in found]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([len(f) for f in found], pa.int64()), pa.array([b[0] for b in best], pa.string()), pa.array([b[1] for b in best], pa.float64()), pa.array([b[2] for b in best], pa.int64()), pa.array([b[3] for b in best], pa.int64()), pa.array(said, pa.string())], names=["doc_id", "n_findings", "license", "coverage", "start", "end", "findings"])

    return run


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_findings, the best finding and all findings (name:permille:start:end) for every row of docs."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scanner(templates or TEMPLATES), "doc_id long, n_findings long, license string, coverage double, start long, end long, findings string")
