"""License scans: texts against licence templates by Dice over word bigrams.

Texts and templates are normalised alike: lower case, words of letters and
digits. Units of a text are its lines, runs of neighbouring lines that look
like a licence (at least ``LOOK`` of their bigrams occur in some template), and
the whole text. A unit matches the template with the largest Dice coefficient
over the two multisets of bigrams, if that is ``MIN_DICE`` or more. Since the
coefficient is at most 2 min(a, b) / (a + b), only templates whose number of
bigrams lies between t / (2 - t) and (2 - t) / t of the unit's are compared.

Units also are, for each template, the best windows of the text's words
regardless of lines: of all windows that match the template, the best, then
the best that does not overlap it, and so on. A window begins and ends at a
bigram of the template, and only where enough of them lie close together.
Of two units that cover more than half of the longer one together, the one of
the smaller coefficient (of equal ones the shorter) goes if they match
different templates; a notice inside a longer licence stays.

Most words of a short notice are the same for every licence, so its coefficient
alone would let "licensed under the Zebra Public License" pass for another. A unit
matches a template of at most ``SHORT`` bigrams only if it has all that name the licence:
those with a word outside ``GENERIC``, such as names and version numbers.

Cases: a null or empty text matches nothing; units and templates of one word
have no bigram and match nothing; of equal coefficients the first template by
name wins; repeated rows are reported each; extra columns are ignored; an
empty table or no templates give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from importlib import resources

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm.decontaminate import tokens
from strata.llm.tables import doc_texts
from strata.llm.text import column_bytes, ranges, slices, window_hashes

MIN_DICE = 0.8
LOOK = 0.5
SHORT = 24
#: Words that notices of any licence share.
GENERIC = set(
    "a all an and are author available be by can code copyright distributed extent file found governed has identifier in is it law licence license "
    "licensed neighboring of or possible program project related released rights software source spdx terms that the this to under use version waived work".split()
)
#: Starts and lengths of windows compared at once.
WINDOW_CELLS = 1 << 19
FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("license", T.StringType()),
    T.StructField("dice", T.DoubleType()),
    T.StructField("n_units", T.LongType()),
])

# Notices, headers and texts of public licences, without their copyright lines. One-word
# SPDX identifiers are not here: most of such a line is the same for all licences, even unknown ones.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS "
        "SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
        "EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
        "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, "
        "OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."
    ),
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have "
        "received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS "
        "IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
        "the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
        "notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
        "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE "
        "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have "
        "received a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission. THIS "
        "SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
        "EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
        "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, "
        "OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-2-Clause notice": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause notice": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0 sentence": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 sentence": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0 sentence": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0 sentence": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0 sentence": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0 sentence": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC-BY-ND-4.0 notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0 notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0 notice": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0 notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL notice": "This work is licensed under the GNU General Public License.",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0 header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have "
        "received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, "
        "Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
    ),
    "GPL-2.0 header with link": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have "
        "received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."
    ),
    "LGPL-2.1 notice": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1 header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This "
        "library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have "
        "received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software "
        "Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
    ),
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have "
        "received a copy of the GNU Lesser General Public License along with this program. If not, see https://www.gnu.org/licenses/."
    ),
    "MIT-0": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
        "the Software is furnished to do so. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
        "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MIT sentence": "This project is licensed under the MIT License.",
    "MPL-2.0 notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial "
        "or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software "
        "dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the "
        "public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "
        "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to https://unlicense.org/."
    ),
}
TEMPLATES |= {
    f"{i} SPDX": f"SPDX-License-Identifier: {i}"
    for i in (
        "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-2.0-only",
        "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MPL-2.0",
    )
}
#: Licences whose full text is a file of ``license_texts``.
FULL_TEXTS = ("AGPL-3.0", "Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")
TEMPLATES |= {n: resources.files("strata.llm").joinpath("license_texts", f"{n}.txt").read_text("utf-8") for n in FULL_TEXTS}


class Templates:
    """The bigrams of every template, and all of them together."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        words, hashes = tokens(pa.array([templates[n] for n in self.names], pa.string()))
        cut = words.first.tolist()
        self.bigrams = [Counter(bigrams(hashes[a:b]).tolist()) for a, b in zip(cut[:-1], cut[1:])]
        self.sizes = np.array([sum(b.values()) for b in self.bigrams], np.int64)
        # What a unit needs, besides the coefficient, to be a short template.
        named = np.array([words.data[a:b].tobytes().decode() not in GENERIC for a, b in zip(words.start, words.end)], bool)
        self.naming = [
            np.unique(bigrams(hashes[a:b])[named[a : b - 1] | named[a + 1 : b]]) if 1 < b - a <= SHORT + 1 else np.zeros(0, np.uint64)
            for a, b in zip(cut[:-1], cut[1:])
        ]
        # Every bigram with its templates and how often each has it, by bigram.
        gram = np.array([x for b in self.bigrams for x in b], np.uint64)
        order = np.argsort(gram, kind="stable")
        self.all, self.first = np.unique(gram[order], return_index=True)
        self.first = np.append(self.first, len(gram))
        self.of = np.repeat(np.arange(len(self.names)), [len(b) for b in self.bigrams])[order]
        self.times = np.array([c for b in self.bigrams for c in b.values()], np.int64)[order]

    def known(self, grams: np.ndarray) -> np.ndarray:
        """Which bigrams occur in any template."""
        if not len(self.all):
            return np.zeros(len(grams), bool)
        at = np.minimum(np.searchsorted(self.all, grams), len(self.all) - 1)
        return self.all[at] == grams

    def best(self, unit: np.ndarray) -> tuple[float, str] | None:
        """The largest Dice coefficient with a unit's bigrams, if it is enough, and its template."""
        n, own, found = len(unit), None, None
        low, high = MIN_DICE / (2 - MIN_DICE) * n, (2 - MIN_DICE) / MIN_DICE * n
        for k in np.flatnonzero((self.sizes > 0) & (self.sizes >= low) & (self.sizes <= high)):
            own = own or Counter(unit.tolist())
            common = sum(min(c, self.bigrams[k][g]) for g, c in own.items() if g in self.bigrams[k])
            dice = 2 * common / (n + int(self.sizes[k]))
            if dice >= MIN_DICE and (found is None or dice > found[0]) and self.named(k, unit):
                found = dice, self.names[k]
        return found

    def named(self, k: int, unit: np.ndarray) -> bool:
        """Whether a unit has all bigrams that name template ``k``."""
        return not len(self.naming[k]) or bool(np.isin(self.naming[k], unit).all())


def bigrams(hashes: np.ndarray) -> np.ndarray:
    return window_hashes(hashes, (0, 1))


def windows(grams: np.ndarray, doc: np.ndarray, templates: Templates) -> list[tuple[int, int, int, float]]:
    """Template, first and last bigram and coefficient of each template's best windows that
    overlap no better one of its own. ``doc`` is the text of each bigram, -1 between texts."""
    if not len(templates.all):
        return []
    at = np.minimum(np.searchsorted(templates.all, grams), len(templates.all) - 1)
    place = np.flatnonzero((templates.all[at] == grams) & (doc >= 0))
    count = np.diff(templates.first)[at[place]]
    entry = ranges(templates.first[at[place]], count)
    place = np.repeat(place, count)
    order = np.argsort(templates.of[entry], kind="stable")
    cut = np.searchsorted(templates.of[entry[order]], np.arange(len(templates.names) + 1))
    out = []
    for k, size in enumerate(templates.sizes.tolist()):
        if cut[k] == cut[k + 1]:
            continue
        mine = order[cut[k] : cut[k + 1]]
        p, times = place[mine], templates.times[entry[mine]]
        least = math.ceil(MIN_DICE / (2 - MIN_DICE) * size - 1e-9)
        most = math.floor((2 - MIN_DICE) / MIN_DICE * size + 1e-9)
        if len(p) < least:
            continue
        last = p[least - 1 :]
        starts = np.flatnonzero((last - p[: len(last)] < most) & (doc[last] == doc[p[: len(last)]]))
        if not len(starts):
            continue
        # A bigram counts if the template has it more often than the window before it does:
        # if the occurrence that many before lies before the window.
        by = np.lexsort((p, grams[p]))
        back = np.arange(len(by)) - times[by]
        same = (back >= 0) & (grams[p[by]] == grams[p[by[np.maximum(back, 0)]]])
        spent = np.empty(len(p), np.int64)
        spent[by] = np.where(same, p[by[np.maximum(back, 0)]], -1)
        found = []
        step = max(1, WINDOW_CELLS // most)
        for lo in range(0, len(starts), step):
            s = starts[lo : lo + step, None]
            e = s + np.arange(int((np.searchsorted(p, p[s[:, 0]] + most) - s[:, 0]).max()))
            inside = e < len(p)
            e = np.minimum(e, len(p) - 1)
            inside &= (p[e] - p[s] < most) & (doc[p[e]] == doc[p[s]])
            common = np.cumsum(inside & (spent[e] < p[s]), axis=1)
            dice = np.where(inside, 2 * common / (p[e] - p[s] + 1 + size), 0)
            best = np.argmax(dice, axis=1)
            top = dice[np.arange(len(s)), best]
            for i in np.flatnonzero(top >= MIN_DICE).tolist():
                a, b = int(p[s[i, 0]]), int(p[e[i, best[i]]])
                if templates.named(k, grams[a : b + 1]):
                    found.append((a, b, float(top[i])))
        # Windows that overlap form a group; of a group the best first, then what does not overlap it.
        group, end = [], -1
        for window in [*found, (len(grams) + 1, 0, 0.0)]:
            if window[0] > end:
                kept: list[tuple[int, int, float]] = []
                for a, b, dice in sorted(group, key=lambda w: (-w[2], w[0])):
                    if all(b < x or a > y for x, y, _ in kept):
                        kept.append((a, b, dice))
                out += [(k, *w) for w in kept]
                group = []
            group.append(window)
            end = max(end, window[1])
    return out


def _settled(units: list[tuple[float, int, int, str, bool]]) -> list[tuple[float, int, int, str, bool]]:
    """The units of one text (coefficient, first word, end, template, whether it is a window) without
    those that lose against another template on much the same words."""
    kept: list[tuple[float, int, int, str, bool]] = []
    for unit in sorted(units, key=lambda u: (-u[0], u[1] - u[2], u[3], u[4], u[1])):
        _, a, b, name, _ = unit
        if not any(n != name and 2 * (min(b, y) - max(a, x)) > max(b - a, y - x) for _, x, y, n, _ in kept):
            kept.append(unit)
    return kept


def find_licenses(texts: pa.Array, templates: Templates) -> list[tuple[int, str, float, int]]:
    """Text, licence, largest coefficient and number of matching units, for the texts of one slice."""
    words, hashes = tokens(texts)
    if len(hashes) < 2:
        return []
    # Lines are numbered through the slice; a text begins a new one.
    _, offsets = column_bytes(pc.utf8_lower(pc.fill_null(texts, "")))
    breaks = np.zeros(len(words.data) + 1, np.int64)
    breaks[:-1] += words.data == 10
    np.add.at(breaks, offsets[:-1], 1)
    line = np.cumsum(breaks)[words.start]
    grams = bigrams(hashes)
    known = templates.known(grams)
    inside = line[1:] == line[:-1]
    lines, at = np.unique(line, return_index=True)
    row = np.searchsorted(lines, line[:-1])
    size = np.bincount(row, inside, len(lines))
    hits = np.bincount(row, inside & known, len(lines))
    looks = (size > 0) & (hits >= LOOK * size)
    edges = np.append(at, len(line))
    doc = np.searchsorted(words.first, at, "right") - 1
    units: dict[int, list[tuple[float, int, int, str, bool]]] = {}

    def take(text: int, a: int, b: int) -> None:
        hit = templates.best(grams[a : b - 1])
        if hit:
            units.setdefault(text, []).append((hit[0], a, b, hit[1], False))

    which = np.flatnonzero(looks)
    for k in which.tolist():
        take(int(doc[k]), int(edges[k]), int(edges[k + 1]))
    # Runs of neighbouring lines of one text that look like a licence.
    for run in np.split(which, np.flatnonzero((np.diff(which) != 1) | (np.diff(doc[which]) != 0)) + 1):
        if len(run) > 1:
            take(int(doc[run[0]]), int(edges[run[0]]), int(edges[run[-1] + 1]))
    for text in np.unique(doc[which]).tolist():
        a, b = int(words.first[text]), int(words.first[text + 1])
        if known[a : b - 1].sum() >= LOOK * (b - a - 1):
            take(text, a, b)
    of = words.doc()
    for k, a, b, dice in windows(grams, np.where(of[1:] == of[:-1], of[:-1], -1), templates):
        units.setdefault(int(of[a]), []).append((dice, a, b + 2, templates.names[k], True))
    out = []
    for text, found in sorted(units.items()):
        by_name: dict[str, list[tuple[float, int, int, str, bool]]] = {}
        for unit in _settled(found):
            by_name.setdefault(unit[3], []).append(unit)
        for name, hits in sorted(by_name.items()):
            plain = [(a, b) for _, a, b, _, window in hits if not window]
            # A window on words of another unit of its licence is not one more place.
            more = {a for _, a, b, _, window in hits if window and all(b <= x or a >= y for x, y in plain)}
            out.append((text, name, max(h[0] for h in hits), len({a for a, _ in plain} | more)))
    return out


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row for each document and licence that a unit of it matches: the largest coefficient
    and the number of places where units match."""
    held = docs.sparkSession.sparkContext.broadcast(Templates(templates))  # as large as the given templates

    def run(batches):
        for batch in batches:
            _, offsets = column_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                part = batch.slice(lo, hi - lo)
                found = find_licenses(part.column(1), held.value)
                if found:
                    text, name, dice, n = zip(*found)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(text)), pa.array(name), pa.array(dice), pa.array(n, pa.int64())], names=FOUND.names)

    return doc_texts(docs).mapInArrow(run, FOUND)
