"""Licences by rules over known sentences.

A text is cut into units: lines, and sentences within them. From the beginning of a unit on, the longest known licence
sentence that ends with a unit is recognised; it may run over several lines. Known sentences are compared in normal
form (letters and digits in lower case, anything else one blank) and have identifiers. What a text holds is then a
sequence of identifiers, and ordered rules are matched against it: the first rule in the list whose identifiers follow
each other, with at most GAP_UNITS units of other text between two, takes them. Copyright lines between are no gap.

Texts without any of TRIGGERS, of which every known sentence holds one by construction, are left out before any Python
runs. A copyright line that ends in "all rights reserved" counts as that sentence; before a grant the sentence is part of
the granted licence, as in BSD headers, and else it is a proprietary notice. Null and empty texts
have no licence. Repeated rows are each reported. A licence that a text names twice is reported at each place. An empty
table gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import map_batches, texts_of

GAP_UNITS = 2

# Sentences of public licence texts and notices, by identifier.
SENTENCES = {
    "mit-name": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-as-is": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "mit-reference": ["Released under the MIT License.", "Licensed under the MIT License.", "Distributed under the MIT License.", "This project is licensed under the MIT License."],
    "apache-grant": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "apache-copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"],
    "apache-as-is": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "apache-limits": ["See the License for the specific language governing permissions and limitations under the License."],
    "apache-reference": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", "This project is licensed under the Apache License, Version 2.0.", "Apache License Version 2.0"],
    "gpl-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "gpl-details": ["See the GNU General Public License for more details."],
    "gpl-received": ["You should have received a copy of the GNU General Public License along with this program."],
    "gpl3-reference": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "Released under the GNU General Public License, version 3."],
    "gpl2-reference": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "mpl-terms": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "cc-by-reference": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa-reference": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc-reference": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-nd-reference": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "cc0-reference": ["This work is released under CC0 1.0, with a license to no one.", "Licensed under CC0 1.0."],
    "spdx-mit": ["SPDX-License-Identifier: MIT"],
    "spdx-apache": ["SPDX-License-Identifier: Apache-2.0"],
    "spdx-gpl3": ["SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0"],
    "spdx-bsd3": ["SPDX-License-Identifier: BSD-3-Clause"],
    "gpl2-free": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License.", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."],
    "lgpl21-free": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "lgpl3-free": ["This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "agpl3-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "spdx-gpl2": ["SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: GPL-2.0"],
    "spdx-lgpl21": ["SPDX-License-Identifier: LGPL-2.1-only", "SPDX-License-Identifier: LGPL-2.1-or-later", "SPDX-License-Identifier: LGPL-2.1"],
    "spdx-lgpl3": ["SPDX-License-Identifier: LGPL-3.0-only", "SPDX-License-Identifier: LGPL-3.0-or-later", "SPDX-License-Identifier: LGPL-3.0"],
    "spdx-agpl3": ["SPDX-License-Identifier: AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0-or-later", "SPDX-License-Identifier: AGPL-3.0"],
    "spdx-bsd2": ["SPDX-License-Identifier: BSD-2-Clause"],
    "spdx-isc": ["SPDX-License-Identifier: ISC"],
    "spdx-mpl": ["SPDX-License-Identifier: MPL-2.0"],
    "spdx-unlicense": ["SPDX-License-Identifier: Unlicense"],
    "spdx-cc-by": ["SPDX-License-Identifier: CC-BY-4.0"],
    "spdx-cc-by-sa": ["SPDX-License-Identifier: CC-BY-SA-4.0"],
    "spdx-cc-by-nc": ["SPDX-License-Identifier: CC-BY-NC-4.0"],
    "spdx-cc-by-nd": ["SPDX-License-Identifier: CC-BY-ND-4.0"],
    "spdx-cc0": ["SPDX-License-Identifier: CC0-1.0"],
    "rights-reserved": ["Copyright, all rights reserved.", "All rights reserved."],
    "mit-liability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "bsd-as-is": ["THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."],
    "bsd-liability": ["IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."],
    "isc-as-is": ["THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."],
    "isc-liability": ["IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."],
    "mpl-copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "gpl-written": ["You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."],
    "gpl-see": ["If not, see <https://www.gnu.org/licenses/>.", "If not, see <http://www.gnu.org/licenses/>."],
    "unlicense-anyone": ["Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "zlib-as-is": ["This software is provided 'as-is', without any express or implied warranty."],
    "zlib-liability": ["In no event will the authors be held liable for any damages arising from the use of this software."],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "boost-grant": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"],
    "boost-reference": ["Distributed under the Boost Software License, Version 1.0."],
    "epl-terms": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "spdx-zlib": ["SPDX-License-Identifier: Zlib"],
    "spdx-boost": ["SPDX-License-Identifier: BSL-1.0"],
    "spdx-epl": ["SPDX-License-Identifier: EPL-2.0"],
}

# Licences by the sentences that make them, the longer rule before a shorter one that it contains.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is", "mit-liability"]), ("MIT", ["mit-grant", "mit-notice", "mit-as-is"]), ("MIT", ["mit-grant"]), ("MIT", ["mit-name"]),
    ("MIT", ["mit-reference"]), ("MIT", ["spdx-mit"]),
    ("Apache-2.0", ["apache-grant", "apache-copy", "apache-as-is", "apache-limits"]), ("Apache-2.0", ["apache-grant"]),
    ("Apache-2.0", ["apache-reference"]), ("Apache-2.0", ["spdx-apache"]),
    ("GPL-3.0", ["gpl-free", "gpl-hope", "gpl-details", "gpl-received", "gpl-see"]),
    ("GPL-3.0", ["gpl-free", "gpl-hope", "gpl-details", "gpl-received"]), ("GPL-3.0", ["gpl-free"]),
    ("GPL-3.0", ["gpl3-reference"]), ("GPL-3.0", ["spdx-gpl3"]), ("GPL-2.0", ["gpl2-reference"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "bsd-liability"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-liability"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]), ("BSD-3-Clause", ["spdx-bsd3"]),
    ("ISC", ["isc-grant", "isc-as-is", "isc-liability"]), ("ISC", ["isc-grant"]), ("MPL-2.0", ["mpl-terms", "mpl-copy"]),
    ("MPL-2.0", ["mpl-terms"]), ("Unlicense", ["unlicense", "unlicense-anyone"]), ("Unlicense", ["unlicense"]),
    ("Zlib", ["zlib-as-is", "zlib-liability", "zlib-grant"]), ("Zlib", ["zlib-grant"]), ("Zlib", ["spdx-zlib"]),
    ("BSL-1.0", ["boost-grant"]), ("BSL-1.0", ["boost-reference"]), ("BSL-1.0", ["spdx-boost"]), ("EPL-2.0", ["epl-terms"]), ("EPL-2.0", ["spdx-epl"]),
    ("CC-BY-4.0", ["cc-by-reference"]), ("CC-BY-SA-4.0", ["cc-by-sa-reference"]), ("CC-BY-NC-4.0", ["cc-by-nc-reference"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-reference"]), ("CC0-1.0", ["cc0-reference"]),
    ("GPL-2.0", ["gpl2-free", "gpl-hope", "gpl-details", "gpl-written"]),
    ("GPL-2.0", ["gpl2-free", "gpl-hope", "gpl-details", "gpl-received"]), ("GPL-2.0", ["gpl2-free"]),
    ("LGPL-2.1", ["lgpl21-free"]), ("LGPL-3.0", ["lgpl3-free"]), ("AGPL-3.0", ["agpl3-free"]),
    ("GPL-2.0", ["spdx-gpl2"]), ("LGPL-2.1", ["spdx-lgpl21"]), ("LGPL-3.0", ["spdx-lgpl3"]), ("AGPL-3.0", ["spdx-agpl3"]),
    ("BSD-2-Clause", ["spdx-bsd2"]), ("ISC", ["spdx-isc"]), ("MPL-2.0", ["spdx-mpl"]), ("Unlicense", ["spdx-unlicense"]),
    ("CC-BY-4.0", ["spdx-cc-by"]), ("CC-BY-SA-4.0", ["spdx-cc-by-sa"]), ("CC-BY-NC-4.0", ["spdx-cc-by-nc"]),
    ("CC-BY-ND-4.0", ["spdx-cc-by-nd"]), ("CC0-1.0", ["spdx-cc0"]), ("Proprietary", ["rights-reserved"]),
]
# a grant after "All rights reserved" takes it
RULES = [
    rule for name, ids in RULES
    for rule in ([(name, ["rights-reserved", *ids])] if ids[0].endswith(("-grant", "-free")) else []) + [(name, ids)]
]

_UNIT = re.compile(r"[^\n]*?(?:[.!?:](?=\s|$)|(?=\n)|$)")
_WORD = re.compile(r"[^\W_]+")


def normal_words(text: str) -> tuple[str, ...]:
    return tuple(w.lower() for w in _WORD.findall(text))


# Parts of words that other text seldom has.
_RARE = ["license", "licence", "copyright", "warrant", "permission", "redistribut", "gnu"]


def trigger(sentence: str) -> str:
    """A part of one word of the sentence, so that a text with the sentence in any layout holds it."""
    words = normal_words(sentence)
    return next((r for r in _RARE if any(r in w for w in words)), max(words, key=len))


TRIGGERS = "|".join(sorted({trigger(t) for texts in SENTENCES.values() for t in texts}))


class Recogniser:
    """Known sentences by their first two words, and the rules by their first identifier."""

    def __init__(self, sentences: dict[str, list[str]] | None = None, rules: list[tuple[str, list[str]]] | None = None, gap: int = GAP_UNITS):
        self.gap = gap
        self.by_start: dict[tuple[str, ...], list[tuple[tuple[str, ...], str]]] = {}
        for name, texts in (SENTENCES if sentences is None else sentences).items():
            for words in map(normal_words, texts):
                self.by_start.setdefault(words[:2], []).append((words, name))
        for known in self.by_start.values():
            known.sort(key=lambda k: -len(k[0]))
        self.rules = RULES if rules is None else rules

    def sentences(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(identifier, begin, end, first unit, last unit) of the known sentences in a text, in order."""
        words, begins, ends, unit_of, unit_first = [], [], [], [], []
        unit = 0
        for m in _UNIT.finditer(text):
            found = list(_WORD.finditer(text, m.start(), m.end()))
            if not found:
                continue
            unit_first.append(len(words))
            for w in found:
                words.append(w.group().lower())
                begins.append(w.start())
                ends.append(w.end())
                unit_of.append(unit)
            unit += 1
        closing = {b - 1 for b in unit_first[1:]} | {len(words) - 1}
        out, done = [], 0
        for first in unit_first:
            if first < done:
                continue
            if words[first] == "copyright" and ("copyright",) not in self.by_start:
                last = first + 1
                while last < len(words) and unit_of[last] == unit_of[first]:
                    last += 1
                reserved = self._known(words, first, closing)
                # the sentence may run on over the line's end
                last = max(last, first + len(reserved[0])) if reserved else last
                ends_so = words[max(first, last - 3) : last] == ["all", "rights", "reserved"]
                name = reserved[1] if reserved else "rights-reserved" if ends_so else "copyright"
                out.append((name, begins[first], ends[last - 1], unit_of[first], unit_of[last - 1]))
                done = last
            elif known := self._known(words, first, closing):
                last = first + len(known[0]) - 1
                out.append((known[1], begins[first], ends[last], unit_of[first], unit_of[last]))
                done = last + 1
        return out

    def _known(self, words: list[str], first: int, closing: set[int]) -> tuple[tuple[str, ...], str] | None:
        for known in self.by_start.get(tuple(words[first : first + 2]), []):
            stop = first + len(known[0])
            if stop - 1 in closing and tuple(words[first:stop]) == known[0]:
                return known
        return None

    def licences(self, text: str) -> list[tuple[str, list[str], int, int]]:
        """(licence, identifiers of its rule, begin, end), in the order of their places."""
        known = self.sentences(text)
        found = [s for s in known if s[0] != "copyright"]
        between = [s for s in known if s[0] == "copyright"]
        taken, out = [False] * len(found), []
        for licence, names in self.rules:
            for i in range(len(found) - len(names) + 1):
                run = found[i : i + len(names)]
                if any(taken[i : i + len(names)]) or [s[0] for s in run] != names:
                    continue
                if all(self._distance(a, b, between) <= self.gap for a, b in zip(run, run[1:])):
                    taken[i : i + len(names)] = [True] * len(names)
                    out.append((licence, names, run[0][1], run[-1][2]))
        return sorted(out, key=lambda x: (x[2], x[3]))

    @staticmethod
    def _distance(a: tuple, b: tuple, between: list[tuple]) -> int:
        return b[3] - a[4] - 1 - sum(a[4] < c[3] < b[3] for c in between)


def scan_licences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gap: int = GAP_UNITS) -> DataFrame:
    """One row per licence and place: doc_id, licence, sentences (identifiers), begin, end (places in the text)."""
    docs = texts_of(df, id_col, text_col).filter(F.lower("text").rlike(TRIGGERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recogniser = Recogniser(gap=gap)
        for batch in batches:
            rows = [(i, *hit) for i, text in enumerate(batch.column(1).to_pylist()) for hit in recogniser.licences(text)]
            at, licence, names, begin, end = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.array(at, np.int64))), pa.array(licence, pa.string()),
                    pa.array(names, pa.list_(pa.string())), pa.array(begin, pa.int32()), pa.array(end, pa.int32()),
                ],
                ["doc_id", "licence", "sentences", "begin", "end"],
            )

    id_type = df.schema[id_col].dataType.simpleString()
    return map_batches(docs, run, f"doc_id {id_type}, licence string, sentences array<string>, begin int, end int")
