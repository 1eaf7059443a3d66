"""Operator 8: licence scans by patience alignment.

Where a stretch of a text holds enough of a template's words, the two are aligned: equal beginnings and ends are taken off, words that
occur once on both sides are anchors, the longest increasing run of anchors (found by dealing them on piles) is kept, and the gaps
between them are aligned in the same way. A template is found where its aligned words are at least ``COVERAGE`` of it.

Words of a template in braces tell it from its neighbours (name, version, a clause of its own): they must be aligned, and a match holds
no word of ``APART`` that its template lacks. Statements that name a licence ("released under ...", SPDX lines) are read by rule: a verb,
"under", and a name with its version and its further parts, so that neighbours get their own names and unknown names none.

A stretch has ``SPREAD`` times the template's words, so a match may hold that many words in all. Stretches are tried from left to right;
the next one begins after a match. Words are runs of ASCII letters, digits and characters outside ASCII, in lower case.

Cases: null texts count as empty; texts without words have no licence; a licence that is repeated is found each time; of
matches that overlap the one with the most aligned words is kept; repeated rows are each answered; long texts are whole; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from briefwright.llm.common import column, span_hashes, steps, word_spans
from briefwright.llm.ngramjoin import _LOWER, _WORD

COVERAGE, SPREAD = 0.8, 1.5

#: Fixed texts: whole short licences, the notices of long ones, and grants as they stand alone (excerpt: not the whole licence);
#: telling words in braces. The long licences themselves are not held; ``scan`` takes other templates.
TEMPLATES = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
        "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject
        to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
        TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF
        OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
        the above copyright notice and this permission notice appear in all {copies}. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS
        ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
        AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA
        OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
    "0bsd-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
        DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
        ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-2-clause-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
        are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT
        HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
        FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
        SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
        WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
        EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "bsd-3-clause-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
        are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor
        the names of its contributors may be used to {endorse} or promote products derived from this software without specific prior written
        permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
        EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
        DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
        OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "bsd-4-clause-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
        are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution. 3. All advertising materials mentioning features
        or use of this software must display the following {acknowledgement}: This product includes software developed by the organization. 4.
        Neither the name of the copyright holder nor the names of its contributors may be used to {endorse} or promote products derived from
        this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
        AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
        LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
        LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE.""",
    "zlib-text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
        arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must
        not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an
        acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked
        as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source
        distribution.""",
    "unlicense-text": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
        distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
        means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest
        in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs
        and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this
        software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "apache-2.0-notice": """Licensed under the {Apache} License, Version {2.0} (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "gpl-2.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published
        by the Free Software Foundation, either version {2} of the License, or (at your option) any later version.""",
    "gpl-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published
        by the Free Software Foundation, either version {3} of the License, or (at your option) any later version.""",
    "lgpl-2.0-notice": """This library is free software: you can redistribute it and/or modify it under the terms of the GNU {Library} General Public License as
        published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version.""",
    "lgpl-2.1-notice": """This library is free software: you can redistribute it and/or modify it under the terms of the GNU {Lesser} General Public License as
        published by the Free Software Foundation, either version {2.1} of the License, or (at your option) any later version.""",
    "lgpl-3.0-notice": """This library is free software: you can redistribute it and/or modify it under the terms of the GNU {Lesser} General Public License as
        published by the Free Software Foundation, either version {3} of the License, or (at your option) any later version.""",
    "agpl-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {Affero} General Public License as
        published by the Free Software Foundation, either version {3} of the License, or (at your option) any later version.""",
    "mpl-2.0-notice": """This Source Code Form is subject to the terms of the {Mozilla} Public License, v. {2.0}. If a copy of the MPL was not distributed with
        this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "cc0-1.0-notice": """To the extent possible under law, the author has {waived} all copyright and related or neighboring rights to this work.""",
    "mit-excerpt": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "isc-excerpt": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
        above copyright notice and this permission notice appear in all copies.""",
    "bsd-excerpt": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are
        met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.""",
    "apache-2.0-excerpt": """Licensed under the {Apache} License, Version {2.0} (the "License"); you may not use this file except in compliance with the License. You may
        obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""",
}

#: Words that make another licence of a text.
APART = ["lesser", "affero", "noncommercial", "sharealike", "noderivatives"]

_LICENCE = rb"(?:(?:\s+|-)(?:public\s+)?licen[sc]e)?"
#: A version with its dots, and "or later"; neither is taken from the next sentence.
_VERSION = rb"(?:(?:[\s,\"'(-]*version\s+|[ \t,\"'(-]*(?:v\.?\s?)?)(?P<v>[0-9]{1,2}(?:\.[0-9]{1,2})?)(?![0-9a-z]))?"
_LATER = rb"(?P<later>\+|,?(?:\s+|-)or(?:\s+|-)(?:\(at\s+your\s+option\)\s+)?(?:any\s+)?(?:later|newer)(?:\s+version)?)?"
_COMMONS = rb"(?P<nc>[\s-]+(?:nc|non-?commercial)(?![a-z]))?(?P<sa>[\s-]+(?:sa|share-?alike)(?![a-z]))?(?P<nd>[\s-]+(?:nd|no-?deriv(?:ative)?s)(?![a-z]))?"
_PORT = rb"(?:\s+(?:international|unported|generic|universal))?"
#: How licences are named, and what they are called; the first that fits counts.
NAMES = [(name, re.compile(pattern + rb"(?![0-9a-z])")) for name, pattern in [
    ("mit", rb"(?:mit|expat)(?!-0|\s+press)" + _LICENCE), ("isc", rb"isc" + _LICENCE), ("zlib", rb"zlib" + _LICENCE), ("unlicense", rb"unlicense"),
    ("0bsd", rb"(?:0bsd|(?:0|zero)[\s-]clause\s+bsd|bsd[\s-](?:0|zero)[\s-]clause)" + _LICENCE),
    ("bsd-2-clause", rb"(?:(?:(?:2|two)[\s-]clause|simplified)\s+bsd|bsd[\s-](?:2|two)[\s-]clause)" + _LICENCE),
    ("bsd-3-clause", rb"(?:(?:(?:3|three)[\s-]clause|new|modified|revised)\s+bsd|bsd[\s-](?:3|three)[\s-]clause)" + _LICENCE),
    ("bsd-4-clause", rb"(?:(?:(?:4|four)[\s-]clause|original)\s+bsd|bsd[\s-](?:4|four)[\s-]clause)" + _LICENCE),
    ("bsd", rb"bsd" + _LICENCE), ("apache", rb"apache(?:\s+software)?(?=[\s-]+(?:licen[sc]e|v|[0-9]))" + _LICENCE + _VERSION + _LICENCE),
    ("agpl", rb"(?:(?:gnu\s+)?affero\s+general\s+public\s+licen[sc]e|(?:gnu\s+)?agpl)" + _VERSION + _LATER),
    ("lgpl", rb"(?:(?:gnu\s+)?(?:lesser|library)\s+general\s+public\s+licen[sc]e|(?:gnu\s+)?lgpl)" + _VERSION + _LATER),
    ("gpl", rb"(?:(?:gnu\s+)?general\s+public\s+licen[sc]e|(?:gnu\s+)?gpl)" + _VERSION + _LATER),
    ("mpl", rb"(?:mozilla\s+public\s+licen[sc]e|mpl)" + _VERSION), ("epl", rb"(?:eclipse\s+public\s+licen[sc]e|epl)" + _VERSION),
    ("bsl", rb"(?:boost\s+software\s+licen[sc]e|bsl)" + _VERSION),
    ("cc0", rb"(?:creative\s+commons\s+(?:zero|cc0)|cc0|cc\s+zero)" + _VERSION + _PORT + _LICENCE),
    ("cc-by", rb"(?:creative\s+commons\s+attribution|cc[\s-]by)" + _COMMONS + rb"(?:\s+licen[sc]e)?" + _VERSION + _PORT + _LICENCE),
]]
_MORE = re.compile(rb"\s*(?:/|\b(?:or|and)\b)\s*(?:under\s+)?(?:the\s+)?")
_VERB = re.compile(rb"(?:\bthis\s+[a-z]+\s+is\s+)?(?:\b(?:dual|also)[\s-]+)?\b(?:licen[sc]ed|released|distributed|published|available|provided|covered|issued|shared)\s+\Z")
_CUE = re.compile(rb"\bunder\s+(?:the\s+(?:terms|conditions)\s+of\s+)?(?:(?:the|an?)\s+)?|spdx-license-identifier:\s*")


def named(low: bytes, a: int, b: int) -> list[tuple[str, int, int]]:
    """Names of licences in the statements of low[a:b], in lower case, with first byte and byte after the last."""
    out = []
    for cue in _CUE.finditer(low, a, b):
        s = cue.start()
        if low.startswith(b"under", s):
            verb = _VERB.search(low[max(a, s - 80):s])
            if not verb:
                continue
            s -= len(verb[0])
        at = cue.end()
        while at is not None:  # a statement may name several
            fits = ((name, m) for name, pattern in NAMES if (m := pattern.match(low, at, b)))
            name, m = next(fits, (None, None))
            at = None
            if m:
                parts = m.groupdict()
                version = (parts.get("v") or b"").decode()
                extra = [x for x in ("nc", "sa", "nd") if parts.get(x)]
                later = ["or-later"] if parts.get("later") else []
                out.append(("-".join([name, *extra, *([version if "." in version else f"{version}.0"] if version else []), *later, "named"]), s, m.end()))
                more = _MORE.match(low, m.end(), b)
                s = at = more.end() if more else None
    return out


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of two word lists, in order."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if once_b[w] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if once_a[w] == 1 and w in place]
        last_i, last_j = a0, b0
        for i, j in [*_increasing(anchors), (a1, b1)]:
            if anchors:
                work.append((last_i, i, last_j, j))
            if i < a1 or j < b1:
                out.append((i, j))
            last_i, last_j = i + 1, j + 1
    return sorted(out)


def _increasing(anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of anchors, in order of the first side, that also increases on the second."""
    tops: list[int] = []
    on_top: list[int] = []
    below: list[int] = []
    for k, (_, j) in enumerate(anchors):
        pile = bisect_left(tops, j)
        if pile == len(tops):
            tops.append(j)
            on_top.append(k)
        else:
            tops[pile], on_top[pile] = j, k
        below.append(on_top[pile - 1] if pile else -1)
    run, k = [], on_top[-1] if on_top else -1
    while k >= 0:
        run.append(anchors[k])
        k = below[k]
    return run[::-1]


def _words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, and offsets of each text's."""
    starts, ends = word_spans(_WORD[raw], at)
    return span_hashes(_LOWER[raw], starts, ends), np.searchsorted(starts, at)


@lru_cache(maxsize=4)
def _prepared(templates: tuple) -> tuple[np.ndarray, list[tuple[str, list[int], np.ndarray, set[int], set[int]]]]:
    """The words of all templates, and of each one its words by number, which numbers it has, places of telling words, numbers it forbids."""
    texts = [t.encode() for _, t in templates] + [" ".join(APART).encode()]
    raw, at = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    words, offsets = _words(raw, at)
    starts, _ = word_spans(_WORD[raw], at)
    inside = np.cumsum(raw == ord("{")) > np.cumsum(raw == ord("}"))
    known, number = np.unique(words, return_inverse=True)
    apart = set(number[offsets[-2]:].tolist())
    out = []
    for (name, _), a, b in zip(templates, offsets[:-2].tolist(), offsets[1:-1].tolist(), strict=True):
        own = number[a:b]
        out.append((name, own.tolist(), np.isin(np.arange(len(known) + 1), own), set(np.flatnonzero(inside[starts[a:b]]).tolist()), apart - set(own.tolist())))
    return known, out


def found(raw: np.ndarray, at: np.ndarray, templates: tuple, coverage: float = COVERAGE, spread: float = SPREAD) -> list[list[dict]]:
    """Of each text, the licences in it: name, first word, word after the last, and coverage."""
    known, prepared = _prepared(templates)
    low = _LOWER[raw]
    starts, ends = word_spans(_WORD[raw], at)
    words, offsets = span_hashes(low, starts, ends), np.searchsorted(starts, at)
    place = np.minimum(np.searchsorted(known, words), max(0, len(known) - 1))
    number = np.where(known[place] == words, place, len(known)) if len(known) else np.zeros(len(words), np.int64)
    out: list[list[tuple[int, dict]]] = [[] for _ in range(len(at) - 1)]
    for name, template, has, telling, apart in prepared:
        if not template:
            continue
        member = has[number]
        total = np.concatenate([[0], np.cumsum(member)])
        stretch = max(len(template), int(spread * len(template)))
        # a match begins with a word of the template, before which no more than may be lacking is left out
        begins = np.flatnonzero(np.isin(number, template[: int((1 - coverage) * len(template)) + 1]))
        row = np.searchsorted(offsets, begins, "right") - 1
        until = np.minimum(begins + stretch, offsets[row + 1])
        need = coverage * len(template)
        enough = total[until] - total[begins] >= need
        free = 0
        for i, end, r in zip(begins[enough].tolist(), until[enough].tolist(), row[enough].tolist(), strict=True):
            if i < free:
                continue
            pairs = align(number[i:end].tolist(), template)
            if len(pairs) >= need and pairs[0][0] == 0 and telling <= {j for _, j in pairs} and apart.isdisjoint(number[i:i + pairs[-1][0] + 1].tolist()):
                free = i + pairs[-1][0] + 1
                out[r].append((len(pairs), {"licence": name, "first": i - int(offsets[r]), "end": free - int(offsets[r]), "coverage": len(pairs) / len(template)}))
    text, cuts = low.tobytes(), at.tolist()
    for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        for name, s, e in named(text, a, b):
            first, end = int(np.searchsorted(starts, s)), int(np.searchsorted(starts, e))
            out[r].append((end - first, {"licence": name, "first": first - int(offsets[r]), "end": end - int(offsets[r]), "coverage": 1.0}))
    return [_apart(x) for x in out]


def _apart(matches: list[tuple[int, dict]]) -> list[dict]:
    """The matches with the most aligned words, then the highest coverage, that do not overlap; in order."""
    kept: list[dict] = []
    firsts: list[int] = []
    for _, m in sorted(matches, key=lambda x: (-x[0], -x[1]["coverage"], x[1]["first"], x[1]["licence"])):
        at = bisect_left(firsts, m["first"])  # those kept are apart, so only the neighbours can meet it
        if (at == len(kept) or m["end"] <= kept[at]["first"]) and (at == 0 or kept[at - 1]["end"] <= m["first"]):
            firsts.insert(at, m["first"])
            kept.insert(at, m)
    return kept


def scan(df: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """Per row: id, and licences: array<struct<licence, first, end, coverage>> by words of the text."""
    wanted = tuple(sorted((templates or TEMPLATES).items()))
    kind = pa.list_(pa.struct([("licence", pa.string()), ("first", pa.int32()), ("end", pa.int32()), ("coverage", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, at in steps(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(found(raw, at, wanted, coverage), kind)], names=["id", "licences"])

    id_kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(column(id_col).alias("id"), column(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {id_kind}, licences array<struct<licence:string,first:int,end:int,coverage:double>>").withColumnRenamed("id", id_col)
