import random

from edge_cases import TEXTS, documents, nothing

from briefwright.llm import licences


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_a_common_subsequence_and_full_where_words_are_unique():
    rng = random.Random(9)
    for _ in range(300):
        a, b = [rng.randrange(12) for _ in range(rng.randrange(0, 25))], [rng.randrange(12) for _ in range(rng.randrange(0, 25))]
        pairs = licences.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and len(pairs) <= longest_common(a, b)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        a, b = rng.sample(range(40), 15), rng.sample(range(40), 15)
        assert len(licences.align(a, b)) == longest_common(a, b)


def test_longest_increasing_run():
    rng = random.Random(10)
    for _ in range(200):
        js = rng.sample(range(50), rng.randrange(0, 12))
        best = max((bin(m).count("1") for m in range(1 << len(js)) if (s := [j for k, j in enumerate(js) if m >> k & 1]) == sorted(s)), default=0)
        assert len(licences._increasing(list(enumerate(js)))) == best


def names(row):
    return [x.licence for x in row.licences]


def test_templates_are_found_whole_edited_and_repeated(spark):
    rng = random.Random(11)
    filler = lambda n: " ".join(rng.choice(["thend", "ouring", "er", "the", "is", "of"]) for _ in range(n))
    docs, want = [], {}
    for k, (name, text) in enumerate(licences.TEMPLATES.items()):
        docs.append((k, f"{filler(30)} {text.upper()} {filler(500)}"))
        words = text.split()
        if len(words) > 15:  # one word in twelve changed, one put in
            docs.append((100 + k, filler(9) + " " + " ".join("X" if i % 12 == 5 else w + (" extra" if i % 20 == 7 else "") for i, w in enumerate(words)) + " " + filler(9)))
        docs.append((200 + k, f"{text}\n{filler(40)}\n{text}"))
        docs.append((300 + k, filler(20) + " " + " ".join(words[: len(words) // 3]) + " " + filler(60)))
        want[k] = name
    rows = {r.doc_id: r for r in licences.scan(documents(spark, docs)).collect()}
    for k, name in want.items():
        assert name in names(rows[k]) and names(rows[200 + k]).count(name) == 2 and name not in names(rows[300 + k])
        assert 100 + k not in rows or name in names(rows[100 + k])
        one = next(x for x in rows[k].licences if x.licence == name)
        assert one.coverage == 1.0 and one.first == 30


NEAR = {
    "Released under the MIT License.": "mit", "Released under the BSD License.": "bsd", "released under the BSD 2-Clause License": "bsd-2-clause", "Licensed under the 3-clause BSD license.": "bsd-3-clause",
    "Released under the Foo License.": None, "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0", "Licensed under CC BY 4.0.": "cc-by-4.0", "Licensed under CC BY-SA 4.0.": "cc-by-sa-4.0",
    "Licensed under CC BY 3.0.": "cc-by-3.0", "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa-4.0", "Licensed under CC BY-ND 4.0.": "cc-by-nd-4.0", "Released under CC0 1.0 Universal.": "cc0-1.0",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "cc-by-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "cc-by-nc-sa-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "This work is licensed under the GNU General Public License, version 2.": "gpl-2.0",
    "licensed under the GNU Lesser General Public License v2.1 or later": "lgpl-2.1-or-later", "Distributed under the GNU Affero General Public License, version 3.": "agpl-3.0", "released under GPLv2": "gpl-2.0",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Licensed under the Apache License, Version 1.1.": "apache-1.1", "Licensed under the Mozilla Public License 2.0": "mpl-2.0",
    "released under the Unlicense": "unlicense", "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0-or-later", "Licensed under the GPL. 4 items": "gpl", "Buried under the MIT License": None,
    "Published under MIT Press": None, "Licensed under the Apache License\n2 files": "apache", "Licensed under a Creative Commons Attribution License 3.0": "cc-by-3.0",
}


def test_neighbouring_names_are_told_apart(spark):
    rows = {r.doc_id: r for r in licences.scan(documents(spark, [(k, f"the is {t}\n4 words after") for k, t in enumerate(NEAR)])).collect()}
    for k, (text, name) in enumerate(NEAR.items()):
        assert names(rows[k]) == ([f"{name}-named"] if name else []), text
        assert not name or (rows[k].licences[0].first, rows[k].licences[0].coverage) == (2, 1.0)


def test_a_statement_may_name_several(spark):
    row = licences.scan(documents(spark, [(1, "Licensed under the MIT license or the Apache License, Version 2.0, as you like")])).first()
    assert names(row) == ["mit-named", "apache-2.0-named"]


def test_neighbouring_notices_are_told_apart(spark):
    gpl, apache = licences.TEMPLATES["gpl-3.0-notice"], licences.TEMPLATES["apache-2.0-notice"]
    docs = [(0, gpl), (1, gpl.replace("3", "2")), (2, gpl.replace("General", "Lesser General")), (3, gpl.replace("General", "Affero General")), (4, apache), (5, apache.replace("2.0", "1.1"))]
    rows = {r.doc_id: names(r) for r in licences.scan(documents(spark, docs)).collect()}
    assert rows[0] == ["gpl-3.0-notice"] and rows[4] == ["apache-2.0-notice"]
    assert not any("gpl-3.0-notice" in rows[k] for k in (1, 2, 3)) and "apache-2.0-notice" not in rows[5]


def test_whole_texts_are_told_apart_and_excerpts_are_not_whole(spark):
    rng = random.Random(13)
    filler = " ".join(rng.choice(["the", "er", "is", "of", "ing"]) for _ in range(40))
    docs = [(k, f"{filler} {text} {filler}") for k, text in enumerate(licences.TEMPLATES.values())]
    short = licences.TEMPLATES["mit-text"].split(" THE SOFTWARE IS")[0]
    rows = {r.doc_id: r for r in licences.scan(documents(spark, [*docs, (99, short)])).collect()}
    for k, name in enumerate(licences.TEMPLATES):
        assert [(x.licence, x.first, x.coverage) for x in rows[k].licences] == [(name, 40, 1.0)], name
    assert names(rows[99]) == ["mit-excerpt"]
    assert {"bsd-3-clause-text", "lgpl-2.1-notice", "agpl-3.0-notice", "mpl-2.0-notice", "unlicense-text", "cc0-1.0-notice"} <= set(licences.TEMPLATES)


def test_edge_cases(spark):
    rows = licences.scan(documents(spark)).collect()
    assert len(rows) == len(TEXTS) and not any(r.licences for r in rows)
    assert licences.scan(nothing(spark)).collect() == []
    assert names(licences.scan(documents(spark, [(1, "one"), (2, None)]), {"one": "one", "none": ""}).where("doc_id = 1").first()) == ["one"]


def test_many_matches_and_near_misses_in_one_text():
    import time

    import numpy as np

    def found(text, templates=None):
        raw = np.frombuffer(text.encode(), np.uint8)
        start = time.time()
        out = licences.found(raw, np.array([0, len(raw)]), tuple(sorted((templates or licences.TEMPLATES).items())))[0]
        return out, time.time() - start

    took = []
    for n in (4_000, 32_000):
        out, seconds = found("x released under the MIT License. y " * n)
        assert len(out) == n and [m["first"] for m in out] == [1 + 7 * k for k in range(n)]
        took.append(seconds)
    assert took[1] < 20 * took[0] + 1
    near = " ".join(w if i % 3 else "not" for i, w in enumerate(licences.TEMPLATES["bsd-3-clause-text"].split()))
    out, seconds = found((near + " ") * 40)
    assert not out and seconds < 20


def test_whole_long_licences_from_a_table():
    import os

    import numpy as np
    import pytest

    folder = "/usr/share/common-licenses"
    known = {n: open(f"{folder}/{n}").read() for n in ("Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "MPL-2.0") if os.path.exists(f"{folder}/{n}")}
    if len(known) < 2:
        pytest.skip("the texts are not here")
    templates = tuple(sorted(known.items()))
    for name, text in known.items():
        words = text.split()
        edited = " ".join("X" if i % 15 == 4 else w for i, w in enumerate(words))
        for body in (text, "some words before " + edited + " and after"):
            raw = np.frombuffer(body.encode(), np.uint8)
            out = licences.found(raw, np.array([0, len(raw)]), templates)[0]
            assert [m["licence"] for m in out] == [name] and out[0]["coverage"] >= 0.85


def test_overlapping_matches():
    rng = random.Random(4)
    for _ in range(300):
        some = [(rng.randrange(9), {"licence": "x", "first": (s := rng.randrange(50)), "end": s + rng.randrange(1, 9), "coverage": rng.choice([0.8, 1.0])}) for _ in range(rng.randrange(12))]
        kept = []
        for _, m in sorted(some, key=lambda x: (-x[0], -x[1]["coverage"], x[1]["first"], x[1]["licence"])):
            if all(m["end"] <= k["first"] or k["end"] <= m["first"] for k in kept):
                kept.append(m)
        assert licences._apart(some) == sorted(kept, key=lambda m: m["first"])
