import random
import re

import numpy as np
import pyarrow as pa
import pytest
from edge_cases import TEXTS, documents, nothing

from briefwright.llm import ngramjoin
from briefwright.llm.common import byte_view
from briefwright.llm.components import block_pairs, components, least_labels

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def tokens(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(text or "")]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [tokens(t) for _, t in rows]
    linked = [[j for j in range(len(rows)) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(rows))]
    label = [i for i, _ in rows]
    while True:
        before = label[:]
        for i, other in enumerate(linked):
            label[i] = min([label[i], *(label[j] for j in other)])
        if label == before:
            return [(i, c, len(other)) for (i, _), c, other in zip(rows, label, linked, strict=True)]


def text_rows(rng):
    words = ["w%d" % i for i in range(400)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    common = text(60)
    rows = [" ".join(text(rng.randrange(1, 90))) for _ in range(150)]
    rows += [" ".join(common + text(rng.randrange(20, 60))) for _ in range(120)]  # one passage in many texts
    base = text(150)
    for _ in range(90):  # a large group of near copies
        copy = base[:]
        for _ in range(rng.randrange(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append(" ".join(copy))
    for i in range(40):
        copy = rows[i].split()
        if copy and rng.random() < 0.7:
            copy[rng.randrange(len(copy))] = "changed"
        rows.append((", " if i % 2 else " ").join(copy).upper())
    return list(enumerate(rows + [rows[0]] * 30))


@pytest.mark.parametrize(("bucket", "block"), [(1024, 400_000), (4, 3000)])
def test_same_as_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(ngramjoin, "BUCKET", bucket)
    monkeypatch.setattr(ngramjoin, "IN_TASK", 4 * bucket)
    monkeypatch.setattr(ngramjoin, "BLOCK", block)
    rows = text_rows(random.Random(bucket))
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngramjoin.similar(documents(spark, rows)).collect())
    want = brute(rows)
    assert sum(a == b for a, b in zip(got, want, strict=True)) >= 0.99 * len(rows)
    assert sum(n for _, _, n in got) >= 0.99 * sum(n for _, _, n in want)


def test_edge_cases(spark):
    rows = sorted([(r.doc_id or 0, r.class_id or 0, r.n_links) for r in ngramjoin.similar(documents(spark)).collect()])
    assert rows == sorted([(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, 5, 0), (6, 6, 0), (7, 7, 0), (8, 8, 1), (8, 8, 1), (9, 9, 0), (0, 0, 0), (0, 0, 0)])
    assert ngramjoin.similar(nothing(spark)).collect() == []
    kept = ngramjoin.distinct(documents(spark))
    assert kept.columns == documents(spark).columns and kept.count() == len(TEXTS) - 1
    assert ngramjoin.distinct(nothing(spark)).collect() == []


def test_shingles_depend_on_words_only():
    texts = ["One, two three!  Four five six", "one two THREE four (five) six", "one two", "", "é è", "one two three four six five"]
    values, offsets, count, order = ngramjoin.shingles(*byte_view(pa.array(texts)))
    own = [set(values[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert own[0] == own[1] and order[0] == order[1] and not own[0] & own[5] and order[0] != order[5]
    assert [len(x) for x in own] == [2, 2, 1, 0, 1, 2] and count.tolist() == [6, 6, 2, 0, 2, 6]


def test_chance_to_miss_falls_with_similarity_and_grows_with_depth():
    assert ngramjoin.miss(0, 0.8) == pytest.approx(0.04) and ngramjoin.miss(4, 0.8) > ngramjoin.miss(1, 0.8) > ngramjoin.miss(1, 0.95)


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 200)], [(i, 1000 - i) for i in range(300)], [(5, 5)], [],
                                   [(random.Random(8).randrange(300), j) for j in range(250)]])
def test_components(spark, edges):
    got = {r.v: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    some = sorted({v for a, b in edges if a != b for v in (a, b)})
    at = {v: i for i, v in enumerate(some)}
    label = least_labels(len(some), np.array([at[a] for a, b in edges if a != b], int), np.array([at[b] for a, b in edges if a != b], int))
    assert got == {v: some[label[i]] for v, i in at.items()}


def test_block_pairs_hold_each_pair_once(spark):
    members = spark.createDataFrame([(1, i, 10) for i in range(40)] + [(2, 100, 1)], "g int, c long, w int")
    seen = {}
    for r in block_pairs(members, "g", "c", "w", 100).collect():
        seen.setdefault((r.g, r.x, r.y), []).append((r.c, r.side))
    pairs = [(min(a, b), max(a, b)) for (g, x, y), own in seen.items() if g == 1 for n, (a, s) in enumerate(own) for b, t in own[n + 1 :] if x == y or s != t]
    assert sorted(pairs) == [(a, b) for a in range(40) for b in range(a + 1, 40)]
    assert max(map(len, seen.values())) < 40
