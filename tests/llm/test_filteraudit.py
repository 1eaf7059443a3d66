import itertools
import random
import re

import numpy as np
from edge_cases import TEXTS

from briefwright.llm import filteraudit
from briefwright.llm.filteraudit import audit, merged, shared

SCHEMA = "doc_id long, text string, source string, id string, `a.b` string, fails string, _hot string, least string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "x", "x", "x", "x", "x") for i, t, s in rows], SCHEMA)


def marks(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def fails(text, smaller):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, hit in zip("ABCDE", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search(r"[#$%&*|]", text)), smaller), strict=True) if hit}


def brute(rows, labels):
    rows = [(i, t or "", s or "") for i, t, s in rows]
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t] = min(least.get(t, i), i)
    good, toxic = ({i for i, *m in labels if m[k] == 1 and i is not None} for k in (0, 1))
    judged = [(s, i, fails(t, i is not None and t in least and i > least[t])) for i, t, s in rows]
    out = {}
    for part in {s for s, *_ in judged}:
        mine = [(i, f) for s, i, f in judged if s == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left, gone = mine, []
            for step, f in enumerate(order, 1):
                out_now, stay = [x for x in left if f in x[1]], [x for x in left if f not in x[1]]
                total[f] += len(out_now)
                out[part, "".join(order), step] = [len(stay), len(out_now), sum(f in x[1] for x in gone), sum(x[1] == {f} for x in mine), sum(x[0] in good for x in out_now), sum(x[0] in toxic for x in out_now)]
                left, gone = stay, gone + out_now
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def got(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


def sample(n=300):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        words = [rng.choice(["word", "Über", "日本", "x#y", "LOUD", "plain"]) + (str(rng.randrange(400)) if i % 3 else "") for _ in range(rng.choice([3, 150, 199, 200, 260]))]
        rows.append((i, rng.choice([" ", "\t", "\n "]).join(words), rng.choice(["hot", "hot", "b", None, ""])))
    rows += [(n + k, rows[rng.randrange(n)][1], rng.choice(["hot", "b"])) for k in range(60)]
    rng.shuffle(rows)
    return rows


def test_same_as_brute_force(spark, monkeypatch):
    rows = sample()
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 360, 3)] + [(1, None, 1), (2, 1, None), (None, 1, 1), (6, 1, 0), (6, 0, 1)]
    want = brute(rows, labels)
    for heavy, records in ((20_000, "10000"), (3, "7")):  # ranges of a few rows, groups of copies not broadcast
        monkeypatch.setattr(filteraudit, "HEAVY", heavy)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
        try:
            assert got(audit(frame(spark, rows), marks(spark, labels))) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_edge_cases(spark):
    rows = [(i, t, s) for (i, t), s in zip(TEXTS, itertools.cycle(["a", None, ""]))] + [(20, "same " * 300, "a"), (20, "same " * 300, "a"), (None, "same " * 300, "a"), (21, "same " * 300, "c")]
    labels = [(20, 1, 1), (20, 1, 0), (None, 1, 1), (8, 0, 1)]
    want = brute(rows, labels)
    assert got(audit(frame(spark, rows), marks(spark, labels))) == want
    assert got(audit(frame(spark, rows), marks(spark, []))) == {k: (*v[:4], 0, 0, v[6]) for k, v in want.items()}
    assert got(audit(frame(spark, []), marks(spark, labels))) == {}


def test_galloping_merges():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 30))).astype(np.int32) for _ in range(2))
        assert merged(a, b).tolist() == sorted({*a.tolist(), *b.tolist()})
        assert shared(a, b) == len({*a.tolist()} & {*b.tolist()})


def test_posting_lists_hold_the_failing_documents(spark):
    rows = [(i, "few words" if i % 2 else " ".join(f"w{k}" for k in range(250)), "s") for i in range(20, 0, -1)]
    found = filteraudit.postings(filteraudit.judged(frame(spark, rows), marks(spark, [(3, 1, 0)]), "doc_id", "text", "source")).collect()
    assert sum(r.docs for r in found) == 20 and sum(len(r.fails[0]) for r in found) == 10
    assert all(x == sorted(x) for r in found for x in r.fails)
    ids = [list(range(r.first_id, r.last_id + 1)) for r in found]
    assert sorted(ids[k][place] for k, r in enumerate(found) for place in r.fails[0]) == list(range(1, 21, 2))
    assert [ids[k][place] for k, r in enumerate(found) for place in r.good] == [3]
