import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from briefwright.llm import hardnegatives
from briefwright.llm.hardnegatives import mine, scores

SCHEMA = "vec_id long, embedding array<double>, label int, id string, anchor string, windows string, `a.b` string, _id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y, "x", "x", "x", "x", "x") for i, y, v in rows], SCHEMA)


def brute(rows, every, positives=5, negatives=3, low=50, high=95):
    usable = {}
    for i, y, v in rows:
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = min(usable.get(i, (y, tuple(map(float, v)))), (y, tuple(map(float, v))))
    usable = {i: (y, [math.floor(256 * x) for x in v]) for i, (y, v) in usable.items()}
    out = []
    for a, (label, v) in usable.items():
        if a % every:
            continue
        ranked = sorted((-max(-(2**63), min(2**63 - 1, sum(p * q for p, q in zip(v, w, strict=True)))), i, y) for i, (y, w) in usable.items() if i != a and len(w) == len(v))
        for s, i, _ in [r for r in ranked if r[2] == label][:positives]:
            inside = [(n, j) for n, j, y in ranked if y != label and low * -s <= 100 * -n <= high * -s][:negatives]
            out += [(a, i, k, j, -s, -n) for k, (n, j) in enumerate(inside, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def sample(n, dim, spread, labels, seed=2):
    rng = np.random.default_rng(seed)
    y = np.minimum(rng.integers(0, labels + 2, n), labels)  # one label holds a third and more
    return [(i, int(y[i]), np.round(v, 2).tolist()) for i, v in enumerate(rng.normal(size=(n, dim)) * spread + rng.normal(size=(labels + 1, dim))[y])]


@pytest.mark.parametrize("blocks", [(8192, 8192), (37, 11)])
def test_same_as_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(hardnegatives, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(hardnegatives, "ANCHOR_BLOCK", blocks[1])
    monkeypatch.setattr(hardnegatives, "STEP", 8)
    rows = sample(300, 6, 0.7, 4)
    assert got(mine(frame(spark, rows), F.col("vec_id") % 5 == 0)) == brute(rows, 5) != []


def test_ties_and_other_numbers(spark):
    rows = [(i, i % 3, [i * 7 % 20, 1, i % 2]) for i in range(60)]
    for options in ({}, {"positives": 2, "negatives": 7, "low": 20, "high": 100}):
        assert got(mine(frame(spark, rows), F.col("vec_id") % 4 == 0, **options)) == brute(rows, 4, **options) != []


def test_edge_cases(spark):
    rows = [(0, 1, [1, 2]), (1, 1, [2, 2]), (2, 2, [1, 1]), (3, None, [1, 1]), (4, 2, None), (5, 2, [1, None]), (6, 2, [math.nan, 1]), (7, 2, [math.inf, 1]), (None, 2, [1, 1]), (8, 2, []), (10, 1, []), (20, 2, []), (9, 2, [1, 1, 1]),
            (11, 2, [1, 1.5]), (11, 2, [1, 1.5]), (12, 1, [2, 2]), (12, 2, [2, 2]), (30, 1, [0, 0]), (31, 1, [0, 0]), (29, 2, [0, 0]), (40, 1, [-1, -2]), (50, 3, [1, 1]), (60, 4, [1e30, 1]), (61, 4, [1e30, 2]), (62, 5, [1e29, 1]), (63, 5, [5e28, 0])]
    found = got(mine(frame(spark, rows), F.col("vec_id") % 10 == 0))
    assert found == brute(rows, 10) and {r[0] for r in found} >= {0, 30}
    assert got(mine(frame(spark, []), F.col("vec_id") % 10 == 0)) == []
    assert got(mine(frame(spark, rows[:3]), F.col("vec_id") < 0)) == []


def test_scores_are_exact():
    rng = np.random.default_rng(0)
    for most in (2**8, 2**23, 2**31, 2**60):
        a, x = (rng.integers(-most, most, (5, 9)).astype(float) for _ in range(2))
        want = [[max(-(2**63), min(2**63 - 1, sum(int(p) * int(q) for p, q in zip(r, s, strict=True)))) for s in x] for r in a]
        assert scores(a, x).tolist() == want


def test_the_iterator_holds_no_rows_of_an_anchor():
    import pyarrow as pa

    def batches():
        yield pa.RecordBatch.from_arrays([pa.array([50]), pa.array([1000]), pa.array([False]), pa.array([1])], names=["anchor", "score", "negative", "id"])
        for k in range(50):
            yield pa.RecordBatch.from_arrays([pa.array([50] * 100), pa.array([990 - k] * 100), pa.array([True] * 100), pa.array(range(k * 100, k * 100 + 100))], names=["anchor", "score", "negative", "id"])

    out = [row for b in hardnegatives._stream(batches(), 50, 95, 3) for row in b.to_pylist()]
    assert [(r["rank"], r["negative_id"], r["negative_score"]) for r in out] == [(1, 4000, 950), (2, 4001, 950), (3, 4002, 950)]
