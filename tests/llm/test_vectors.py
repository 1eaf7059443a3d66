import numpy as np
import pytest

from briefwright.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, c string, v string, list string, g string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "c", "v", "l", "g") for i, v in rows], SCHEMA)


def brute(rows, least=0.95):
    x = np.array([np.float32(v) for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= least
    np.fill_diagonal(linked, False)
    label = np.array([i for i, _ in rows])
    while True:
        before = label.copy()
        for i in range(len(rows)):
            if linked[i].any():
                label[i] = min(label[i], label[linked[i]].min())
        if (label == before).all():
            return {i: (int(n), int(c)) for (i, _), n, c in zip(rows, linked.sum(1), label, strict=True)}


@pytest.mark.parametrize("blocks", [(4096, 8192, 1024), (40, 60, 30)])
def test_same_as_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(vectors, "LIST_BLOCK", blocks[0])
    monkeypatch.setattr(vectors, "QUERY_PART", blocks[1])
    monkeypatch.setattr(vectors, "COUNT_BLOCK", blocks[2])
    rng = np.random.default_rng(3)
    plain = rng.normal(size=(500, 24))
    hot = plain[7] + rng.normal(size=(200, 24)) * 0.12
    near = plain[100:140] + rng.normal(size=(40, 24)) * rng.uniform(0.02, 0.4, (40, 1))
    chain = np.array([plain[3] * np.cos(a) + plain[4] * np.sin(a) for a in np.arange(0, 1.2, 0.25)])
    rows = list(enumerate([*plain, *hot, *near, *chain, plain[9], plain[9] * 2]))
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(frame(spark, rows)).collect()}
    want = brute(rows)
    links = sum(n for n, _ in want.values())
    assert sum(n for n, _ in got.values()) >= 0.9 * links and all(got[i][0] <= want[i][0] for i in got)
    assert sum(got[i] == want[i] for i in want) >= 0.98 * len(want)


def test_edge_cases(spark):
    good = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0, 0, 0]), (4, [1, None, 2]), (5, [float("nan"), 1, 1]), (6, [float("inf"), 1, 1]), (7, [1, 2]), (8, good), (9, good), (9, good), (None, good), (10, [3, -1, 0])]
    got = sorted([(r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in vectors.near_duplicates(frame(spark, rows)).collect()])
    assert got == sorted([(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 10)] + [(8, 3, 8, True), (9, 3, 8, False), (9, 3, 8, False), (0, 3, 8, False)])
    assert vectors.near_duplicates(frame(spark, rows).where("false")).collect() == []
    alone = vectors.near_duplicates(frame(spark, rows).where("vec_id < 4")).collect()
    assert len(alone) == 3 and all(r.kept and r.n_links == 0 for r in alone)
