"""Chunks against the greedy loop."""

import json
import random

import pytest

from briefwright.plans import chunks


def greedy(rows, most):
    out, chunk, size, opened = [], 0, 0, set()
    for category, chars in rows:
        header = len(json.dumps(category, ensure_ascii=False)) + 3
        grown = size + 1 + chars + (0 if category in opened else header)
        if not chunk or grown > most:
            chunk, grown, opened = chunk + 1, 2 + header + chars, set()
        opened.add(category)
        size = grown
        out.append(chunk)
    return out


@pytest.mark.parametrize("block", [1, 3, 64])
def test_equals_the_greedy_loop(spark, monkeypatch, block):
    monkeypatch.setattr(chunks, "CHUNKS_OF_BLOCK", block)
    rng = random.Random(block)
    reports = {f"r{k}": [(rng.choice(["news", "é", "papers", None]), rng.choice([2, 30, 60, 199, 200, 201, 500, 9000] if k % 2 else [5, 9, 40])) for _ in range(rng.choice([1, 2, 40, 400]))] for k in range(6)}
    rows = [(run, 7 * i, c, n) for run, listed in reports.items() for i, (c, n) in enumerate(listed)]
    rng.shuffle(rows)
    got = chunks.size_bounded_chunks(spark.createDataFrame(rows, "_run string, ord long, category string, chars int"), 200).collect()
    assert len(got) == len(rows)
    for run, listed in reports.items():
        assert [r.chunk for r in sorted((r for r in got if r._run == run), key=lambda r: r.ord)] == greedy(listed, 200), run


def test_no_rows(spark):
    assert chunks.size_bounded_chunks(spark.createDataFrame([], "_run string, ord long, category string, chars int"), 200).collect() == []
