import collections

import pytest
from edge_cases import documents, nothing

from briefwright.llm import linededup
from briefwright.llm.linededup import LineRuns, counts, dedup_lines, unseen_lines


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))


def brute(rows, least, least_chars=1):
    met = collections.Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if len(k) >= least_chars)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if met[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def sample(n=400):
    words = ["Alpha", "bravo", "ÇHARLIE", "delta", "Écho", "", "  ", "golf\t"]
    return [(i, "\n".join(f"{words[(i * 7 + j * j) % 8]} {(i * j) % 23}" if j % 3 else words[(i + j) % 8] for j in range(i % 9))) for i in range(n)]


@pytest.mark.parametrize("parts, least", [(1, 10), (2, 5), (7, 10), (4, 1)])
def test_same_as_brute_force_for_any_batches(spark, parts, least):
    rows = sample()
    docs = documents(spark, rows)
    batches = [documents(spark, rows[i::parts]) for i in range(parts)]
    assert got(dedup_lines(docs, batches, least)) == brute(rows, least)


def test_least_length_of_keys(spark):
    rows = sample(120)
    assert got(dedup_lines(documents(spark, rows), [documents(spark, rows)], 3, 6)) == brute(rows, 3, 6)


def test_heavy_and_light_keys_alike(spark, monkeypatch):
    rows = sample(300)
    for bound in (1, 10**6):  # no key, every key is broadcast
        monkeypatch.setattr(linededup, "HEAVY", bound)
        assert got(dedup_lines(documents(spark, rows), [documents(spark, rows[:100]), documents(spark, rows[100:])])) == brute(rows, 10)


def test_runs_are_compacted_and_settled_keys_not_written_again(spark):
    runs = LineRuns(spark, least=2, fanout=3)
    batches = [[(100 * b + i, f"common\nonly {b} {i}") for i in range(3)] for b in range(9)]
    for b, rows in enumerate(batches):
        runs.add(counts(documents(spark, rows)))
        assert all(len(level) < 3 for level in runs.levels)
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    stored = spark.table(runs.levels[2][0])
    assert stored.count() == 1 + 27 and stored.agg({"n": "max"}).first()[0] == 3  # the first batch settled it
    plan = runs.open(spark.table(runs.levels[2][0]))._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan and "Exchange" not in plan
    runs.close()


def test_unseen_lines_of_batches_that_arrive(spark):
    runs, seen = LineRuns(spark, least=1), set()
    for b in range(5):
        rows = sample(200)[b * 40 : b * 40 + 40]
        want = []
        for i, t in rows:
            lines = t.split("\n")
            kept = [x for x in lines if key(x) not in seen]
            want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
        seen |= {key(x) for _, t in rows for x in t.split("\n")} - {""}
        assert got(unseen_lines(runs, documents(spark, rows))) == sorted(want, key=repr)
    runs.close()


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "\n"), (4, "a\n\n"), (5, "A \r\n\tb"), (6, "\x0ba\x0c\nB"), (7, "a\n" * 20_000), (None, "a"), (None, "a"), (8, "a\nx"), (8, "a\nx"), (8, "É\né")]
    assert got(dedup_lines(documents(spark, rows), [documents(spark, rows)], 3)) == brute(rows, 3)
    assert got(dedup_lines(nothing(spark), [nothing(spark)])) == [] and got(dedup_lines(nothing(spark), [])) == []
    odd = documents(spark, rows).withColumnsRenamed({"id": "_id", "h": "a.b", "c": "t", "n": "places", "score": "lines"})
    assert got(dedup_lines(odd, [odd], 3)) == brute(rows, 3)


def test_long_text_with_many_hits(spark):
    text = "\n".join(f"line {i % 50_000}" for i in range(200_000))
    rows = [(1, text), (2, text + "\nown")]
    assert got(dedup_lines(documents(spark, rows), [documents(spark, rows)], 2)) == [(1, 200_000, 200_000, ""), (2, 200_001, 200_000, "own")]
