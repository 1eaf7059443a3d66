import numpy as np
import pytest
from edge_cases import TEXTS, documents, nothing
from pyspark.sql import functions as F

from briefwright.llm import language
from briefwright.llm.common import remainder

SAMPLES = {"aa": [b"abababab ab abba ab ab", b"baba ab"], "xy": [b"xyxyx yxxy xyxy", b"yx yx xy"]}


def brute(texts, text, order, min_count):
    """Code length of ``text`` in bits: contexts counted in dictionaries, probabilities by recursion."""
    met = {b for own in SAMPLES.values() for t in own for b in t}
    kept = {}
    for own in SAMPLES.values():
        for t in own:
            for i in range(len(t)):
                for j in range(1, order + 1):
                    context = tuple([None] * max(0, j - i) + list(t[max(0, i - j) : i]))
                    kept[context] = kept.get(context, 0) + 1
    known = {c for c, n in kept.items() if n >= min_count}
    counts = {}
    for t in texts:
        for i, b in enumerate(t):
            for j in range(order + 1):
                context = tuple([None] * max(0, j - i) + list(t[max(0, i - j) : i])) if j else ()
                counts.setdefault(context, {}).setdefault(b, 0)
                counts[context][b] += 1

    def p(context, b):
        shorter = (lambda x: p(context[1:], x)) if context else (lambda x: 1 / 256)
        own = counts.get(context, {})
        n, d = sum(own.values()), len(own)
        rest = 1 - sum(shorter(x) for x in own)
        if not n:
            return shorter(b)
        return own[b] / (n + d) if b in own else d / (n + d) * shorter(b) / rest

    total = 0.0
    for i, b in enumerate(text):
        context = ()
        for j in range(1, order + 1):
            longer = tuple([None] * max(0, j - i) + [x if x in met else None for x in text[max(0, i - j) : i]])
            if longer not in known:
                break
            context = longer
        total -= np.log2(p(context, b))
    return total


@pytest.mark.parametrize("text", [b"abab xyxy", b"", b"zzz ab", b"ba xy!", b"\xff\xfe"])
def test_code_lengths_are_exact(text):
    trees = language.learn(SAMPLES, order=3, min_count=2)
    got = trees.code_lengths(np.frombuffer(text + b"tail", np.uint8), np.array([0, len(text), len(text) + 4]))[0]
    assert np.allclose(got, [brute(SAMPLES[l], text, 3, 2) for l in trees.languages], rtol=1e-5, atol=1e-4)


def test_probabilities_sum_to_one():
    trees = language.learn(SAMPLES, order=4, min_count=1)
    p = np.exp2(-trees.bits[1].reshape(-1, trees.n_classes).astype(float))
    p[:, 0] *= 256 - (trees.n_classes - 1)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = remainder("doc_id", 4) == 2
    trees = language.fit(docs.where(~held))
    rows = docs.where(held).select("lang", language.predict(F.col("text"), trees, spark).alias("p")).collect()
    assert sum(r.lang == r.p.lang_pred for r in rows) >= 0.97 * len(rows) and all(0 <= r.p.score <= 1 for r in rows)


def test_edge_cases(spark):
    trees = language.learn({"en": [b"the dog and the fox"], "de": ["der Hund über".encode()]}, min_count=1)
    rows = documents(spark).select("doc_id", "text", language.predict(F.col("text"), trees, spark).alias("p")).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert (r.p.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.p.score <= 1
    assert nothing(spark).select(language.predict(F.col("text"), trees, spark)).collect() == []
    unknown = language.fit(nothing(spark).withColumn("lang", F.lit("en")))
    assert {r[0].lang_pred for r in documents(spark).select(language.predict(F.col("text"), unknown, spark)).collect()} == {"und"}
