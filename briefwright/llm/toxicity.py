"""Operator 6: toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the character n-grams (3 to 6 characters, lower case, spaces included) that it holds, hashed into buckets. From labelled
texts, each bucket gets r = log((a + toxic) / (total toxic)) - log((a + clean) / (total clean)), with the numbers of texts that
hold it. Buckets whose numbers differ between the classes by more than chance are kept, and a logistic regression is fitted on
r times presence. Only kept buckets cost anything when whole texts are scored.

Cases: null and empty texts have no n-gram and score the intercept; repeated rows score alike; without labels of both classes all
texts score 0.5; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import arrow_udf

from briefwright.llm.common import labelled_sample

ORDERS = (3, 4, 5, 6)
BUCKET_BITS = 21
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D, 0xFD7046C5, 0xB55A4F09], np.uint32)


@dataclass
class Linear:
    """``place``: bucket -> 1 + its row in ``weight``, or 0."""

    place: np.ndarray
    weight: np.ndarray
    intercept: float


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, and for each the number of its text."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.array([len(t) for t in low], np.int64)
    owner = np.repeat(np.arange(len(low), dtype=np.int32), sizes)
    key, buckets, owners = np.zeros(len(points), np.uint32), [], []
    for i in range(max(ORDERS)):
        part = points[i:] * _MIX[i]
        key = (key[: len(part)] ^ (key[: len(part)] >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + part
        if i + 1 in ORDERS and len(part):
            mixed = (key ^ (key >> np.uint32(16))) * np.uint32(0x7FEB352D + 2 * i)
            whole = owner[: len(part)] == owner[i:]
            buckets.append((mixed >> np.uint32(32 - BUCKET_BITS))[whole])
            owners.append(owner[: len(part)][whole])
    return (np.concatenate(buckets), np.concatenate(owners)) if buckets else (np.zeros(0, np.uint32), np.zeros(0, np.int32))


def learn(rows: list[tuple[int, str]], least_z: float = 5.0, max_features: int = 2048, alpha: float = 1.0, decay: float = 0.3, rounds: int = 250) -> Linear:
    y = np.array([label for label, _ in rows], np.float64)
    place = np.zeros(1 << BUCKET_BITS, np.int32)
    if not len(y) or y.min() == y.max():
        return Linear(place, np.zeros(1), 0.0)
    have = [np.zeros(1 << BUCKET_BITS, np.float32), np.zeros(1 << BUCKET_BITS, np.float32)]
    for label, text in rows:
        have[label][np.unique(grams([text])[0])] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()], np.float32)
    share = (have[0] + have[1]) / n.sum()
    z = (have[1] / n[1] - have[0] / n[0]) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n[0] + 1 / n[1]))
    kept = np.flatnonzero((np.abs(z) >= least_z) & (have[0] + have[1] >= 5))
    kept = np.sort(kept[np.argsort(-np.abs(z[kept]), kind="stable")[:max_features]])
    place[kept] = np.arange(1, len(kept) + 1)
    counts = [alpha + h for h in have]
    ratio = (np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum()))[kept]
    x = np.zeros((len(rows), len(kept)), np.float32)
    for i, (_, text) in enumerate(rows):
        x[i, (at := place[grams([text])[0]])[at > 0] - 1] = 1
    x *= ratio.astype(np.float32)
    w, b = np.zeros(len(kept)), 0.0
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, rounds + 1):  # Adam on all rows
        error = 1 / (1 + np.exp(-(x @ w.astype(np.float32) + b))) - y
        slope = np.append(error.astype(np.float32) @ x / len(y) + decay * w / len(y), error.mean())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Linear(place, np.append(0.0, w * ratio), float(b))


def scores(model: Linear, texts: list[str]) -> np.ndarray:
    buckets, owners = grams(texts)
    row = model.place[buckets]
    hit = row > 0
    pairs = np.unique(owners[hit].astype(np.int64) * len(model.weight) + row[hit])
    total = np.bincount(pairs // len(model.weight), weights=model.weight[pairs % len(model.weight)], minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total + model.intercept, -500, 500)))


def fit(df: DataFrame, labels: DataFrame, learn_on: Column, label: str = "toxic", per_class: int = 1500, id_col: str = "doc_id", text_col: str = "text") -> Linear:
    """A classifier learned from a bounded sample of the label rows for which ``learn_on`` holds: about ``per_class`` texts of each label."""
    return learn(labelled_sample(df, labels, label, learn_on, per_class, id_col, text_col))


def score(text: Column, model: Linear, spark) -> Column:
    """Probability of the label, from the whole text."""
    shared = spark.sparkContext.broadcast(model)  # a fixed number of buckets

    def run(texts: pa.Array) -> pa.Array:
        out, part, size = [], [], 0
        for t in texts.to_pylist():
            part.append(t or "")
            size += len(part[-1])
            if size > 1 << 20:
                out.append(scores(shared.value, part))
                part, size = [], 0
        out.append(scores(shared.value, part))
        return pa.array(np.concatenate(out), pa.float64())

    return arrow_udf(run, "double")(text)
