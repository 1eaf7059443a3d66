"""Operator 2: quality by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` bytes. Each passage becomes shares of byte classes and byte pairs and how its words
repeat; a dense layer encodes it, gated attention weighs the passages of a text against each other, and the weighted sum of their
codes is scored. Only the text's label is known: the attention weights are learned with the rest, by gradients written out below.

Cases: null and empty texts are one passage without bytes; repeated rows score alike; without labels of both classes all texts
score 0.5; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import arrow_udf

from briefwright.llm.common import byte_view, labelled_sample, span_hashes, steps, word_spans

PASSAGE = 600
PAIRS = 128
#: Byte classes: each ASCII byte is its own, letters by case and digits as one more, and what is outside ASCII is one.
_CLASS = np.minimum(np.arange(256), 128).astype(np.int64)
_KIND = np.zeros(256, np.int64)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:], _KIND[32], _KIND[10] = 1, 2, 3, 4, 5, 6
_WORD = np.isin(_KIND, (1, 2, 3, 4))
FEATURES = 129 + 7 + 49 + PAIRS + 4


def passages(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of texts, and offsets of each text's passages; a text without bytes has one empty passage."""
    sizes = np.diff(at)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    bags = np.concatenate([[0], np.cumsum(counts)])
    n, total = len(raw), int(bags[-1])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    part = bags[owner] + (np.arange(n) - at[owner]) // PASSAGE
    size = np.maximum(np.bincount(part, minlength=total), 1)[:, None].astype(np.float32)
    kind = _KIND[raw]
    same = part[1:] == part[:-1]
    p = part[1:][same]
    a, b = raw[:-1][same].astype(np.int64), raw[1:][same].astype(np.int64)
    table = lambda key, k, base: np.bincount(base * k + key, minlength=total * k)[: total * k].reshape(total, k) / size
    starts, ends = word_spans(_WORD[raw], at)
    words = span_hashes(raw, starts, ends)
    place = part[starts] if len(starts) else np.zeros(0, np.int64)
    n_words = np.bincount(place, minlength=total)
    order = np.lexsort((words, place))
    first = np.ones(len(words), bool)
    first[1:] = (words[order][1:] != words[order][:-1]) | (place[order][1:] != place[order][:-1])
    different = np.bincount(place[order][first], minlength=total)
    again = np.bincount(place[1:][(words[1:] == words[:-1]) & (place[1:] == place[:-1])], minlength=total)
    per = np.maximum(n_words, 1)
    more = np.stack([different / per, again / per, n_words / size[:, 0] * 5, np.log1p(n_words) / 5], axis=1)
    x = np.concatenate([table(_CLASS[raw], 129, part), table(kind, 7, part), table(kind[:-1][same] * 7 + kind[1:][same], 49, p),
                        table((a * 31 + b * 17 + (a * b) // 7) % PAIRS, PAIRS, p), more], axis=1)
    return np.sqrt(x).astype(np.float32), bags


@dataclass
class Attention:
    """Weights: input scale, encoder, the two halves of the gate, attention, and the score of a text's code."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray

    def run(self, x: np.ndarray, bags: np.ndarray) -> dict:
        x = (x - self.mean) * self.scale
        h = np.tanh(x @ self.w[:-1] + self.w[-1])
        t, s = np.tanh(h @ self.v), 1 / (1 + np.exp(-(h @ self.u)))
        e = (t * s) @ self.a
        starts, counts = bags[:-1], np.diff(bags)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
        e /= np.repeat(np.add.reduceat(e, starts), counts)
        z = np.add.reduceat(e[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "s": s, "e": e, "z": z, "p": 1 / (1 + np.exp(-(z @ self.c[:-1] + self.c[-1])))}


def learn(rows: list[tuple[int, str]], width: int = 32, gate: int = 16, epochs: int = 30, bag: int = 64, rate: float = 0.004, decay: float = 1e-4) -> Attention | None:
    """Weights fitted with Adam on bags of passages; None without both labels."""
    y = np.array([label for label, _ in rows], np.float32)
    if not len(y) or y.min() == y.max():
        return None
    made = [passages(*byte_view(pa.array([text])))[0] for _, text in rows]
    every = np.concatenate(made)
    rng = np.random.default_rng(7)
    model = Attention(every.mean(axis=0), 1 / (every.std(axis=0) + 0.02), rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES + 1, width)), rng.normal(0, 0.2, (width, gate)),
                      rng.normal(0, 0.2, (width, gate)), rng.normal(0, 0.2, gate), rng.normal(0, 0.2, width + 1))
    names = ("w", "v", "u", "a", "c")
    m, q = {k: 0.0 for k in names}, {k: 0.0 for k in names}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(made))
        for first in range(0, len(order), bag):
            own = order[first : first + bag]
            bags = np.concatenate([[0], np.cumsum([len(made[i]) for i in own])])
            f = model.run(np.concatenate([made[i] for i in own]), bags)
            counts = np.diff(bags)
            error = (f["p"] - y[own]) / len(own)
            slope = {"c": np.append(f["z"].T @ error, error.sum())}
            dz = np.repeat(error[:, None] * model.c[:-1], counts, axis=0)
            de = (dz * f["h"]).sum(axis=1)
            de = f["e"] * (de - np.repeat(np.add.reduceat(f["e"] * de, bags[:-1]), counts))
            slope["a"] = (f["t"] * f["s"]).T @ de
            gated = de[:, None] * model.a
            dt, ds = gated * f["s"] * (1 - f["t"] ** 2), gated * f["t"] * f["s"] * (1 - f["s"])
            slope["v"], slope["u"] = f["h"].T @ dt, f["h"].T @ ds
            dh = (f["e"][:, None] * dz + dt @ model.v.T + ds @ model.u.T) * (1 - f["h"] ** 2)
            slope["w"] = np.concatenate([f["x"].T @ dh, dh.sum(axis=0, keepdims=True)])
            step += 1
            for k in names:
                now = getattr(model, k)
                g = slope[k] + decay * now
                m[k], q[k] = 0.9 * m[k] + 0.1 * g, 0.999 * q[k] + 0.001 * g**2
                setattr(model, k, now - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(q[k] / (1 - 0.999**step)) + 1e-8))
    for k in names:
        setattr(model, k, getattr(model, k).astype(np.float32))
    return model


def fit(df: DataFrame, labels: DataFrame, learn_on: Column, label: str = "quality", per_class: int = 1000, id_col: str = "doc_id", text_col: str = "text") -> Attention | None:
    """Weights learned from a bounded sample of the label rows for which ``learn_on`` holds: about ``per_class`` texts of each label."""
    return learn(labelled_sample(df, labels, label, learn_on, per_class, id_col, text_col))


def score(text: Column, model: Attention | None, spark) -> Column:
    """Probability of the label, from the whole text."""
    shared = spark.sparkContext.broadcast(model)  # fixed size

    def run(texts: pa.Array) -> pa.Array:
        if shared.value is None:
            return pa.array(np.full(len(texts), 0.5), pa.float64())
        out = [shared.value.run(*passages(raw, at))["p"] for _, _, raw, at in steps(texts, 1 << 20)]
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return arrow_udf(run, "double")(text)
