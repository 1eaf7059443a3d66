"""Operator 5: language by prediction by partial matching.

Per language, a tree of byte contexts of up to ``order`` bytes is counted once and frozen. A byte costs -log2 p bits, where a
context gives a byte it has met c / (n + d) and keeps d / (n + d) as escape for the bytes it hasn't, which the next shorter
context shares out with the met bytes excluded; below the empty context all bytes are equal. (n: bytes met after the context,
d: different ones.) The language whose tree codes the whole text in the fewest bits wins.

The trees of all languages become one table (context, byte class, language) of exact code lengths, so a text is scored by table
look-ups in numpy: the longest context that is in the tree is found level by level for all bytes of a batch at once.

Cases: null texts and texts without a letter are ``und`` with score 0; equal code lengths go to the first language by name; rows
may repeat; without any learned language all texts are ``und``; other columns are kept or ignored, never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from briefwright.llm.common import TEXT_BYTES, bounded, column, steps

UNDETERMINED = "und"


@dataclass
class Trees:
    """Frozen statistics. ``classes``: class of each byte, 0 for bytes never met and for what precedes a text."""

    languages: list[str]
    order: int
    classes: np.ndarray
    n_classes: int
    children: list[np.ndarray]  # per level: node and class of the byte before -> node of the next level, 0 for none
    states: list[np.ndarray]  # per level: node -> row of the table
    bits: np.ndarray  # (state and class, language)

    def code_lengths(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bits of each text under each language."""
        n, k, d = len(at) - 1, self.n_classes, self.order
        sizes = np.diff(at)
        sym = np.zeros(len(raw) + d * n, np.int32)  # so many empty places before each text
        begin = at[:-1] + d * np.arange(1, n + 1)
        sym[np.arange(len(raw)) + np.repeat(begin - at[:-1], sizes)] = self.classes[raw]
        state = np.zeros(len(sym), np.int32)
        node = np.zeros(len(sym), np.int32)
        for level in range(d):
            step = self.children[level]
            before = sym[: len(sym) - level - 1]
            node = step[node[level + 1 :] * k + before] if level == 0 else step[node[1:] * k + before]
            found = self.states[level][node]
            part = state[level + 1 :]
            np.copyto(part, found, where=node > 0)
        rows = state * k + sym
        out = np.empty((n, len(self.languages)))
        for i in range(len(self.languages)):
            total = np.concatenate([[0.0], np.cumsum(self.bits[i][rows], dtype=np.float64)])
            out[:, i] = total[begin + sizes] - total[begin]
        return out


def learn(texts: dict[str, list[bytes]], order: int = 4, max_states: int = 20_000, min_count: int = 4) -> Trees:
    """Trees of the texts of each language. ``max_states`` bounds the contexts kept, the most frequent first."""
    languages = sorted(texts)
    pad = bytes(order)
    met = np.unique(np.frombuffer(b"".join(t for l in languages for t in texts[l]), np.uint8))
    classes = np.zeros(256, np.int32)
    classes[met] = np.arange(1, len(met) + 1)
    k = len(met) + 1
    syms, inside = [], []
    for l in languages:
        raw = np.frombuffer(b"".join(pad + t for t in texts[l]), np.uint8)
        keep = np.ones(len(raw), bool)
        starts = np.cumsum([0] + [len(t) + order for t in texts[l]])[:-1]
        for j in range(order):
            keep[starts + j] = False
        sym = classes[raw].astype(np.int64)
        sym[~keep] = 0
        syms.append(sym)
        inside.append(np.flatnonzero(keep))
    # contexts as numbers: the byte just before is the lowest digit, so a context's suffix is what remains without its highest digit
    keys: list[list[np.ndarray]] = []
    for sym, at in zip(syms, inside, strict=True):
        key, own = np.zeros(len(at), np.int64), []
        for j in range(order):
            key = key + sym[at - j - 1] * k**j
            own.append(key)
        keys.append(own)
    known = []
    for j in range(order):
        values, counts = np.unique(np.concatenate([own[j] for own in keys]) if keys else np.zeros(0, np.int64), return_counts=True)
        known.append((values[counts >= min_count], counts[counts >= min_count]))
    size = np.concatenate([c for _, c in known]) if known else np.zeros(0)
    if len(size) > max_states:
        least = np.partition(size, len(size) - max_states)[len(size) - max_states]
        known = [(v[c > least], c[c > least]) for v, c in known]
    children, states, nodes, n_states = [], [], [np.zeros(1, np.int64)], 1
    suffix = [np.zeros(1, np.int64)]  # per level, of each node: the row of the next shorter context
    previous = np.zeros(1, np.int64)  # contexts of the level before, by node
    for j in range(order):
        values = known[j][0]
        parent = values % k**j
        place = np.searchsorted(previous, parent) if j else np.zeros(len(values), np.int64)
        fits = (place < len(previous)) & (previous[np.minimum(place, len(previous) - 1)] == parent) if len(previous) else np.zeros(len(values), bool)
        values, place = values[fits], place[fits]
        # node 0 of a level means none; at the first level the empty context stands there
        step = np.zeros(((len(previous) + 1) if j else 1) * k, np.int32)
        step[(place + 1 if j else place) * k + values // k**j] = np.arange(1, len(values) + 1)
        children.append(step)
        rows = np.concatenate([[0], n_states + np.arange(len(values))]).astype(np.int32)
        suffix.append(states[-1][place + 1] if j else np.zeros(len(values), np.int32))
        states.append(rows)
        n_states += len(values)
        previous = values
        nodes.append(values)
    bits = np.zeros((len(languages), n_states * k), np.float32)
    missing = 256 - (k - 1)
    for i, (sym, at, own) in enumerate(zip(syms, inside, keys, strict=True)):
        p = np.empty((n_states, k))
        base = np.full(k, 1 / 256)
        base[0] = missing / 256
        p[0] = _shared(np.bincount(sym[at], minlength=k)[None, :], base[None, :])[0]
        for j in range(order):
            if len(nodes[j + 1]):
                place = np.searchsorted(nodes[j + 1], own[j])
                hit = (place < len(nodes[j + 1])) & (nodes[j + 1][np.minimum(place, len(nodes[j + 1]) - 1)] == own[j])
                counts = np.bincount(place[hit] * k + sym[at][hit], minlength=len(nodes[j + 1]) * k).reshape(-1, k)
                p[states[j][1:]] = _shared(counts, p[suffix[j + 1]])
        p[:, 0] /= max(1, missing)
        bits[i] = -np.log2(p).reshape(-1)
    return Trees(languages, order, classes, k, children, states, bits)


def _shared(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Probabilities in contexts with these counts, given those in their next shorter contexts."""
    n, seen = counts.sum(axis=1, keepdims=True), counts > 0
    d = seen.sum(axis=1, keepdims=True)
    rest = np.where(seen, 0, shorter).sum(axis=1, keepdims=True)
    d = np.where(rest > 0, d, 0)  # nothing to escape to
    total = np.maximum(n + d, 1)
    escape = np.where(n > 0, d / total, 1.0)
    return np.where(seen, counts / total, escape * shorter / np.where(rest > 0, rest, 1))


#: Languages that trees are grown for at most: those with the most rows.
LANGUAGES = 500


def sample(df: DataFrame, text_col: str, lang_col: str, key_col: str, docs_per_language: int) -> dict[str, list[bytes]]:
    """Whole texts of about ``docs_per_language`` rows of each language, chosen by a hash of the key. Of more than ``LANGUAGES`` values, as a dirty column has them,
    the most frequent ones count; the bytes are bounded as for any sample."""
    rows = df.where(column(lang_col).isNotNull() & column(text_col).isNotNull()).select(column(lang_col).alias("lang"), column(text_col).alias("text"), column(key_col).alias("key"))
    often = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    counts = {r.lang: r.n for r in often.collect()}
    if not counts:
        return {}
    shares = df.sparkSession.createDataFrame([(l, min(1.0, docs_per_language / n)) for l, n in sorted(counts.items())], "lang string, share double")
    chosen = rows.where(F.octet_length("text") <= TEXT_BYTES).join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("key", F.lit("language")), F.lit(1_000_000)) < F.col("share") * 1_000_000)
    out: dict[str, list[tuple]] = {}
    for r in bounded(chosen.select("lang", F.col("text").cast("binary").alias("text"), F.xxhash64("key").alias("h"))):
        out.setdefault(r.lang, []).append((r.h, bytes(r.text)))
    return {l: [t for _, t in sorted(rows)] for l, rows in out.items()}


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id", docs_per_language: int = 250, order: int = 4, max_states: int = 20_000) -> Trees:
    """Trees learned from a bounded sample of the rows with a language: about ``docs_per_language`` each."""
    return learn(sample(df, text_col, lang_col, key_col, docs_per_language), order, max_states)


def predict(text: Column, trees: Trees, spark) -> Column:
    """struct(lang_pred, score, bits_per_byte): the score is the winner's probability, all languages being as likely before."""
    model = spark.sparkContext.broadcast(trees)  # bounded by max_states

    def run(texts: pa.Array) -> pa.Array:
        trees, names, scores, costs = model.value, [], [], []
        for _, _, raw, at in steps(texts):
            bits = trees.code_lengths(raw, at)
            best = bits.argmin(axis=1)
            low = bits[np.arange(len(best)), best]
            names += [trees.languages[b] for b in best.tolist()]
            scores.append(1 / np.exp2(-np.minimum(bits - low[:, None], 1000)).sum(axis=1))
            costs.append(low / np.maximum(1, np.diff(at)))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                                           pa.array(np.concatenate(costs) if costs else [], pa.float64())], names=["lang_pred", "score", "bits_per_byte"])

    kind = "lang_pred string, score double, bits_per_byte double"
    none = F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits_per_byte"))
    if not trees.languages:
        return none
    found = arrow_udf(run, f"struct<{kind.replace(' string', ':string').replace(' double', ':double')}>")(F.coalesce(text, F.lit("")))
    return F.when(F.coalesce(text.rlike("\\p{L}"), F.lit(False)), found).otherwise(none)
