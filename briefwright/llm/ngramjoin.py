"""Operator 1: n-gram Jaccard join by chosen paths.

A text is the set of its runs of five words (words: runs of ASCII letters, digits and characters outside ASCII, A to Z lower-cased;
a text of fewer words is one run). Texts with the same words in the same order are one class, known by a 64-bit hash.

Each class gets a signature of minima under ``SIGNATURE`` hash functions; equal places of two signatures are shared tokens, sampled
in proportion to their Jaccard similarity. A run splits the root by two sampled places, so a class goes to two buckets. Small
buckets are compared by brute force on their signatures. In a larger one, all are compared with its smallest class; those so close to it that
the triangle inequality leads all their partners to it too are done, the others are split further by sampled places, 1.25 on average,
so that a pair at the threshold shares one more bucket on average. Runs are repeated until the chance to miss a pair at the threshold
is below 1 - ``recall``, given how deep the splitting went.

Pairs whose signatures agree well enough are candidates. They are only used to see what belongs together: inside each component all sets
are compared exactly, in pairs of blocks of bounded size, which gives the links of each class and the final groups. Copies and
near copies are never listed as pairs.

Cases: texts without words (null, empty, signs only) link with nothing and are their own class; repeated rows are copies; ids may be null, and the smallest
id that isn't names a class; long texts are whole; an empty table gives an empty table; other columns are ignored, or kept by ``distinct``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from briefwright.llm.common import _powers_for, column, identified, mixed, span_hashes, stage, steps, word_spans
from briefwright.llm.components import block_pairs, components, joined, least_labels, per_group

SHINGLE = 5
SIGNATURE = 64
#: Classes of a bucket that are compared by brute force, and of one that a task splits by itself.
BUCKET, IN_TASK = 1024, 4096
#: Agreement from which a pair is a candidate, and from which a class is done with its bucket: a partner of it, at 0.8, has at least 0.6
#: in common with what it agrees with in 0.8, as 1 - similarity obeys the triangle inequality; the rest is room for the estimate.
CANDIDATE, DONE = 0.5, 0.8
#: How deep the splitting is expected to go when the number of runs is planned.
PLANNED_DEPTH = 4
#: Shingles of a block when sets are compared; a set counts as LEAST at least, so that a block has a bounded number of sets.
BLOCK, LEAST = 400_000, 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_PLACE = mixed(np.arange(1001, 1001 + SHINGLE, dtype=np.uint64)) | np.uint64(1)
_TIMES = mixed(np.arange(2001, 2001 + SIGNATURE, dtype=np.uint64)) | np.uint64(1)
_PLUS = mixed(np.arange(3001, 3001 + SIGNATURE, dtype=np.uint64))


def shingles(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts given as bytes and offsets: hashes of all their runs of words, offsets of each text's, the number of
    words, and a hash of all words in order."""
    n = len(at) - 1
    starts, ends = word_spans(_WORD[raw], at)
    word = span_hashes(_LOWER[raw], starts, ends)
    owner = np.searchsorted(at, starts, "right") - 1
    count = np.bincount(owner, minlength=n)
    first = np.cumsum(count) - count
    total = np.zeros(n, np.uint64)
    if len(word):
        terms = word * _powers_for(int(count.max()))[np.arange(len(word)) - first[owner]]
        total[count > 0] = np.add.reduceat(terms, first[count > 0])
    order = mixed(total + count.astype(np.uint64))
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    runs = np.zeros(max(0, len(word) - SHINGLE + 1), np.uint64)
    for j in range(SHINGLE):
        runs += word[j : j + len(runs)] * _PLACE[j]
    whole = owner[: len(runs)] == owner[len(word) - len(runs) :] if len(runs) else np.zeros(0, bool)
    runs, whose = runs[whole], owner[: len(whole)][whole]
    if len(short):
        few = np.zeros(len(short), np.uint64)
        for j in range(SHINGLE - 1):
            has = count[short] > j
            few[has] += word[first[short[has]] + j] * _PLACE[j]
        runs, whose = np.concatenate([runs, few + count[short].astype(np.uint64)]), np.concatenate([whose, short])
        sort = np.argsort(whose, kind="stable")
        runs, whose = runs[sort], whose[sort]
    return mixed(runs), np.concatenate([[0], np.cumsum(np.bincount(whose, minlength=n))]), count, order


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, c, sig): h is the hash of the text, c the class, null without words, sig the minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, at in steps(batch.column(2)):
                values, offsets, count, order = shingles(raw, at)
                some = np.flatnonzero(count > 0)
                sig = np.zeros((end - first, SIGNATURE), np.uint64)
                if len(some):
                    for j in range(SIGNATURE):
                        sig[some, j] = np.minimum.reduceat(values * _TIMES[j] + _PLUS[j], offsets[some])
                none = pa.array(count == 0)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, SIGNATURE), pa.int32()), pa.array(sig.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first),
                                                  pa.array(order.view(np.int64), mask=none.to_numpy(zero_copy_only=False)), lists], names=["id", "h", "c", "sig"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("h"), column(text_col).alias("text")).mapInArrow(run, f"id {kind}, h long, c long, sig array<long>")


def agreement(a: str, b: str) -> Column:
    """The share of equal places of two signatures."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(SIGNATURE))


def places(path: int) -> list[int]:
    """The one or two places by which a bucket is split, 1.25 on average."""
    salt = int(mixed(np.array([path], np.int64).view(np.uint64))[0])
    return list({salt >> 8 & SIGNATURE - 1, salt >> 24 & SIGNATURE - 1 if salt & 3 == 0 else salt >> 8 & SIGNATURE - 1})


def inside(path: int, c: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Candidate edges (i, j) between the classes of one bucket, in order of c, and how deep the splitting went."""
    work, found_i, found_j, deepest = [(path, np.arange(len(c)), 0)], [], [], 0
    short = sig.astype(np.uint16)  # enough to compare by
    while work:
        path, own, depth = work.pop()
        deepest = max(deepest, depth)
        if len(own) <= BUCKET:
            for at in range(0, len(own) - 1, 128):
                agree = (short[own[at : at + 128]][:, None] == short[own[at:]][None]).sum(axis=2, dtype=np.uint8)
                i, j = np.nonzero(np.triu(agree >= CANDIDATE * SIGNATURE, 1))
                found_i.append(own[at + i])
                found_j.append(own[at + j])
            continue
        agree = (short[own[1:]] == short[own[0]]).mean(axis=1)
        near = own[1:][agree >= CANDIDATE]
        found_i.append(np.full(len(near), own[0]))
        found_j.append(near)
        rest = own[1:][agree < DONE]
        for p in places(path):
            order = rest[np.argsort(sig[rest, p], kind="stable")]
            cuts = np.flatnonzero(np.diff(sig[order, p])) + 1
            for part in np.split(order, cuts):
                if len(part) > 1:
                    child = mixed(np.array([path, p, sig[part[0], p]]).view(np.uint64))
                    work.append((int((child[0] ^ child[1] * np.uint64(3) ^ child[2]).view(np.int64)), np.sort(part), depth + 1))
    return np.concatenate(found_i), np.concatenate(found_j), deepest


def miss(depth: int, similarity: float) -> float:
    """The chance that one run misses a pair of this similarity if its buckets are small only after ``depth`` further splits."""
    share = 1.0
    for _ in range(depth):
        share = 1 - (0.75 * (1 - similarity * share) + 0.25 * (1 - similarity * share) ** 2)
    return (1 - similarity * share) ** 2


def _run(signed: DataFrame, first_run: int, runs: int) -> tuple[DataFrame, int]:
    """Candidate edges (a, b) of some runs, and how deep they went."""
    place = lambda r, i: int(mixed(np.array([r * 2 + i + 7], np.uint64))[0] % np.uint64(SIGNATURE))
    roots = [(r, p) for r in range(first_run, first_run + runs) for p in (place(r, 0), (place(r, 0) + 1 + place(r, 1) % (SIGNATURE - 1)) % SIGNATURE)]
    rows = signed.select("c", F.explode(F.array(*[F.xxhash64(F.lit(r), F.lit(p), F.col("sig")[p]) for r, p in roots])).alias("path"))
    small, near, depth, alive = [], [], 0, None
    while True:
        sizes = rows.groupBy("path").agg(F.count("*").alias("n"), F.min("c").alias("pivot")).where("n > 1")
        live = stage(rows.join(sizes, "path"))
        if alive is None:
            alive = stage(signed.join(live.select("c").distinct(), "c", "left_semi"))
        small.append(live.where(F.col("n") <= IN_TASK).select("path", "c", F.lit(depth).alias("depth")))
        large = live.where((F.col("n") > IN_TASK) & (F.col("c") != F.col("pivot"))).select("path", "c", "pivot")
        if large.isEmpty():
            break
        pivots = alive.select(F.col("c").alias("pivot"), F.col("sig").alias("_sig"))
        compared = stage(large.join(alive, "c").join(pivots, "pivot").withColumn("agree", agreement("sig", "_sig")).drop("_sig"))
        near.append(compared.where(F.col("agree") >= CANDIDATE).select(F.col("c").alias("a"), F.col("pivot").alias("b"), F.lit(depth).alias("depth")))
        salt = F.xxhash64("path", F.lit("place"))
        first = F.pmod(F.shiftright(salt, 8), F.lit(SIGNATURE))
        both = F.when(F.pmod(salt, F.lit(4)) == 0, F.array(first, F.pmod(F.shiftright(salt, 24), F.lit(SIGNATURE)))).otherwise(F.array(first))
        split = compared.where(F.col("agree") < DONE).withColumn("p", F.explode(F.array_distinct(both)))
        rows = split.select("c", F.xxhash64("path", "p", F.element_at("sig", (F.col("p") + 1).cast("int"))).alias("path"))
        depth += 1

    def work(table: pa.Table) -> pa.RecordBatch:
        c, kept = np.unique(table["c"].to_numpy(), return_index=True)
        sig = table["sig"].combine_chunks().flatten().to_numpy().reshape(-1, SIGNATURE)[kept]
        i, j, further = inside(int(table["path"][0].as_py()), c, sig)
        label = least_labels(len(c), i, j)
        moved = np.append(0, np.flatnonzero(label != np.arange(len(c))))  # the first row only tells the depth
        at = int(table["depth"][0].as_py()) + further
        return pa.RecordBatch.from_arrays([pa.array(c[moved]), pa.array(c[label[moved]]), pa.array(np.full(len(moved), at), pa.int32())], names=["a", "b", "depth"])

    # buckets are bounded here
    solved = per_group(reduce(DataFrame.unionByName, small).join(alive, "c"), ["path"], work, "a long, b long, depth int")
    edges = stage(reduce(DataFrame.unionByName, [solved, *near]).distinct())
    return edges.select("a", "b"), edges.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]


def candidates(signed: DataFrame, similarity: float, recall: float) -> DataFrame:
    """Edges (a, b) of candidate pairs of classes."""
    runs = max(1, math.ceil(math.log(1 - recall) / math.log(miss(PLANNED_DEPTH, similarity))))
    pairs, depth = _run(signed, 0, runs)
    while (left := miss(depth, similarity) ** runs) > 1 - recall:
        more = math.ceil(math.log((1 - recall) / left) / math.log(miss(depth, similarity)))
        found, deeper = _run(signed, runs, more)
        pairs, depth, runs = pairs.unionByName(found), max(depth, deeper), runs + more
    return pairs


def _compare(table: pa.Table, times: int, over: int) -> pa.RecordBatch | None:
    """Links inside one pair of blocks: sets are linked if times * union <= over * intersection."""
    c, kept = np.unique(table["c"].to_numpy(), return_index=True)  # repeated rows of a class are one
    sets = [np.frombuffer(b, np.uint64) for b in table["tokens"].take(pa.array(kept)).to_pylist()]
    copies, side = table["copies"].to_numpy()[kept], table["side"].to_numpy()[kept]
    if len(sets) < 2:
        return None
    size = np.array(list(map(len, sets)))
    token, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size)
    shared = count > 1
    number = np.cumsum(shared) - 1
    use = shared[place]
    owner, place = owner[use], number[place[use]]
    both = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    width = max(1, min(int(shared.sum()), max(256, (1 << 24) // len(sets))))
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(place, [low, low + width])
        hold = np.zeros((len(sets), width), np.float32)
        hold[owner[a:b], place[a:b] - low] = 1
        both += hold @ hold.T
    linked = times * (size[:, None] + size[None, :] - both) <= over * both
    np.fill_diagonal(linked, False)
    if table["x"][0] != table["y"][0]:
        linked &= side[:, None] != side[None, :]
    label = least_labels(len(c), *np.nonzero(linked))
    return pa.RecordBatch.from_arrays([pa.array(c), pa.array((linked @ copies).astype(np.int64)), pa.array(c[label])], names=["c", "links", "b"])


def _sets(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(g, c, copies, tokens, weight): the sorted set of each class, from the text of its first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, at in steps(batch.column(3)):
                values, offsets, _, _ = shingles(raw, at)
                sets = [np.unique(values[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array([s.tobytes() for s in sets], pa.binary()),
                                                  pa.array([max(LEAST, len(s)) for s in sets], pa.int64())], names=["g", "c", "copies", "tokens", "weight"])

    texts = docs.select(column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("h"), column(text_col).alias("text"))
    wanted = members.select("g", "c", "copies", F.col("row.id").alias("_id"), F.col("row.h").alias("_h"))
    found = texts.join(wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))).select("g", "c", "copies", "text")
    return found.mapInArrow(run, "g long, c long, copies long, tokens binary, weight long")


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: tuple[int, int] = (4, 5), recall: float = 0.99) -> DataFrame:
    """Per row: id, h, class_id (the smallest id reachable by links) and n_links (other rows of a similarity of at least 4 / 5)."""
    times, over = similarity
    rows = stage(signatures(docs, id_col, text_col))
    signed = rows.where(F.col("c").isNotNull())
    classes = stage(signed.groupBy("c").agg(F.count("*").alias("copies"), F.min(F.struct("id", "h")).alias("row"), F.min("id").alias("least"), F.first("sig").alias("sig")))
    groups = components(candidates(classes.select("c", "sig"), times / over, recall)).withColumnsRenamed({"v": "c", "component": "g"})
    members = classes.select("c", "copies", "row").join(groups, "c")
    sets = block_pairs(stage(_sets(docs, members, id_col, text_col)), "g", "c", "weight", BLOCK).drop("weight")
    counted = stage(per_group(sets, ["g", "x", "y"], lambda t: _compare(t, times, over), "c long, links long, b long"))
    results = joined(classes.select("c", "copies", "least"), counted)
    found = signed.select("id", "h", "c").join(results, "c").select("id", "h", F.coalesce("component", "id").alias("class_id"), F.col("links").alias("n_links"))
    alone = rows.where(F.col("c").isNull()).select("id", "h", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(alone).withColumnRenamed("id", id_col)


def distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of ``docs`` per group, that of its smallest id, with all its columns. Texts without words stay."""
    found = similar(docs, id_col, text_col, **options).select(column(id_col).alias("id"), "h", "class_id", "n_links").where(F.col("id").eqNullSafe(F.col("class_id")))
    keep = stage(found.groupBy("id", "h").agg(F.count("*").alias("rows"), F.max("n_links").alias("links")))
    rows = identified(docs, id_col, text_col)
    of = lambda k: rows.join(k.select(F.col("id").alias("kept_id"), F.col("h").alias("kept_h")), F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("h") == F.col("kept_h")))
    # rows that repeat an id and its text are copies too
    again = (F.col("rows") > 1) & (F.col("links") > 0)
    if keep.where(again).isEmpty():
        return of(keep).select("row.*")
    return of(keep.where(~again)).unionByName(of(keep.where(again)).dropDuplicates(["id", "h"])).select("row.*")
