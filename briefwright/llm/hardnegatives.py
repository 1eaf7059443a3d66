"""Operator 12: hard negatives by a secondary sort.

A row's score is its integer inner product with an anchor (components are floor(scale x)). Anchors are a stated query set: they
meet all rows in cells of a block of anchors and a block of rows, both of bounded size. A first pass over the cells keeps, of each anchor and cell,
the best rows of its label; their best are the anchor's positives, and each positive opens a window of scores. A second pass keeps the first
rows of other labels in each window of the cell, so that what is shuffled is bounded by cells and not by pairs. Positives and negatives then go
under the key (anchor, descending score, id) to the partition of their anchor and are sorted there; a streaming iterator reads them in that
order, opens a window at each positive, gives the negatives that fall into open windows and closes those that are full or passed. It holds
the open windows of one anchor, never its rows.

Scores are exact: single precision where all partial sums are below 2 ** 24, double below 2 ** 53, else Python's integers, held at the
bounds of a long.

Cases: rows with a null id, label or vector, with a null or non-finite component (also after scaling) take no part; vectors of different lengths
have no score; rows that repeat an id count once (that of the smallest label and vector); ties go by id; anchors without
positives, windows without negatives and empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from briefwright.llm.common import column, stage
from briefwright.llm.components import per_group

#: Rows and anchors of a cell.
ROW_BLOCK, ANCHOR_BLOCK = 8192, 8192

#: Anchors that a cell scores at a time.
STEP = 256


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, a.shape[1])
    if most < 2**24:
        return (a.astype(np.float32) @ x.astype(np.float32).T).astype(np.int64)
    if most < 2**53:
        return (a @ x.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in row] for row in m], object).reshape(m.shape)
    return np.clip(whole(a) @ whole(x).T, -(2**63), 2**63 - 1).astype(np.int64)


def usable(df: DataFrame, anchor: Column, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, v, anchor): one row per id of the rows that take part."""
    v = column(vector_col).cast("array<double>")
    rows = df.select(column(id_col).alias("id"), column(label_col).alias("label"), v.alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > 1e300))
    good = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad)
    return good.groupBy("id").agg(F.min(F.struct("label", "v", "anchor")).alias("r")).select("id", "r.*")


def _cells(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int) -> DataFrame:
    """Rows and anchors dealt into cells (x, y); a row goes to the cells of its block, once for each block of anchors, and so on."""
    nx, ny = max(1, -(-n_rows // ROW_BLOCK)), max(1, -(-n_anchors // ANCHOR_BLOCK))
    own = lambda n: F.pmod(F.xxhash64("id", F.lit("cell")), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    r = rows.select(own(nx).alias("x"), every(ny).alias("y"), "id", "label", "v", F.lit(False).alias("asks"), F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>").alias("windows"))
    a = anchors.select(every(nx).alias("x"), own(ny).alias("y"), "id", "label", "v", F.lit(True).alias("asks"), "windows")
    return r.unionByName(a)


class _Cell:
    """The rows and anchors of a cell that have vectors of one length, rows by id."""

    def __init__(self, table: pa.Table, scale: int):
        table = table.combine_chunks()
        v = table["v"].combine_chunks()
        sizes = v.value_lengths().to_numpy(zero_copy_only=False)
        ids, asks = table["id"].to_numpy(), table["asks"].to_numpy(zero_copy_only=False)
        labels = table["label"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        windows = table["windows"].combine_chunks()
        order = np.argsort(ids, kind="stable")
        self.parts = []
        for size in np.unique(sizes):
            rows, anchors = (order[(sizes[order] == size) & (asks[order] == k)] for k in (False, True))
            if len(rows) and len(anchors):
                number = lambda at, size=size: np.floor(scale * v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), size))
                self.parts.append((ids[rows], labels[rows], number(rows), ids[anchors], labels[anchors], number(anchors), windows.take(pa.array(anchors))))


def _batch(found: list[tuple]) -> pa.RecordBatch | None:
    if not found:
        return None
    anchor, row, score = (np.concatenate(c) for c in zip(*found, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(row), pa.array(score)], names=["anchor", "id", "score"])


def _best(table: pa.Table, scale: int, k: int) -> pa.RecordBatch | None:
    """The first ``k`` other rows of each anchor's label in the cell."""
    found = []
    for ids, labels, x, anchors, of, a, _ in _Cell(table, scale).parts:
        for label in np.unique(of):
            rows, asks = np.flatnonzero(labels == label), np.flatnonzero(of == label)
            for first in range(0, len(asks), STEP):
                ask = asks[first : first + STEP]
                s = scores(a[ask], x[rows])
                order = np.argsort(-s, axis=1, kind="stable")[:, : k + 1]  # one more, as the anchor may be among them
                to = ids[rows][order]
                other = to != anchors[ask][:, None]
                other &= np.cumsum(other, axis=1) <= k
                at, place = np.nonzero(other)
                found.append((anchors[ask][at], to[at, place], np.take_along_axis(s, order, 1)[at, place]))
    return _batch(found)


def _inside(table: pa.Table, scale: int, k: int) -> pa.RecordBatch | None:
    """The first ``k`` rows of other labels in each window of each anchor, in the cell."""
    found = []
    for ids, labels, x, anchors, of, a, windows in _Cell(table, scale).parts:
        for first in range(0, len(anchors), STEP):
            part = slice(first, first + STEP)
            s = scores(a[part], x)
            order = np.argsort(-s, axis=1, kind="stable")
            for i, opened in enumerate(windows[part].to_pylist()):
                mine = order[i][labels[order[i]] != of[first + i]]
                falling = s[i][mine]
                chosen = set()
                for w in opened:
                    begin = int(np.searchsorted(-falling, -w["hi"], "left"))
                    end = int(np.searchsorted(-falling, -w["lo"], "right"))
                    chosen.update(range(begin, min(end, begin + k)))
                if chosen:
                    at = np.array(sorted(chosen))
                    found.append((np.full(len(at), anchors[first + i]), ids[mine[at]], falling[at]))
    return _batch(found)


def _stream(batches: Iterator[pa.RecordBatch], low: int, high: int, k: int) -> Iterator[pa.RecordBatch]:
    """Reads (anchor, score, negative, id) by anchor, falling score, positives first, id; holds the open windows of one anchor."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    last, opened = None, []
    for batch in batches:
        out = []
        for anchor, score, negative, row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if anchor != last:
                last, opened = anchor, []
            if not negative:
                opened.append([row, score, 0])
                continue
            for window in opened:
                if low * window[1] <= 100 * score <= high * window[1]:
                    window[2] += 1
                    out.append((anchor, window[0], window[2], row, window[1], score))
            opened = [w for w in opened if w[2] < k and low * w[1] <= 100 * score]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "rank" else pa.int64()) for n, c in zip(names, zip(*out, strict=True), strict=True)], names=names)


def mine(df: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
         id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """Per anchor (rows for which ``anchor`` holds) and positive (its first ``positives`` other rows of the same label): the first ``negatives``
    rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score. Ids are whole numbers."""
    rows = stage(usable(df, anchor, id_col, label_col, vector_col))
    asks = rows.where("anchor").drop("anchor")
    n, m = rows.count(), asks.count()
    windowless = asks.withColumn("windows", F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>"))
    best = per_group(_cells(rows, windowless, n, m), ["x", "y"], lambda t: _best(t, scale, positives), "anchor long, id long, score long")
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    best = stage(best.withColumn("place", place).where(F.col("place") <= positives).drop("place"))
    # a window is empty if the positive's score is below zero; decimals, as a product may exceed a long
    wide = F.col("score").cast("decimal(25,0)")
    opened = best.where("score >= 0").select("anchor", F.struct(F.floor((wide * low + 99) / 100).cast("long").alias("lo"), F.floor(wide * high / 100).cast("long").alias("hi")).alias("w"))
    opened = opened.groupBy("anchor").agg(F.collect_set("w").alias("windows"))  # at most ``positives``
    found = per_group(_cells(rows, asks.join(opened, F.col("id") == F.col("anchor")), n, m), ["x", "y"], lambda t: _inside(t, scale, negatives), "anchor long, id long, score long")
    keyed = best.withColumn("negative", F.lit(False)).unionByName(found.withColumn("negative", F.lit(True)))
    dealt = keyed.repartition("anchor").sortWithinPartitions("anchor", F.desc("score"), "negative", "id").select("anchor", "score", "negative", "id")
    return dealt.mapInArrow(lambda b: _stream(b, low, high, negatives), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
