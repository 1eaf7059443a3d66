"""Operator 10: near-duplicate embeddings by product quantisation.

Equal vectors are one class. A bounded sample gives coarse centroids and, for what is left of a vector after its centroid, codes of
its parts (a codebook of 256 per part). Every class goes to its nearest centroid's list and, as a query, to all lists near enough:
if two unit vectors are ``reach`` apart in a random direction, the squared distances to two centroids shift against each other by a
normal variable of deviation 2 reach |c - c'| / sqrt(dim), so lists up to ``z`` deviations behind the nearest are searched. In a list, distances are
sums of table look-ups by code; as each class stores the error of its code, no vector within reach is lost by them. What remains is
compared by cosine in double precision. A task only reports who belongs together; links are counted afterwards, exactly, inside
each component, in pairs of bounded blocks.

Long lists are cut into blocks, and the queries of a list into parts, so a crowded list is many tasks.

Cases: vectors that are null, empty, zero, of another length than most, or hold null or non-finite numbers link with nothing and are
their own component; rows with equal vectors link with each other whatever their ids; ids may be null; an empty table gives an empty
table; other columns are ignored. A class is known by the 64-bit hash of its vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from briefwright.llm.common import column, stage
from briefwright.llm.components import block_pairs, components, joined, least_labels, per_group

#: Classes of a list that one task searches, queries that it takes, and classes of a block when links are counted.
LIST_BLOCK, QUERY_PART, COUNT_BLOCK = 4096, 8192, 256


@dataclass
class Index:
    centroids: np.ndarray
    books: np.ndarray  # part, code, dimension of the part
    dim: int

    def padded(self, x: np.ndarray) -> np.ndarray:
        extra = self.books.shape[0] * self.books.shape[2] - self.dim
        return np.pad(x, ((0, 0), (0, extra))) if extra else x

    def coarse(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to all centroids."""
        return np.maximum(0, (x**2).sum(1)[:, None] - 2 * x @ self.centroids.T + (self.centroids**2).sum(1))

    def parts(self, x: np.ndarray) -> np.ndarray:
        p, _, d = self.books.shape
        return self.padded(x).reshape(len(x), p, d)

    def tables(self, rest: np.ndarray) -> np.ndarray:
        """Squared distances of each part to each code: row, part, code."""
        r = self.parts(rest)
        return np.stack([(r[:, i] ** 2).sum(1)[:, None] - 2 * r[:, i] @ b.T + (b**2).sum(1) for i, b in enumerate(self.books)], axis=1)


def _means(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = (2 * x @ c.T - (c**2).sum(1)).argmax(1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def _unit(rows: pa.Array, dim: int) -> np.ndarray:
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
    return flat / np.linalg.norm(flat, axis=1)[:, None]


def build(sample: np.ndarray, n: int, lists: int | None = None, parts: int = 8) -> Index:
    """Centroids (the square root of the number of classes, at most 4096) and codebooks from a sample of unit vectors."""
    rng = np.random.default_rng(11)
    dim = sample.shape[1]
    c = _means(sample, lists or min(4096, max(1, round(n**0.5))), 8, rng)
    index = Index(c, np.zeros((min(parts, dim), 1, -(-dim // min(parts, dim)))), dim)
    rest = index.parts(sample - c[index.coarse(sample).argmin(1)])
    index.books = np.stack([np.resize(_means(rest[:, i], 256, 6, rng), (min(256, len(sample)), rest.shape[2])) for i in range(rest.shape[1])])
    return index


def classes(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame, int]:
    """(rows: id, c; classes: c, vector, copies, least id; the dimension). c is null for vectors that can't be compared."""
    v = column(vector_col).cast("array<double>")
    sizes = df.where(F.size(column(vector_col)) > 0).groupBy(F.size(column(vector_col)).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim = sizes[0].d if sizes else 0
    norm = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    good = v.isNotNull() & (F.size(v) == dim) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & (norm > 0) & (norm < float("inf"))
    rows = stage(df.select(column(id_col).alias("id"), column(vector_col).alias("v"), F.coalesce(good, F.lit(False)).alias("good")).withColumn("c", F.when(F.col("good"), F.xxhash64("v"))))
    held = rows.where("good").groupBy("c").agg(F.first("v").alias("v"), F.count("*").alias("copies"), F.min("id").alias("least"))
    return rows.select("id", "c"), stage(held), dim


def _search(index: Index, table: pa.Table, reach: float) -> pa.RecordBatch | None:
    """Classes of one block of a list that are within reach of some query: (a, b) with b the smallest class joined to a."""
    here = int(table["list"][0].as_py())
    is_query = table["query"].to_numpy()
    c = table["c"].to_numpy()
    base, ask = np.flatnonzero(~is_query), np.flatnonzero(is_query)
    if not len(base) or not len(ask):
        return None
    x = _unit(table["v"].combine_chunks(), index.dim)
    codes = np.frombuffer(b"".join(table["codes"].take(pa.array(base)).to_pylist()), np.uint8).reshape(len(base), -1).astype(np.int64)
    error = table["error"].to_numpy()[base]
    label_of, back = np.unique(c, return_inverse=True)
    pairs_i, pairs_j = [], []
    for first in range(0, len(ask), 512):
        rows = ask[first : first + 512]
        t = index.tables(x[rows] - index.centroids[here])
        far = np.zeros((len(rows), len(base)))
        for p in range(codes.shape[1]):
            far += t[:, p][:, codes[:, p]]
        near_q, near_b = np.nonzero(np.sqrt(np.maximum(far, 0)) - error <= reach + 1e-6)
        i, j = rows[near_q], base[near_b]
        apart = back[i] != back[j]
        i, j = i[apart], j[apart]
        for at in range(0, len(i), 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            linked = (x[a] * x[b]).sum(1) >= 1 - reach * reach / 2
            pairs_i.append(back[a[linked]])
            pairs_j.append(back[b[linked]])
    if not sum(map(len, pairs_i)):
        return None
    label = least_labels(len(label_of), np.concatenate(pairs_i), np.concatenate(pairs_j))
    moved = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([pa.array(label_of[moved]), pa.array(label_of[label[moved]])], names=["a", "b"])


def _count(dim: int, least: float, table: pa.Table) -> pa.RecordBatch:
    """Per class of one pair of blocks: vectors linked with it there, and the smallest class that it is joined to."""
    x, c, copies, side = _unit(table["v"].combine_chunks(), dim), table["c"].to_numpy(), table["copies"].to_numpy(), table["side"].to_numpy()
    linked = x @ x.T >= least
    np.fill_diagonal(linked, False)
    if table["x"][0] != table["y"][0]:
        linked &= side[:, None] != side[None, :]
    order = np.argsort(c)
    i, j = np.nonzero(linked[np.ix_(order, order)])
    label = least_labels(len(c), i, j)
    return pa.RecordBatch.from_arrays([pa.array(c[order]), pa.array((linked @ copies)[order].astype(np.int64)), pa.array(c[order][label])], names=["c", "links", "b"])


def candidates(held: DataFrame, dim: int, cosine: float, z: float, sample: int = 8192, lists: int | None = None) -> DataFrame:
    """Edges (a, b) between classes: the components of the searched links."""
    spark, n = held.sparkSession, held.count()
    chosen = held.orderBy(F.xxhash64("c", F.lit("sample")), "c").limit(sample).select("v").toArrow()["v"].combine_chunks()
    index = build(_unit(chosen, dim), n, lists)
    shared, reach = spark.sparkContext.broadcast(index), float(np.sqrt(2 - 2 * cosine))  # bounded by the sample

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        between = np.sqrt(np.maximum(0, ((index.centroids**2).sum(1)[:, None] - 2 * index.centroids @ index.centroids.T + (index.centroids**2).sum(1))))
        for whole in batches:
            for first in range(0, whole.num_rows, 1024):
                batch = whole.slice(first, 1024)
                x = _unit(batch.column(1), index.dim)
                d = index.coarse(x)
                home = d.argmin(1)
                rest = x - index.centroids[home]
                codes = index.tables(rest).argmin(2)
                p = index.books.shape[0]
                error = np.sqrt(((index.parts(rest) - index.books[np.arange(p), codes]) ** 2).sum((1, 2)))
                behind = d - d[np.arange(len(x)), home][:, None]
                row, to = np.nonzero(behind <= 2 * reach * z / np.sqrt(index.dim) * between[home])
                packed = codes.astype(np.uint8)
                names = ["c", "v", "list", "query", "codes", "error"]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(home, pa.int32()), pa.array(np.zeros(len(x), bool)),
                                                  pa.array([r.tobytes() for r in packed], pa.binary()), pa.array(error)], names=names)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(to, pa.int32()), pa.array(np.ones(len(row), bool)),
                                                  pa.nulls(len(row), pa.binary()), pa.nulls(len(row), pa.float64())], names=names)

    kind = held.schema["v"].dataType.simpleString()
    placed = stage(held.select("c", "v").mapInArrow(place, f"c long, v {kind}, list int, query boolean, codes binary, error double"))
    sizes = placed.groupBy("list").agg(F.sum(F.when(~F.col("query"), 1).otherwise(0)).alias("b"), F.sum(F.when(F.col("query"), 1).otherwise(0)).alias("q"))
    sizes = sizes.select("list", F.greatest(F.lit(1), F.ceil(F.col("b") / LIST_BLOCK)).cast("int").alias("b"), F.greatest(F.lit(1), F.ceil(F.col("q") / QUERY_PART)).cast("int").alias("q"))
    dealt = placed.join(F.broadcast(sizes), "list")  # a row per centroid
    own = lambda n: F.pmod(F.xxhash64("c", F.lit("part")), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    dealt = dealt.withColumn("block", F.explode(F.when(F.col("query"), every("b")).otherwise(F.array(own("b")))))
    dealt = dealt.withColumn("part", F.explode(F.when(F.col("query"), F.array(own("q"))).otherwise(every("q"))))
    return per_group(dealt.select("list", "block", "part", "c", "v", "query", "codes", "error"), ["list", "block", "part"], lambda t: _search(shared.value, t, reach), "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95, z: float = 3.5, lists: int | None = None) -> DataFrame:
    """Per row: id, n_links (other vectors linked directly), component_id (the smallest id reachable), kept."""
    rows, held, dim = classes(df, id_col, vector_col)
    if held.isEmpty():
        found = rows.withColumns({"links": F.lit(None).cast("long"), "component": F.lit(None).cast(rows.schema["id"].dataType)})
    else:
        found = rows.join(_results(held, dim, cosine, z, lists), "c", "left")
    own = F.coalesce("component", "id")
    return found.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("id") == own, F.lit(False)).alias("kept"))


def _results(held: DataFrame, dim: int, cosine: float, z: float, lists: int | None) -> DataFrame:
    """(c, links, component) of all classes."""
    groups = components(candidates(held, dim, cosine, z, lists=lists)).withColumnsRenamed({"v": "c", "component": "g"})
    members = held.select("c", "v", "copies").join(groups, "c")
    pairs = block_pairs(members.withColumn("one", F.lit(1)), "g", "c", "one", COUNT_BLOCK).drop("one")
    counted = stage(per_group(pairs, ["g", "x", "y"], lambda t: _count(dim, cosine, t), "c long, links long, b long"))
    return joined(held, counted)
