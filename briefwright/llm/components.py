"""Connected components of an edge table, and counting inside components by pairs of bounded blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from briefwright.llm.common import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, component) of all vertices that have an edge to another one; the component is its smallest vertex.

    Each round, a vertex moves to its smallest neighbour, twice, and the edges are drawn anew between where their ends have moved;
    every component at least halves. Only minima are grouped, so a vertex with very many edges costs no task more than a number."""
    left = stage(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct())
    found = left.select(F.explode(F.array("hi", "lo")).alias("v")).distinct().withColumn("component", F.col("v"))
    while not left.isEmpty():
        to = left.groupBy("hi").agg(F.min("lo").alias("up"))
        further = to.select(F.col("hi").alias("up"), F.col("up").alias("up2"))
        to = stage(to.join(further, "up", "left").select("hi", F.coalesce("up2", "up").alias("up")))
        moved = lambda df, c, to=to: df.join(to.select(F.col("hi").alias(c), F.col("up").alias("_up")), c, "left").withColumn(c, F.coalesce("_up", c)).drop("_up")
        found = moved(found, "component")  # one join a round, and a handful of rounds
        left = stage(moved(moved(left, "hi"), "lo").where("hi <> lo").select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).distinct())
    return stage(found)


def block_pairs(members: DataFrame, group: str, member: str, weight: str, target: int) -> DataFrame:
    """``members`` with (x, y, side): the members of a group are dealt by hash into blocks of a total weight of about ``target``,
    and each member goes to all pairs of blocks that hold its own. A small group is one pair (0, 0)."""
    blocks = members.groupBy(group).agg(F.ceil(F.sum(weight) / target).cast("int").alias("_blocks"))
    dealt = members.join(blocks, group).withColumn("_own", F.pmod(F.xxhash64(member, F.lit("block")), F.col("_blocks")).cast("int"))
    other = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return other.withColumns({"x": F.least("_own", "_other"), "y": F.greatest("_own", "_other"), "side": (F.col("_own") > F.col("_other")).cast("int")}).drop("_blocks", "_own", "_other")


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches that are sorted by key."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        cuts = np.flatnonzero(change).tolist()
        if rest and first != last:
            yield pa.Table.from_batches(rest)
            rest = []
        begin = 0
        for cut in cuts:
            rest.append(batch.slice(begin, cut - begin))
            yield pa.Table.from_batches(rest)
            rest, begin = [], cut
        rest.append(batch.slice(begin))
        last = tuple(c[-1] for c in columns)
    if rest:
        yield pa.Table.from_batches(rest)


def per_group(df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work`` on the rows of each key. The groups must be bounded; a task holds one of them at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, keys):
            if (out := work(table)) is not None:
                yield out

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def least_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For vertices 0 to n - 1 and edges (i, j), the smallest vertex of each one's component."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def joined(held: DataFrame, counted: DataFrame) -> DataFrame:
    """(c, links, component) of all classes: ``held`` has c, copies and the least id of each, ``counted`` (c, links, b) the numbers
    of rows linked with a class, in parts, and a class that it is joined to. Copies of a row are linked with each other."""
    linked = components(counted, "c", "b").withColumnsRenamed({"v": "c", "component": "g"})
    links = counted.groupBy("c").agg(F.sum("links").alias("links"))
    every = held.select("c", "copies", "least").join(links, "c", "left").join(linked, "c", "left").withColumn("g", F.coalesce("g", "c"))
    smallest = every.groupBy("g").agg(F.min("least").alias("component"))
    return every.join(smallest, "g").select("c", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component")
