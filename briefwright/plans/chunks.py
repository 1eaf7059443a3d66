"""Chunks of bounded size over an ordered report of any length.

A chunk takes rows as long as they fit, so where a chunk ends depends on where it began. For every row, "the next chunk's first row, had a
chunk begun here" is found by a range search: a chunk reaches at most ``max_chars`` characters, so it lies in a block of the report's running
total or a little beyond it. Inside a block these pointers are followed to the first row behind the block; only rows at the beginning of a block
can be entered from before, so a block is one short list (entry, exit, chunks between). The path from the report's first row over these lists is
found by pointer doubling, in as many rounds as the logarithm of the number of blocks. Then each block numbers its rows from its entry.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from briefwright.operators.ranking import running_total
from briefwright.session import cut_lineage

#: Longest chunks that a block holds.
CHUNKS_OF_BLOCK = 64


def _header(category) -> int:
    """A category's name as JSON, with colon and brackets."""
    return len(json.dumps(category, ensure_ascii=False)) + 3


def next_starts(chars: list[int], categories: list, own: int, max_chars: int) -> list[int]:
    """For each of the first ``own`` rows: the row after the chunk that begins there. A chunk is a JSON object of category -> array: two braces, a
    header per category, and a comma between rows."""
    out, end, size = [], 0, 0
    inside: dict = {}
    headers = {c: _header(c) for c in set(categories)}
    for s in range(own):
        if end <= s:
            end, size, inside = s + 1, 2 + headers[categories[s]] + chars[s], {categories[s]: 1}
        while end < len(chars):
            c = categories[end]
            grown = size + 1 + chars[end] + (0 if inside.get(c) else headers[c])
            if grown > max_chars:
                break
            size, end = grown, end + 1
            inside[c] = inside.get(c, 0) + 1
        out.append(end)
        c = categories[s]
        inside[c] -= 1
        size -= chars[s] + 1 + (0 if inside[c] else headers[c])
    return out


def _entries(max_chars: int, width: int):
    """(entry, exit, chunks between) of the rows of a block that a chunk from before may end at."""
    def work(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.sort_by("idx").to_pydict()
        block = key[1].as_py()
        own = sum(x == block for x in rows["home"])
        after = next_starts(rows["chars"], rows["category"], own, max_chars)
        leave, count = [0] * own, [0] * own
        for s in range(own - 1, -1, -1):
            leave[s], count[s] = (after[s], 1) if after[s] >= own else (leave[after[s]], count[after[s]] + 1)
        first = rows["idx"][0] if own else 0
        may = [s for s in range(own) if s == 0 or rows["before"][s] - block * width <= max_chars]
        return pa.table({"key": pa.array([key[0].as_py()] * len(may), table.schema.field("key").type), "block": pa.array([block] * len(may), pa.int64()),
                         "idx": pa.array([first + s for s in may], pa.int64()), "to": pa.array([first + leave[s] for s in may], pa.int64()), "n": pa.array([count[s] for s in may], pa.int64())})

    return work


def _numbers(max_chars: int):
    """Chunk numbers of a block's rows, from its entry (a row, and how many chunks began before it)."""
    def work(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        rows = table.to_pydict()
        entry, chunk = rows["entry"][0] - rows["idx"][0], rows["began"][0]
        own = len(rows["idx"])
        after = next_starts(rows["chars"], rows["category"], own, max_chars) if entry < own else []
        numbers, start = [chunk] * min(entry, own), entry
        while start < own:
            chunk += 1
            numbers += [chunk] * (after[start] - start)
            start = after[start]
        return pa.table({"key": table["key"], "ord": table["ord"], "chunk": pa.array(numbers, pa.int64())})

    return work


def size_bounded_chunks(rows: DataFrame, max_chars: int, key: str = "_run", order: str = "ord") -> DataFrame:
    """Adds ``chunk`` (from 1): ordered rows packed into chunks of at most ``max_chars`` characters; a longer row is a chunk of its own.
    Needs the columns category, ``chars`` and ``order``, whose values differ inside a report."""
    slim = rows.select(F.col(key).alias("key"), F.col(order).cast("bigint").alias("ord"), "category", F.col("chars").cast("bigint").alias("chars"))
    width = CHUNKS_OF_BLOCK * max_chars
    placed = running_total(slim.withColumn("step", F.col("chars") + 1), "step", [F.col("ord")], ["key"], "before", "idx").drop("step")
    placed = cut_lineage(placed.withColumn("home", F.floor(F.col("before") / width)))
    kind = dict(placed.dtypes)["key"]
    # a chunk that begins in a block may reach into the next one
    reach = F.when(F.col("before") - F.col("home") * width <= max_chars, F.array("home", F.col("home") - 1)).otherwise(F.array("home"))
    steps = cut_lineage(placed.withColumn("block", F.explode(reach)).groupBy("key", "block").applyInArrow(_entries(max_chars, width), f"key {kind}, block bigint, idx bigint, to bigint, n bigint"))
    ends = placed.groupBy("key").agg((F.max("idx") + 1).alias("idx"), F.max("home").alias("block"))
    met = cut_lineage(placed.where("idx = 1").select("key", "idx", F.lit(0).cast("bigint").alias("began")))
    jumps = steps.select("key", "idx", "to", "n")
    while not jumps.isEmpty():
        further = met.join(jumps, ["key", "idx"]).select("key", F.col("to").alias("idx"), (F.col("began") + F.col("n")).alias("began"))
        met = cut_lineage(met.unionByName(further))
        second = jumps.select("key", F.col("idx").alias("to"), F.col("to").alias("to2"), F.col("n").alias("n2"))
        jumps = cut_lineage(jumps.join(second, ["key", "to"]).select("key", "idx", F.col("to2").alias("to"), (F.col("n") + F.col("n2")).alias("n")))
    where = steps.select("key", "idx", "block").unionByName(ends)
    entry = met.join(where, ["key", "idx"]).groupBy("key", "block").agg(F.min_by(F.struct("idx", "began"), "idx").alias("e"))
    entry = entry.select("key", F.col("block").alias("home"), F.col("e.idx").alias("entry"), F.col("e.began").alias("began"))
    numbered = placed.join(entry, ["key", "home"]).groupBy("key", "home").applyInArrow(_numbers(max_chars), f"key {kind}, ord bigint, chunk bigint")
    return rows.join(numbered.withColumnsRenamed({"key": key, "ord": order}), [key, order])
