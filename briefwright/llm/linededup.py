"""Operator 13: removal of lines that repeat across documents, by levelled sorted runs of line hashes.

Documents come in batches. Each batch counts, once per document, the 128-bit hashes of its lines' keys; a merge anti-join with the
runs drops the keys that are settled (met often enough already), and what is left is added as a run of its own: a table bucketed
and sorted by hash, so that no join has to shuffle the runs again. When a level has ``fanout`` runs, they are compacted, their
counts added, into one run of the next level; so a batch meets few runs, and a key is rewritten once per level.

A line's key is the line without white space (space, tab to carriage return) at its ends, A to Z lower-cased. In the end the lines of all common keys are
looked up; documents get the places of their common lines back and keep the others. Keys with very many lines are known from the
counts: there are at most a fixed number of them, they are broadcast, and their lines are not shuffled to one task.

Cases: null or empty texts are one empty line, whose key is never common as it has no code points; a text that ends with a line
break ends with an empty line; rows are documents, so rows that repeat an id and a text count as often as they stand, and all get
the same result; ids may be null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from briefwright.llm.common import HEAVY, column, shared_folder, stage, with_keyed

SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_keys(text: Column) -> Column:
    """The keys of all lines of a text, in order. Texts of plain ASCII take the shorter way to lower case."""
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.transform(F.split(F.coalesce(low, F.lit("")), "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)))


def _hashed(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("h"), F.xxhash64(F.lit("line"), key).alias("g")]


def counts(docs: DataFrame, least_chars: int = 1, text_col: str = "text") -> DataFrame:
    """(h, g, n): in how many documents each key of at least ``least_chars`` code points is."""
    keys = docs.select(F.explode(F.array_distinct(line_keys(column(text_col)))).alias("key")).where(F.length("key") >= least_chars)
    return keys.select(*_hashed("key")).groupBy("h", "g").agg(F.count("*").alias("n"))


class LineRuns:
    """The runs: (h, g, n) tables bucketed and sorted by hash, in levels. A key is settled at ``least`` documents."""

    def __init__(self, spark: SparkSession, least: int = 10, fanout: int = 3):
        self.spark, self.least, self.fanout = spark, least, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))  # as an aggregate deals its keys
        self.levels: list[list[str]] = []
        self.dropped: list[str] = []
        self.heavy: DataFrame | None = None
        self.total = 0

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, "h", "g").sortBy("h", "g").option("path", shared_folder(self.spark)).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _merged(self, names: list[str]) -> DataFrame:
        """The runs as one, counts added, dealt as the buckets are. The bits of h are turned over and back: Spark 4.1 takes a union of
        bucketed tables for a bucketed one, and then does not bring equal keys together."""
        rows = [self.spark.table(n).select(F.bitwise_not(F.bitwise_not("h")).alias("h"), "g", "n") for n in names]
        return reduce(DataFrame.unionByName, rows).groupBy("h", "g").agg(F.sum("n").alias("n"))

    def _all(self) -> list[str]:
        return [n for level in self.levels for n in level]

    def settled(self) -> list[DataFrame]:
        """Of each run, the (h, g) of the keys that have ``least`` documents in it."""
        return [self.spark.table(n).where(F.col("n") >= self.least).select("h", "g") for n in self._all()]

    def open(self, found: DataFrame) -> DataFrame:
        """``found`` without the settled keys: merge anti-joins with the runs, which stay as they lie."""
        return reduce(lambda rest, run: rest.join(run.hint("merge"), ["h", "g"], "left_anti"), self.settled(), found)

    def add(self, found: DataFrame) -> None:
        """Adds a batch's (h, g, n) as a run, without the keys that are settled; then compacts the levels that are full."""
        found = stage(found)
        here = found.agg(F.sum("n")).first()[0] or 0
        self.total += here
        often = found.where(F.col("n") * HEAVY >= here)
        self.heavy = often if self.heavy is None else self.heavy.unionByName(often)
        self._write(self.open(found.repartition(self.buckets, "h", "g")), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            names = self.levels[level]
            self._write(self._merged(names), level + 1)
            self.levels[level] = []
            for name in names:
                self.spark.sql(f"DROP TABLE {name}")
            level += 1

    def common(self) -> tuple[DataFrame, DataFrame]:
        """(h, g) of all keys with ``least`` documents, and those of them with so many lines that they are to be broadcast: a key with
        1 / 10,000 of all lines has at least 1 / 20,000 of them in batches where it has that share, and those are remembered."""
        names = self._all()
        empty = self.spark.createDataFrame([], "h long, g long")
        if not names:
            return empty, empty
        keys = stage(self._merged(names).where(F.col("n") >= self.least).select("h", "g"))
        often = self.heavy.groupBy("h", "g").agg(F.sum("n").alias("n")).where(F.col("n") * HEAVY >= self.total)
        return keys, stage(often.select("h", "g").join(keys, ["h", "g"], "left_semi"))

    def close(self) -> None:
        for name in self._all():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = []


def drop_lines(docs: DataFrame, keys: DataFrame, heavy: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_lines, n_dropped, kept (the other lines, joined by line breaks). ``heavy``: a bounded part of ``keys``."""
    text = F.coalesce(column(text_col), F.lit(""))
    rows = docs.select(column(id_col).alias("id"), F.xxhash64(text).alias("t"), text.alias("text"))
    lines = rows.select("id", "t", F.posexplode(line_keys(F.col("text"))).alias("place", "key")).where("key <> ''").select("id", "t", "place", *_hashed("key"))
    hit = F.lit(True).alias("hit")
    found = with_keyed(lines, keys.select("h", "g", hit), heavy.select("h", "g", hit), ["h", "g"], F.xxhash64("t", "place"), "hit").where("hit")
    places = found.groupBy(F.col("id").alias("of"), F.col("t").alias("at")).agg(F.collect_set("place").alias("places"))
    # split below the join, so that it is not done again for each line
    split = rows.select("id", "t", F.split("text", "\n", -1).alias("lines"))
    both = split.join(places, F.col("id").eqNullSafe(F.col("of")) & (F.col("t") == F.col("at")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "places")
    kept = F.when(F.col("places").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return both.select(F.col("id").alias(id_col), F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))


def dedup_lines(docs: DataFrame, batches: list[DataFrame], least: int = 10, least_chars: int = 1, fanout: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, whose rows are those of ``batches``, without the lines whose key is in at least ``least`` documents."""
    runs = LineRuns(docs.sparkSession, least, fanout)
    for batch in batches:
        runs.add(counts(batch, least_chars, text_col))
    keys, heavy = runs.common()
    runs.close()
    return drop_lines(docs, keys, heavy, id_col, text_col)


def unseen_lines(runs: LineRuns, batch: DataFrame, least_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``batch`` without the lines that earlier batches have settled; the batch is then added. With ``least`` 1 that is every line
    met before, for batches that arrive one after the other."""
    found = stage(counts(batch, least_chars, text_col))
    here = found.agg(F.sum("n")).first()[0] or 0
    keys = stage(found.select("h", "g").join(runs.open(found).select("h", "g"), ["h", "g"], "left_anti"))
    out = stage(drop_lines(batch, keys, keys.join(found.where(F.col("n") * HEAVY >= here), ["h", "g"], "left_semi"), id_col, text_col))
    runs.add(found)
    return out
