"""Operator 3: benchmark decontamination by winnowing. Built-in functions only.

A shared run of ``window`` words must be found. Both sides keep, of each ``window - k + 1`` consecutive k-grams, the one with the
smallest hash; a shared run has the same k-grams on both sides, so both keep the same one. Fingerprints of documents are joined
with those of the benchmark, and each hit is extended to the windows around it, which count if the benchmark has them.

An item of fewer words than a window is one window of its own length; for each such length the same is done with that length.
A fingerprint carries the hashes of the words around it, so extending needs no second look at the texts.

Cases: null texts have no words and are not contaminated; items without words match nothing; repeated items are each listed, repeated
rows each get their result; ids may be null; long texts are whole; an empty benchmark leaves all documents clean; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from briefwright.llm.common import column, identified, stage, with_rows

WINDOW = 10
GRAM = 5
#: Fixed: what is not part of a word, after lower-casing; letters of both cases are kept apart from it.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of the benchmark side up to which it is broadcast; a larger one is joined by shuffle, to the same result.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    """Words of a text, A to Z lower-cased; null for null. (Text of one byte a character has no other capitals.)"""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.filter(F.split(low, BETWEEN), lambda w: w != "")


def _hashes(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """(keys, hw): the hashes of the words of a text, none for null."""
    cut = df.select(*keys, words(F.coalesce(F.col(text), F.lit(""))).alias("w"))
    return cut.select(*keys, F.transform("w", lambda w: F.xxhash64(w)).alias("hw"))


def _grams(hw: str, k: int) -> Column:
    """Hashes of all runs of k words, the low byte of each being its place modulo 256: that breaks ties, and tells the
    place of a window's smallest hash."""
    return F.transform(F.sequence(F.lit(1), F.size(hw) - (k - 1)),
                       lambda i: F.xxhash64(F.slice(hw, i, k)).bitwiseAND(F.lit(~255)).bitwiseOR(i.cast("long").bitwiseAND(F.lit(255).cast("long"))))


def fingerprints(hashed: DataFrame, t: int, *keys: str, every: bool = False) -> DataFrame:
    """(keys, p, n, fp, context): the winnowed k-grams of texts of t words or more. ``p`` is the place of a k-gram, ``context``
    the hashes of the words that belong to a window of t words around it, the first standing at max(1, p - t + k). With ``every``,
    each text also has a row of place 0, whose n is its number of words. t must stay below 256."""
    k = min(GRAM, t)
    span = t - k + 1
    none = F.array().cast("array<bigint>")
    grams = hashed.select(*keys, "hw", F.when(F.size("hw") >= t, _grams("hw", k)).otherwise(none).alias("g"))
    places = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("g") - (span - 1)), lambda i: i + F.pmod(F.array_min(F.slice("g", i, span)) - i, F.lit(256)).cast("int")))
    places = F.when(F.size("g") > 0, places).otherwise(F.array().cast("array<int>"))
    kept = grams.select(*keys, "hw", "g", F.explode(F.concat(F.array(F.lit(0)), places) if every else places).alias("p"))
    first = F.greatest(F.lit(1), F.col("p") - (t - k))
    at = F.col("p") > 0
    return kept.select(*keys, "p", F.when(~at, F.size("hw")).alias("n"), F.when(at, F.shiftright(F.element_at("g", F.greatest("p", F.lit(1))), 8)).otherwise(F.xxhash64(*keys)).alias("fp"),
                       F.when(at, F.slice("hw", first, F.col("p") + t - first)).alias("context"))


def _windows(context: DataFrame, t: int, first: Column, *keys: str) -> DataFrame:
    """(keys, t, s, wh): all runs of t words in ``context``, whose first word stands at place ``first`` of the text."""
    runs = F.transform(F.sequence(F.lit(1), F.size("context") - (t - 1)), lambda i: F.struct((first + i - 1).alias("s"), F.xxhash64(F.slice("context", i, t)).alias("wh")))
    return context.where(F.size("context") >= t).select(*keys, F.inline(runs)).select(*keys, F.lit(t).alias("t"), "s", "wh")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def window_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, hits, item windows). Sizes: (id, h, n), the number of words of each row; h is the hash of the text. Hits: (id, h, t, s, wh),
    one row per place of a document where a window of t words of some item stands. Item windows: (t, wh, item)."""
    item_words = stage(_hashes(items.select(column(item_col).alias("item"), column(item_text).alias("text")), "text", "item").withColumn("n", F.size("hw")).where("n > 0"))
    short = sorted(r.n for r in item_words.where(F.col("n") < window).select("n").distinct().collect())  # below the window: a few numbers
    hashed = _hashes(docs.select(column(id_col).alias("id"), column(text_col).alias("text"), F.xxhash64(column(text_col)).alias("h")), "text", "id", "h")
    found, all_windows, sizes = [], [], None
    for t in [*short, window]:
        own = item_words.where(F.col("n") == t) if t < window else item_words.where(F.col("n") >= t)
        wins = stage(_windows(own.select("item", F.col("hw").alias("context")), t, F.lit(1), "item").select("t", "wh", "item").distinct())
        prints = stage(fingerprints(own.select("item", "hw"), t, "item").select(F.col("fp").alias("_fp")).distinct())
        marked = fingerprints(hashed, t, "id", "h", every=t == window)
        if t == window:
            hits = stage(marked.join(_small(prints), F.col("fp") == F.col("_fp"), "left").where(F.col("_fp").isNotNull() | (F.col("p") == 0)).drop("fp", "_fp"))
            sizes = hits.where("p = 0").select("id", "h", "n")
            hits = hits.where("p > 0")
        else:
            hits = marked.join(_small(prints), F.col("fp") == F.col("_fp"), "left_semi")
        around = _windows(hits, t, F.greatest(F.lit(1), F.col("p") - (t - min(GRAM, t))), "id", "h")
        found.append(around.join(_small(wins.select("wh").distinct()), "wh", "left_semi").select("id", "h", "t", "s", "wh").distinct())
        all_windows.append(wins)
    return sizes, stage(reduce(DataFrame.unionByName, found)), reduce(DataFrame.unionByName, all_windows)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit (words inside windows of items), items (their ids as sorted strings)."""
    sizes, hits, wins = window_hits(docs, items, id_col, text_col, item_col, item_text, window)
    before = F.max(F.col("s") + F.col("t")).over(Window.partitionBy("id", "h").orderBy("s", "t").rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("s") + F.col("t")
    covered = hits.withColumn("fresh", F.greatest(F.lit(0), end - F.greatest(F.col("s"), F.coalesce(before, F.col("s"))))).groupBy("id", "h").agg(F.sum("fresh").alias("n_hit"))
    listed = hits.select("id", "h", "t", "wh").distinct().join(wins, ["t", "wh"]).select("id", "h", F.col("item").cast("string").alias("item")).distinct()
    listed = listed.groupBy("id", "h").agg(F.sort_array(F.collect_list("item")).alias("items"))
    d = sizes.select("id", "h", F.col("n").cast("long").alias("n_words"))
    return with_rows(with_rows(d, covered), listed).select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item, with all their columns."""
    _, hits, _ = window_hits(docs, items, id_col, text_col, **options)
    bad = hits.select(F.col("id").alias("bad_id"), F.col("h").alias("bad_h")).distinct()
    rows = identified(docs, id_col, text_col).drop("text")
    return rows.join(bad, F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("h") == F.col("bad_h")), "left_anti").select("row.*")
