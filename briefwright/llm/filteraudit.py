"""Operator 11: audit of how filters interact, by sorted posting lists.

Every document is judged once by each filter. Documents are dealt into ranges of (part, id); a range keeps, sorted, one posting list
per filter (who fails it), and lists of the good and of the toxic documents. Unions of lists are built by galloping merges: the
shorter list is searched in the longer one, and only what is new is inserted. The sizes of the 32 unions of a range, and of their
meets with the good and the toxic list, are added up per part; all numbers of the audit are differences of them, for every order of
the filters: what a filter removes after others is what its list adds to their union.

Filters: A: under 200 words; B: 100 x distinct words < 50 x words; C: 100 x letters A to Z > 2 x code points; D: any of the signs
``#$%&*|``; E: the text of a smaller id. Words are runs of anything but space and tab to carriage return.

Cases: null texts are empty ones, null parts are the empty string; rows are documents, so rows that repeat an id count as often as
they stand (an equal id is no smaller id); a null id is smaller than none, has no smaller one, and has no labels; several label rows
of an id count as one that has every mark of theirs; an empty table gives an empty table; other columns are ignored. Texts are equal
if 128 bits of hash are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from briefwright.llm.common import HEAVY, column, span_hashes, stage, steps, with_keyed, word_spans

FILTERS = "ABCDE"

#: Whether a byte is part of a word, a letter A to Z, one of the signs, the first of a code point.
_BYTE = np.arange(256)
_WORD = ~((_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D)))
_UPPER = (_BYTE >= ord("A")) & (_BYTE <= ord("Z"))
_SIGN = np.isin(_BYTE, [ord(c) for c in "#$%&*|"])
_FIRST = (_BYTE & 0xC0) != 0x80


def _count(hit: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the bytes of each text are hit."""
    where = np.flatnonzero(hit)
    return np.searchsorted(where, at[1:]) - np.searchsorted(where, at[:-1])


def text_fails(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bits 0 to 3 of each text: filters A to D."""
    n = len(at) - 1
    starts, ends = word_spans(_WORD[raw], at)
    owner = np.searchsorted(at, starts, "right") - 1
    words = np.bincount(owner, minlength=n)
    hashes = span_hashes(raw, starts, ends)
    order = np.lexsort((hashes, owner))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][new], minlength=n)
    upper, signs, points = (_count(table[raw], at) for table in (_UPPER, _SIGN, _FIRST))
    return (words < 200) + 2 * (100 * distinct < 50 * words) + 4 * (100 * upper > 2 * points) + 8 * (signs > 0)


def _text_bits(texts: pa.Array) -> pa.Array:
    out = [text_fails(raw, at) for _, _, raw, at in steps(texts)]
    return pa.array(np.concatenate(out).astype(np.int32) if out else np.zeros(0, np.int32))


def judged(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(part, id, fails, good, toxic): a bit per failing filter."""
    text = F.coalesce(column(text_col), F.lit(""))
    rows = docs.select(column(id_col).alias("id"), F.coalesce(column(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = stage(rows.select("id", "part", arrow_udf(_text_bits, "int")("text").alias("fails"), F.xxhash64("text").alias("h"), F.xxhash64(F.lit("text"), "text").alias("g")))
    same = stage(rows.groupBy("h", "g").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1"))
    heavy = same.where(F.col("n") * HEAVY >= rows.count())
    found = with_keyed(rows, same, heavy, ["h", "g"], F.xxhash64("id"), "least")
    marks = labels.groupBy(column(id_col).alias("of")).agg(*[F.max((column(c) == 1).cast("int")).alias(c) for c in ("quality", "toxic")])
    found = found.join(marks.where("of is not null"), F.col("id") == F.col("of"), "left")
    repeats = F.coalesce(F.col("id") > F.col("least"), F.lit(False)).cast("int") * 16
    return found.select("part", "id", (F.col("fails") + repeats).alias("fails"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))


def postings(rows: DataFrame) -> DataFrame:
    """Ranges of (part, id): part, first_id, last_id, docs (how many), fails (a sorted list per filter), good, toxic. The lists hold
    places in the range, in the order of ids, so that a null or repeated id stays a document of its own."""

    def lists(batch: pa.RecordBatch) -> dict:
        fails, good, toxic = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3, 4))
        return {"part": batch.column(0)[0].as_py(), "first_id": batch.column(1)[0].as_py(), "last_id": batch.column(1)[batch.num_rows - 1].as_py(), "docs": batch.num_rows,
                "fails": [np.flatnonzero(fails >> f & 1).tolist() for f in range(len(FILTERS))], "good": np.flatnonzero(good).tolist(), "toxic": np.flatnonzero(toxic).tolist()}

    kind = rows.schema["id"].dataType
    schema = f"part string, first_id {kind.simpleString()}, last_id {kind.simpleString()}, docs long, fails array<array<int>>, good array<int>, toxic array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            found = [lists(batch.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_pylist(found, schema=pa.schema([("part", pa.string()), ("first_id", batch.schema.field(1).type), ("last_id", batch.schema.field(1).type), ("docs", pa.int64()),
                                                                     ("fails", pa.list_(pa.list_(pa.int32()))), ("good", pa.list_(pa.int32())), ("toxic", pa.list_(pa.int32()))]))

    # the hash parts the rows of one id, should it repeat very often
    dealt = rows.repartitionByRange("part", "id", F.xxhash64("fails", "good", "toxic")).sortWithinPartitions("part", "id")
    return dealt.mapInArrow(run, schema)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The union of two sorted lists: the shorter gallops through the longer one, and what is not met there is inserted."""
    if len(a) < len(b):
        a, b = b, a
    at = np.searchsorted(a, b)
    new = (at == len(a)) | (a[np.minimum(at, len(a) - 1)] != b) if len(a) else np.ones(len(b), bool)
    return np.insert(a, at[new], b[new])


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many entries two sorted lists share."""
    if len(a) < len(b):
        a, b = b, a
    at = np.searchsorted(a, b)
    return int((a[np.minimum(at, len(a) - 1)] == b).sum()) if len(a) else 0


def unions(fails: list[np.ndarray]) -> list[np.ndarray]:
    """The union of the lists of each set of filters, by the set's bits; each is one merge away from a smaller one."""
    out = [np.zeros(0, np.int32)]
    for chosen in range(1, 1 << len(fails)):
        low = (chosen & -chosen).bit_length() - 1
        out.append(merged(out[chosen & (chosen - 1)], fails[low]))
    return out


def union_sizes(ranges: DataFrame) -> DataFrame:
    """(part, docs, sizes): per part the sizes of all unions, by the set's bits, as structs (a: all, g: good, t: toxic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                all_of = unions([np.array(x, np.int32) for x in row["fails"]])
                good, toxic = np.array(row["good"], np.int32), np.array(row["toxic"], np.int32)
                sets = range(len(all_of))
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]] * len(all_of)), pa.array(sets, pa.int32()), pa.array([row["docs"]] * len(all_of), pa.int64()), pa.array([len(x) for x in all_of], pa.int64()),
                                                  pa.array([shared(x, good) for x in all_of], pa.int64()), pa.array([shared(x, toxic) for x in all_of], pa.int64())], names=["part", "chosen", "docs", "a", "g", "t"])

    each = ranges.select("part", "docs", "fails", "good", "toxic").mapInArrow(run, "part string, chosen int, docs long, a long, g long, t long")
    total = each.groupBy("part", "chosen").agg(*[F.sum(c).alias(c) for c in ("docs", "a", "g", "t")])
    sizes = F.array_sort(F.collect_list(F.struct("chosen", "a", "g", "t")))  # 32 of them
    return total.groupBy("part").agg(F.max("docs").alias("docs"), sizes.alias("sizes"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    sizes = stage(union_sizes(stage(postings(judged(docs, labels, id_col, text_col, part_col)))))
    every = (1 << len(FILTERS)) - 1
    steps_of = [(F.lit("".join(o)), F.lit(k + 1), F.lit(sum(1 << FILTERS.index(f) for f in o[:k])), F.lit(1 << FILTERS.index(o[k]))) for o in permutations(FILTERS) for k in range(len(FILTERS))]
    plan = F.array(*[F.struct(o.alias("filter_order"), s.alias("step"), b.alias("before"), f.alias("own")) for o, s, b, f in steps_of])
    rows = sizes.select("part", "docs", "sizes", F.explode(plan).alias("p")).select("part", "docs", "sizes", "p.*")
    of = lambda chosen: F.get("sizes", chosen)
    rows = rows.select("part", "filter_order", "step", "own", "docs", of(F.col("before")).alias("was"), of(F.col("before").bitwiseOR(F.col("own"))).alias("now"), of(F.col("own")).alias("single"),
                       of(F.lit(every)).alias("whole"), of(F.lit(every).bitwiseXOR(F.col("own"))).alias("others"))
    rows = rows.withColumn("removed", F.col("now.a") - F.col("was.a"))
    total = rows.groupBy("part", "own").agg(F.sum("removed").alias("shapley"))  # five rows a part
    return rows.join(total, ["part", "own"]).select(
        "part", "filter_order", "step", (F.col("docs") - F.col("now.a")).alias("kept"), "removed", (F.col("single.a") - F.col("removed")).alias("redundant"), (F.col("whole.a") - F.col("others.a")).alias("unique_fails"),
        (F.col("now.g") - F.col("was.g")).alias("good_lost"), (F.col("now.t") - F.col("was.t")).alias("toxic_lost"), "shapley")
