"""What the operators share: staging, samples, keys, and texts as byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from briefwright.session import cut_lineage as stage, shared_folder  # noqa: F401 - the operators take both from here

#: Bytes of text that one numpy step handles at a time; a longer text is a step of its own.
STEP = 1 << 21


def with_rows(df: DataFrame, more: DataFrame) -> DataFrame:
    """``df`` with the other columns of ``more`` for the same (id, h): a key, which may be null, and the hash of the text."""
    more = more.withColumnsRenamed({"id": "_id", "h": "_h"})
    return df.join(more, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left").drop("_id", "_h")


def column(name: str) -> Column:
    """The column of that very name, whatever signs it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct: whatever their names, they clash with no helper column; ``select("row.*")`` brings them back."""
    return F.struct(*map(column, df.columns)).alias("row")


def identified(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, text, row): the key, the hash of the text, the text, and the whole row."""
    return df.select(column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("h"), column(text_col).alias("text"), whole_row(df))


#: A key with at least one of so many rows is heavy; there are at most so many heavy keys.
HEAVY = 20_000


def with_keyed(rows: DataFrame, table: DataFrame, heavy: DataFrame, keys: list[str], spread: Column, value: str) -> DataFrame:
    """``rows`` with the column ``value`` of ``table``, which has one row for each of its ``keys``; null where there is none. The
    rows of the keys that ``heavy`` lists (at most ``HEAVY``, so they are broadcast, with their values) stay where they are: for the join by
    shuffle they get a key of their own, from ``spread``. The columns of ``rows`` must not begin with an underscore."""
    hot = F.broadcast(heavy.select(*keys, F.struct(F.col(value).alias("x")).alias("_hot")))
    flagged = rows.join(hot, keys, "left")
    first, *others = [F.col(k) for k in keys]
    keyed = flagged.withColumns({"_k0": F.when(F.col("_hot").isNotNull(), spread).otherwise(first), "_light": F.col("_hot").isNull()})
    cold = table.select(F.col(keys[0]).alias("_k0"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys[1:], 1)], F.lit(True).alias("_light"), F.col(value).alias("_cold"))
    on = [keyed["_k0"] == cold["_k0"], keyed["_light"] == cold["_light"], *[keyed[k] == cold[f"_k{i}"] for i, k in enumerate(keys[1:], 1)]]
    joined = keyed.join(cold, on, "left")
    return joined.select(*rows.columns, F.coalesce("_hot.x", "_cold").alias(value))


def remainder(key: Column | str, modulus: int) -> Column:
    """crc32 of a key as text, modulo ``modulus``; null for a null key."""
    return F.crc32((F.col(key) if isinstance(key, str) else key).cast("string").cast("binary")) % modulus


#: Bytes of text that a classifier is fitted on at most, and of one such text.
SAMPLE_BYTES, TEXT_BYTES = 64 << 20, 4 << 20


def bounded(chosen: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> list:
    """The rows (h, text, ...) of a sample, as many as fit into ``sample_bytes`` by the order of their hash h. The sample has a
    bounded number of rows, each of at most ``TEXT_BYTES``; it is staged, so that the driver receives no more than fits."""
    rows = stage(chosen)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > sample_bytes:  # a share of the hashes holds that share of the bytes, but for one text or so
        low = F.pmod(F.xxhash64("h", F.lit("bytes")), F.lit(1_000_000))
        rows = rows.where(low < int(1_000_000 * sample_bytes / size))
    return rows.collect()


def labelled_sample(df: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[int, str]]:
    """(label, whole text) of about ``per_class`` rows of each of the labels 0 and 1 among the label rows for which ``learn``
    holds, chosen by a hash of their id: the bounded sample that a classifier is fitted on. Null texts count as empty; of rows that repeat an id the
    smallest text is taken; texts of over ``TEXT_BYTES`` are not learned from, and all of them together are at most about ``SAMPLE_BYTES``."""
    rows = labels.where(learn & column(label).isin(0, 1)).select(column(id_col).alias("key"), column(label).cast("int").alias("y")).distinct()
    counts = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.coalesce(*[F.when(F.col("y") == y, F.lit(min(1.0, per_class / n))) for y, n in sorted(counts.items())], F.lit(0.0))
    chosen = rows.where(F.pmod(F.xxhash64("key", F.lit(label)), F.lit(1_000_000)) < share * 1_000_000)
    texts = df.select(column(id_col).alias("key"), F.coalesce(column(text_col), F.lit("")).alias("text")).where(F.octet_length("text") <= TEXT_BYTES)
    # the chosen ids are few by construction, so they may be broadcast
    found = texts.join(F.broadcast(chosen), "key").groupBy("key", "y").agg(F.min("text").alias("text"))
    return [(r.y, r.text) for r in sorted(bounded(found.select("y", "text", F.xxhash64("key").alias("h"))), key=lambda r: (r.h, r.y, r.text))]


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string array and its n + 1 offsets, without a copy; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def steps(texts: pa.Array, limit: int = STEP) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over runs of rows of at most ``limit`` bytes, or one longer row."""
    raw, at = byte_view(texts)
    first, n = 0, len(at) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        end = min(end, n)
        yield first, end, raw[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values[offsets[i]:offsets[i + 1]]; 0 for an empty run."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of a common 64-bit hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    base = np.uint64(0x9E3779B97F4A7C15)
    out = np.ones(max(1, n), np.uint64)
    have = 1
    step = base
    while have < n:  # doubling: powers of [have, 2 have) are those below times base ** have
        take = min(have, n - have)
        out[have : have + take] = out[:take] * step
        with np.errstate(over="ignore"):  # arithmetic modulo 2 ** 64
            step = step * step
        have *= 2
    return out


#: Longest word hashed as a polynomial with stored powers; longer words get further powers when they come.
_POWERS = _powers(4096)


def _powers_for(longest: int) -> np.ndarray:
    global _POWERS
    if longest > len(_POWERS):
        _POWERS = _powers(2 * longest)
    return _POWERS


#: Two different values of each byte.
_BYTES = [mixed(np.arange(1 + 256 * i, 257 + 256 * i, dtype=np.uint64)) for i in (0, 1)]


def word_spans(word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes for which ``word`` holds; a run ends with its text (``at``: offsets of the texts)."""
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    begin = at[:-1][np.diff(at) > 0]
    first[begin] = word[begin]
    begin = begin[begin > 0]
    last[begin - 1] = word[begin - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the spans of bytes, which are in order: equal for equal bytes, wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    cuts = np.empty(2 * len(starts), np.int64)
    cuts[0::2], cuts[1::2] = starts, ends
    sizes = np.diff(np.append(cuts, len(raw)))
    power = _powers_for(int(sizes.max()))[np.arange(cuts[0], len(raw)) - np.repeat(cuts, sizes)]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[0][raw[cuts[0] :]] * power, dtype=np.uint64)])
    return mixed(sums[ends - cuts[0]] - sums[starts - cuts[0]] + (ends - starts).astype(np.uint64))


def chunk_hashes(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each chunk of ``raw``; a chunk ends where the next one starts, the first at 0."""
    sizes = np.diff(np.append(starts, len(raw)))
    power = _powers_for(int(sizes.max()))[np.arange(len(raw)) - np.repeat(starts, sizes)]
    out = []
    for table in _BYTES:
        terms = table[raw] * power
        sums = np.add.reduceat(terms, starts)
        out.append(mixed(sums + sizes.astype(np.uint64)))
    return out[0], out[1]
