"""Operator 9: token ids as files of patched frame-of-reference blocks.

Documents are range-partitioned and sorted by id; each partition encodes its texts and streams the ids, a document's end id
included, into one file. A file holds blocks of ``block`` ids: the block's minimum is subtracted, the rest is packed at the
width that fits the chosen percentile, wider values go to a list of exceptions. Block starts and documents are indexed at the
end of the file, so any run of ids can be read without the blocks before it. A file is written under a name of its attempt and
moved when it is whole, so a task that is run again leaves the same file.

Layout (little-endian): magic, blocks, documents as an Arrow stream (id, n), block starts (uint64), footer. A block: n, minimum,
number of exceptions (uint32), width (uint8), packed bits, positions (uint32) and values (uint32) of the exceptions.

Cases: a null text counts as empty; an empty text has only its end id; rows with the same id stay next to each other, in the
order of their texts' hashes; null ids come first; an empty table leaves no file and reads as an empty table; other columns are ignored.
Texts run through the tokenizers library by chunks of a run of white space and a word, which its pre-tokenizer never joins; each
different chunk is encoded once per worker. A text with unusual white space or with an added token goes through it whole.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from briefwright.llm.common import chunk_hashes, column, steps

MAGIC = b"PFOR0001"
FOOTER = struct.Struct("<QQQQQQ8s")  # ids, blocks, ids of a block, place of the block starts, place and length of the documents
HEAD = struct.Struct("<IIIB")
#: Chunks that a worker remembers; then it starts anew. A bound of memory only: results don't depend on it.
REMEMBERED = 3_000_000
#: Unusual white space; texts that hold it aren't cut.
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, others follow 255.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_VISIBLE = {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
#: Bytes: 1 white space, 2 ASCII letters, 3 stop and comma, 4 the first bytes of what may be unusual white space.
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 10, 13, 32]] = 1
_KIND[65:91] = _KIND[97:123] = 2
_KIND[[44, 46]] = 3
_KIND[[11, 12, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3]] = 4


class Chunks:
    """Encodes batches of texts. A chunk's ids are kept by two hashes of its bytes, in arrays sorted by the first."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.model = self.library.model
        self.added = re.compile("|".join(map(re.escape, added)).encode() or rb"(?!)")
        self._forget()

    def _forget(self) -> None:
        self.keys, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.place, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 20, np.uint32), 0

    def _cuts(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Starts of the chunks: before white space that follows something else, and between a letter and a stop or comma."""
        kind = _KIND[raw]
        cut = np.zeros(len(raw), bool)
        cut[1:] = ((kind[1:] == 1) & (kind[:-1] != 1)) | ((kind[1:] == 3) & (kind[:-1] == 2))
        for row in np.unique(np.searchsorted(at, np.flatnonzero(kind == 4), "right") - 1):
            if _ODD_SPACE.search(raw[at[row] : at[row + 1]].tobytes().decode()):
                cut[at[row] : at[row + 1]] = False
        for hit in self.added.finditer(raw.tobytes()):
            row = np.searchsorted(at, hit.start(), "right") - 1
            cut[at[row] : at[row + 1]] = False
        cut[at[:-1][np.diff(at) > 0]] = True
        return np.flatnonzero(cut)

    def _ids(self, texts: list[bytes]) -> list[list[int]]:
        """Ids of chunks. Letters after at most one space are one piece to the pre-tokenizer, so they go to its model at once."""
        ids: list[list[int] | None] = []
        for text in texts:
            core = text.decode().removeprefix(" ")
            if core.isalpha() and (core.isascii() or max(core) < "ɐ"):
                ids.append([t.id for t in self.model.tokenize(text.decode("latin-1").translate(_VISIBLE))])
            else:
                ids.append(None)
        rest = iter(self.library.encode_batch_fast([t.decode() for t, i in zip(texts, ids, strict=True) if i is None], add_special_tokens=False))
        return [next(rest).ids if i is None else i for i in ids]

    def _learn(self, keys: np.ndarray, second: np.ndarray, texts: list[bytes]) -> None:
        ids = self._ids(texts)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        n = int(size.sum())
        while self.used + n > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        self.pool[self.used : self.used + n] = np.fromiter(chain.from_iterable(ids), np.uint32, n)
        at = np.searchsorted(self.keys, keys)
        self.place = np.insert(self.place, at, self.used + np.cumsum(size) - size)
        self.keys, self.second, self.size = np.insert(self.keys, at, keys), np.insert(self.second, at, second), np.insert(self.size, at, size)
        self.used += n

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, given as bytes and offsets, and how many each text has."""
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(at) - 1, np.int64)
        starts = self._cuts(raw, at)
        ends = np.append(starts[1:], len(raw))
        first, second = chunk_hashes(raw, starts)
        keys, where, back = np.unique(first, return_index=True, return_inverse=True)
        if (second[where][back] != second).any():  # two chunks with one hash: no chunk of this batch is shared
            return self._one_by_one(raw, at)
        try:
            slot = self._slots(keys, second[where])
        except _Clash:
            return self._one_by_one(raw, at)
        if (new := np.flatnonzero(slot < 0)).size:
            if len(self.keys) + len(new) > REMEMBERED or self.used > 8 * REMEMBERED:
                self._forget()
                new = np.arange(len(keys))
            data, i = raw.tobytes(), where[new]
            self._learn(keys[new], second[i], [data[a:b] for a, b in zip(starts[i].tolist(), ends[i].tolist(), strict=True)])
            slot = self._slots(keys, second[where])
        slot = slot[back]
        size = self.size[slot]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.arange(total[-1]) + np.repeat(self.place[slot] - total[:-1], size)]
        return ids, np.diff(total[np.searchsorted(starts, at)])

    def _slots(self, keys: np.ndarray, second: np.ndarray) -> np.ndarray:
        slot = np.searchsorted(self.keys, keys)
        if not len(self.keys):
            return np.full(len(keys), -1)
        near = np.minimum(slot, len(self.keys) - 1)
        known = self.keys[near] == keys
        if (known & (self.second[near] != second)).any():
            raise _Clash
        return np.where(known, near, -1)

    def _one_by_one(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = raw.tobytes()
        ids = [e.ids for e in self.library.encode_batch_fast([data[a:b].decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], add_special_tokens=False)]
        return np.array(list(chain.from_iterable(ids)), np.uint32), np.array(list(map(len, ids)), np.int64)


class _Clash(Exception):
    """A chunk has the first hash of another one."""


@lru_cache(maxsize=2)
def chunks_of(path: str) -> Chunks:
    return Chunks(path)


def pack_block(ids: np.ndarray, percentile: float) -> bytes:
    """One block: minimum, packed differences at the width of the percentile, exceptions."""
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype("<u4")
    width = int(np.partition(rest, k := min(len(rest) - 1, int(percentile * len(rest))))[k]).bit_length()
    wide = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    bits = np.unpackbits(rest.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return b"".join([HEAD.pack(len(ids), low, len(wide), width), np.packbits(bits.reshape(-1), bitorder="little").tobytes(),
                     wide.astype("<u4").tobytes(), rest[wide].tobytes()])


def unpack_block(data: bytes) -> np.ndarray:
    n, low, wide, width = HEAD.unpack_from(data)
    size = (n * width + 7) // 8
    bits = np.zeros((n, 32), np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8, size, HEAD.size), count=n * width, bitorder="little").reshape(n, width)
    rest = np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(n)
    at = HEAD.size + size
    rest[np.frombuffer(data, "<u4", wide, at)] = np.frombuffer(data, "<u4", wide, at + 4 * wide)
    return rest + np.uint32(low)


class _Writer:
    def __init__(self, out, block: int, percentile: float):
        self.out, self.block, self.percentile = out, block, percentile
        self.rest, self.n, self.starts, self.docs = np.zeros(0, np.uint32), 0, [], []
        out.write(MAGIC)

    def add(self, docs: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.docs.append(pa.record_batch([docs, pa.array(counts, pa.int64())], names=["id", "n"]))
        self.rest = np.concatenate([self.rest, ids])
        self._flush(len(self.rest) // self.block * self.block)

    def _flush(self, n: int) -> None:
        ids = self.rest[:n]
        for at in range(0, n, self.block):
            self.starts.append(self.out.tell())
            self.out.write(pack_block(ids[at : at + self.block], self.percentile))
        self.rest, self.n = self.rest[n:].copy(), self.n + n

    def close(self) -> int:
        self._flush(len(self.rest))
        docs_at, sink = self.out.tell(), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.docs[0].schema) as stream:
            for batch in self.docs:
                stream.write_batch(batch)
        docs = sink.getvalue()
        self.out.write(docs)
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(FOOTER.pack(self.n, len(self.starts), self.block, docs_at + docs.size, docs_at, docs.size, MAGIC))
        return self.n


class TokenFile:
    """One file, read by blocks."""

    def __init__(self, uri: str):
        system, path = pafs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        self.n, self.blocks, self.block, at, docs_at, docs_size, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token file")
        starts = np.frombuffer(self.file.read_at(8 * self.blocks, at), "<u8").astype(np.int64)
        self.starts = np.append(starts, docs_at)
        self._docs = docs_at, docs_size

    def docs(self) -> pa.Table:
        """Documents in order: id, n."""
        return pa.ipc.open_stream(self.file.read_at(self._docs[1], self._docs[0])).read_all()

    def ids(self, first: int, n: int) -> np.ndarray:
        """A run of ids; only the blocks that hold it are read."""
        if n <= 0:
            return np.zeros(0, "<u4")
        a, b = first // self.block, (first + n - 1) // self.block + 1
        data = self.file.read_at(int(self.starts[b] - self.starts[a]), int(self.starts[a]))
        cuts = self.starts[a : b + 1] - self.starts[a]
        found = np.concatenate([unpack_block(data[x:y]) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)])
        return found[first - a * self.block :][:n]


def write(df: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", block: int = 4096, percentile: float = 0.95) -> int:
    """Writes the files of ``df`` into ``folder`` (a URI that all executors see) in ascending order of id; the number of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, task = chunks_of(tokenizer), TaskContext.get()
        system, path = pafs.FileSystem.from_uri(folder)
        name, out, writer = f"part-{task.partitionId():08d}.tokens", None, None
        for batch in batches:
            for first, end, raw, at in steps(batch.column(1), 1 << 22):
                if writer is None:
                    out = system.open_output_stream(f"{path}/_{name}.{task.taskAttemptId()}")
                    writer = _Writer(out, block, percentile)
                ids, counts = chunks.encode(raw, at)
                writer.add(batch.column(0).slice(first, end - first), np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1)
        if writer is not None:
            n = writer.close()
            out.close()
            system.move(f"{path}/_{name}.{task.taskAttemptId()}", f"{path}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    system, path = pafs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)  # shared by all; an empty table leaves it empty
    rows = df.select(column(id_col).alias("id"), column(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h").drop("h")
    return rows.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read(spark: SparkSession, folder: str, id_type: str = "long", id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids) per document of all files: ``start`` counts the ids before it, ``ids`` are packed."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.tokens").schema("path string, modificationTime timestamp, length long, content binary").load(folder).select("path")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([p.rsplit("/", 1)[1] for p in paths]), pa.array([TokenFile(p).n for p in paths], pa.int64())], names=["name", "n"])

    # one number per file: as many as the tasks that wrote them
    starts, total = {}, 0
    for name, n in sorted(map(tuple, files.mapInArrow(totals, "name string, n long").collect())):
        starts[name] = total
        total += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                file = TokenFile(uri)
                docs = file.docs().combine_chunks()
                counts = docs.column(1).to_numpy()
                ends = np.cumsum(counts)
                first, n = 0, len(counts)
                while first < n:  # about a million ids, or one longer document, at a time
                    begin = int(ends[first] - counts[first])
                    end = min(n, max(first + 1, int(np.searchsorted(ends, begin + (1 << 20), "right"))))
                    ids = file.ids(begin, int(ends[end - 1]) - begin)
                    cuts = np.concatenate([[0], ends[first:end] - begin])
                    packed = [ids[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [docs.column(0).slice(first, end - first).combine_chunks(), pa.array(starts[uri.rsplit("/", 1)[1]] + begin + cuts[:-1], pa.int64()),
                         pa.array(counts[first:end], pa.int64()), pa.array(packed, pa.binary())], names=["id", "start", "n_tokens", "ids"])
                    first = end

    return files.mapInArrow(run, f"id {id_type}, start long, n_tokens long, ids binary").withColumnRenamed("id", id_col)
