"""Operator 7: SentencePiece encoding and decoding for merge-type vocabularies.

Adjacent symbol pairs wait in an agenda ordered by score, leftmost first on ties; the best pair is merged and its new
neighbours join the agenda. No vocabulary entry has a space mark after another character, so a merge never crosses the
start of a run of space marks: texts are cut there and each different chunk is solved once per worker. The agendas of many
chunks are the rows of a matrix, which all take their best pair at once; those of a few, and of long ones, are lists and heaps.
The sentencepiece library supplies the vocabulary and the normaliser, and checks every Arrow batch: what the batch brought that is new to the
worker is encoded and decoded by the library too, in one text, and a difference fails the task. Chunks that the library can't be given in one text
are checked alone, and those that it can't be given alone with their whole texts.

Cases: a null text counts as empty; an empty text has only begin and end ids; rows and ids may repeat, each row is
encoded on its own; an empty table gives an empty table; other columns are ignored. Unknown characters become byte pieces.
"""

from __future__ import annotations

import gc
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from briefwright.llm.common import column

SPACE = "▁"
#: Chunks, and bytes of them, that a generation of a worker's memory holds; then the generation before it is forgotten, and what is met
#: again moves to the new one. A bound of memory only: results don't depend on it.
REMEMBERED, REMEMBERED_BYTES = 100_000, 24 << 20
#: Longer chunks, as whole paragraphs of texts without spaces, are hardly met twice and are not remembered.
LONG = 64
#: Characters of texts that are encoded together and then checked, so that what is held for them stays small.
TOGETHER = 1 << 18
#: Chunks of up to so many characters have a list or a row as agenda, from MANY of them on a row; NEVER is no rank.
SHORT, MANY, NEVER = 48, 256, 1 << 60
#: Widths of the matrices of agendas; PAD fills a row, a symbol has BITS bits, a character that is no entry is numbered behind the entries.
WIDTHS, PAD, BITS = (6, 9, 12, 16, 24, SHORT), (1 << 22) - 1, 22
#: Chunks that the library is given in one text for the check.
JOINED = 64
_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    """The vocabulary of a model file and what a worker has solved so far."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        self.piece = [self.library.id_to_piece(i) for i in range(n)]
        special = [self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) for i in range(n)]
        self.id = {p: i for i, p in enumerate(self.piece) if not special[i]}
        score = {p: self.library.get_score(i) for p, i in self.id.items()}
        place = {v: r for r, v in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {p: place[v] for p, v in score.items()}
        self.byte = {int(self.piece[i][3:5], 16): i for i in range(n) if self.library.is_byte(i)}
        self.unknown, self.begin, self.end = self.library.unk_id(), self.library.bos_id(), self.library.eos_id()
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("a vocabulary entry holds a space mark after another character")
        value = {v: bytes([k]) for k, v in self.byte.items()}
        self.bytes = [value.get(i, b"" if special[i] else self.piece[i].replace(SPACE, " ").encode()) for i in range(n)]
        self.is_byte = [i in value for i in range(n)]
        self.bytes[self.unknown] = " ⁇ ".encode()
        self.packed = [np.array([i], "<u4").tobytes() for i in range(n)]
        self.known = {p: self.packed[i] for p, i in self.id.items()}
        #: a line break stands alone if no entry joins it to anything
        self.alone = not any("\n" in p and len(p) > 1 for p in self.id)
        self.n_bytes = np.array([len(b) for b in self.bytes])
        #: packed ids by chunk; what has been solved since the last check, and its ids
        self.memory: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.fresh: list[str] = []
        self.fresh_ids: list[bytes] = []
        self.used = 0
        self.edge = [self.packed[i] if i >= 0 else b"" for i in (self.begin, self.end)]
        self.tables: tuple[np.ndarray, ...] | None = None

    def merged(self, chunk: str) -> list[str]:
        """Symbols of a chunk after all merges. The agenda of a short chunk is a list that is searched for its best entry,
        that of a long one a heap; a rank is a place in the order of scores, so equal scores have equal ranks."""
        return self._short(chunk) if len(chunk) <= SHORT else self._long(chunk)

    def _short(self, chunk: str) -> list[str]:
        symbols, rank = list(chunk), self.rank.get
        agenda = [rank(a + b, NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda and (best := min(agenda)) < NEVER:
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = rank(symbols[i] + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = rank(symbols[i - 1] + symbols[i], NEVER)
        return symbols

    def _long(self, chunk: str) -> list[str]:
        symbols, n, rank = list(chunk), len(chunk), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(r, i) for i, p in enumerate(map(str.__add__, symbols, symbols[1:])) if (r := rank(p)) is not None]
        heapify(agenda)
        while agenda:
            r, i = heappop(agenda)
            left, j = symbols[i], after[i]
            if not left or j >= n or rank(left + symbols[j]) != r:
                continue  # a neighbour was merged meanwhile; the pair that stands there now has an entry of its own
            symbols[i] = left = left + symbols[j]
            symbols[j] = ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(left + symbols[k])) is not None:
                    heappush(agenda, (r, i))
            if (h := before[i]) >= 0 and (r := rank(symbols[h] + left)) is not None:
                heappush(agenda, (r, h))
        return [s for s in symbols if s]

    def solve(self, chunk: str) -> bytes:
        """Packed ids of a chunk."""
        ids = []
        for symbol in self.merged(chunk):
            if (one := self.known.get(symbol)) is None:
                one = b"".join([self.packed[self.byte[b]] for b in symbol.encode()]) if self.byte else self.packed[self.unknown]
            ids.append(one)
        return b"".join(ids)

    def texts(self, packed: list[bytes]) -> list[bytes]:
        """What each of these packed ids decodes to, with the space of its first piece."""
        ids = np.frombuffer(b"".join(packed), "<u4")
        joined = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        at = np.concatenate([[0], np.cumsum(self.n_bytes[ids])])[np.cumsum([0, *[len(p) // 4 for p in packed]])].tolist()
        return [joined[i:j] for i, j in zip(at, at[1:], strict=False)]

    def _number(self) -> None:
        """What the matrices need: an entry has its id as symbol, other characters follow; the pairs that may be merged are sorted."""
        n = len(self.piece)
        symbol = np.arange(n, n + 0x110000, dtype=np.int32)
        for p, i in self.id.items():
            if len(p) == 1:
                symbol[ord(p)] = i
        number = lambda p: self.id.get(p, n + ord(p) if len(p) == 1 else None)
        keys, values = array("q", [PAD << BITS | PAD]), array("q", [NEVER])
        for p, i in self.id.items():
            for k in range(1, len(p)):
                if (left := number(p[:k])) is not None and (right := number(p[k:])) is not None:
                    keys.append(left << BITS | right)
                    values.append(self.rank[p] << BITS | i)
        order = np.argsort(keys)
        keys, values = np.array(keys)[order], np.array(values)[order]
        self.tables = (symbol, keys, values, np.array([self.byte.get(k, self.unknown) for k in range(256)]))

    def _values(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank, and behind it the merged symbol, of pairs of symbols; NEVER if they don't merge."""
        _, keys, values, *_ = self.tables
        key = left << BITS | right
        at = np.searchsorted(keys, key)
        return np.where(keys[at] == key, values[at], NEVER)

    def _rows(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All merges of many chunks. In every round each chunk that has a pair left merges its best one, leftmost on ties, so all rows
        stay of one length. Returns the places of the chunks in the order they were done, their numbers of symbols, and the symbols."""
        length = np.array([len(c) for c in chunks])
        width = int(length.max())
        symbols = np.full((len(chunks), width), PAD, np.int64)
        symbols[np.arange(width) < length[:, None]] = self.tables[0][np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4")]
        agenda = self._values(symbols[:, :-1], symbols[:, 1:])
        who, done = np.arange(len(chunks)), []
        while width > 1:
            rows = np.arange(len(who))
            at = (agenda >> BITS).argmin(1)
            best = agenda[rows, at]
            go = best < NEVER
            if not go.all():
                done.append((who[~go], symbols[~go]))
                who, symbols, agenda, at, best = who[go], symbols[go], agenda[go], at[go], best[go]
                if not len(who):
                    break
                rows = np.arange(len(who))
            symbols[rows, at] = best & PAD
            keep = np.ones(symbols.shape, bool)
            keep[rows, at + 1] = False
            width -= 1
            symbols, agenda = symbols[keep].reshape(len(rows), width), agenda[keep[:, 1:]].reshape(len(rows), width - 1)
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < width - 1)
            row, pair = np.concatenate([left, right]), np.concatenate([at[left] - 1, at[right]])
            agenda[row, pair] = self._values(symbols[row, pair], symbols[row, pair + 1])
        else:
            done.append((who, symbols))
        return (np.concatenate([w for w, _ in done]), np.concatenate([(s != PAD).sum(1) for _, s in done]),
                np.concatenate([s[s != PAD] for _, s in done]))

    def solve_many(self, chunks: list[str]) -> None:
        """As ``solve`` of each chunk, into the memory."""
        short = sorted([c for c in chunks if 0 < len(c) <= SHORT], key=len)
        single = chunks if len(short) < MANY else [c for c in chunks if not 0 < len(c) <= SHORT]
        self._keep(single, [self.solve(c) for c in single])
        if len(short) < MANY:
            return
        if self.tables is None:
            self._number()
        first = 0
        for width in WIDTHS:
            last = bisect_right(short, width, lo=first, key=len)
            if last == first:
                continue
            group, first = short[first:last], last
            order, count, symbols = self._rows(group)
            ids, each = symbols, np.ones(len(symbols), np.int64)
            raw = symbols >= len(self.piece)
            if raw.any():  # characters that are no entry become bytes, or the unknown entry
                text = "".join(map(chr, (symbols[raw] - len(self.piece)).tolist()))
                if self.byte:
                    each[raw] = [len(ch.encode()) for ch in text]
                ids = np.repeat(symbols, each)
                ids[np.repeat(raw, each)] = self.tables[3][np.frombuffer(text.encode(), np.uint8)] if self.byte else self.unknown
            packed = ids.astype("<u4").tobytes()
            place = (np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(count)])] * 4).tolist()
            self._keep([group[k] for k in order.tolist()], [packed[i:j] for i, j in zip(place, place[1:], strict=False)])

    def _keep(self, chunks: list[str], ids: list[bytes]) -> None:
        self.memory.update(zip(chunks, ids, strict=True))
        self.fresh += chunks
        self.fresh_ids += ids
        self.used += 200 * len(chunks) + 6 * sum(map(len, chunks)) + sum(map(len, ids))

    def learn(self, chunks: set[str]) -> list[str]:
        """Puts all chunks into the memory and returns those that should not stay there: long ones, and such of several lines."""
        memory, old = self.memory, self.old
        new = [c for c in chunks if c not in memory]
        lines = {c: re.findall("\n|[^\n]+", c) for c in new if "\n" in c and len(c) > 1} if self.alone else {}
        if lines:
            new = [p for p in {*new, *[p for parts in lines.values() for p in parts]} if p not in lines and p not in memory]
        again = {c: ids for c in new if (ids := old.get(c)) is not None} if old else {}
        memory.update(again)
        self.used += 200 * len(again) + sum([6 * len(c) + len(ids) for c, ids in again.items()])
        self.solve_many([c for c in new if c not in again] if again else new)
        for c, parts in lines.items():
            memory[c] = b"".join([memory[p] for p in parts])
        long = [c for c in new if len(c) > LONG]
        self.used -= sum([200 + 6 * len(c) + len(memory[c]) for c in long])
        return [*long, *lines]

    def check(self, texts: list[str], done: list[tuple[bytes, bytes]]) -> None:
        """Compares all chunks solved since the last check, of these texts, with the library's encoder and decoder."""
        rows = [(c, i) for c, i in zip(self.fresh, self.fresh_ids, strict=True) if c]
        self.fresh, self.fresh_ids = [], []
        # a mark in front is what the normaliser adds; a chunk from inside a line follows a line break, which stands alone
        words, inside, other = [], [], []
        for row in rows:
            (inside if row[0][0] != SPACE else other if row[0][1:2] in ("", SPACE) else words).append(row)
        whole = bool(inside) and not self.alone
        if whole:
            other += inside
            inside = []
        for some, in_line in ((words, True), (inside, False)):
            other += self._differ(some, in_line)
        if other:
            whole |= self._differ_alone(other)
        if whole:
            for text, (i, d), ids in zip(texts, done, self.library.encode(texts, add_bos=True, add_eos=True, num_threads=1), strict=True):
                if np.array(ids, "<u4").tobytes() != i or self.library.decode(ids).encode() != d:
                    raise ValueError(f"the library encodes or decodes otherwise: {text[:80]!r}")

    def _differ(self, rows: list[tuple[str, bytes]], in_line: bool) -> list[tuple[str, bytes]]:
        """Gives the library JOINED chunks in one text each, as nothing is merged across the start of a chunk with a mark or across a line
        break that stands alone. Returns the chunks of the texts that it encodes or decodes otherwise, and those whose ids are not as long as they."""
        if not rows:
            return []
        sizes = [len(i) // 4 for _, i in rows]
        ends = np.concatenate([[0], np.cumsum(self.n_bytes[np.frombuffer(b"".join([i for _, i in rows]), "<u4")])])[np.cumsum([0, *sizes])]
        if np.diff(ends).tolist() != [len(c.encode()) - 2 * c.count(SPACE) for c, _ in rows]:
            return rows
        groups = [rows[k : k + JOINED] for k in range(0, len(rows), JOINED)]
        if in_line:
            given = [" ".join([c[1:] for c, _ in g]) for g in groups]
            want = [b"".join([i for _, i in g]) for g in groups]
        else:
            line, lead = self.solve("\n"), array("I", self.library.encode("\n")).tobytes()
            given = ["\n" + "\n".join([c for c, _ in g]) for g in groups]
            want = [lead + line.join([i for _, i in g]) for g in groups]
        found = self.library.encode(given, num_threads=1)
        back = self.library.decode(found, num_threads=1)
        return [row for g, ids, text, w, own in zip(groups, found, back, want, self.texts(want), strict=True)
                if array("I", ids).tobytes() != w or text.encode() != own[own[:1] == b" " :] for row in g]

    def _differ_alone(self, rows: list[tuple[str, bytes]]) -> bool:
        """Gives the library each chunk alone and fails on a difference; true if it took a chunk for another one."""
        library, whole = self.library, False
        before = array("I", library.encode("\n")).tobytes()
        given = [c[1:].replace(SPACE, " ") if c[0] == SPACE else "\n" + c for c, _ in rows]
        found = library.encode(given, num_threads=1)
        back = library.decode(found, num_threads=1)
        own = self.texts([i for _, i in rows])
        for (c, i), t, ids, text, d in zip(rows, given, found, back, own, strict=True):
            prefix, lead = (b"", "") if c[0] == SPACE else (before, SPACE + "\n")
            d = b"\n" + d if prefix else d
            if array("I", ids).tobytes() == prefix + i and text.encode() == d[d[:1] == b" " :]:
                continue
            if library.normalize(t) == lead + c:
                raise ValueError(f"the library encodes or decodes otherwise: {c[:80]!r}")
            whole = True  # alone, the chunk is another one
        return whole

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """Ids (little-endian, unsigned, 32 bits) with begin and end ids, and the text they decode to."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """As ``encode`` of each text."""
        if len(self.memory) > REMEMBERED or self.used > REMEMBERED_BYTES:
            self.old, self.memory, self.used = self.memory, {}, 0
        cut = [_RUNS.findall(self.library.normalize(t)) for t in texts]
        passing = self.learn(set().union(*cut))
        find, (begin, end) = self.memory.__getitem__, self.edge
        packed = [b"".join([begin, *map(find, chunks), end]) for chunks in cut]
        for chunk in passing:
            del self.memory[chunk]
        return [(i, d[d[:1] == b" " :]) for i, d in zip(packed, self.texts(packed), strict=True)]

    def decode(self, ids) -> str:
        """The text of any ids: control ids are nothing, runs of byte pieces are read as UTF-8, a wrong byte is U+FFFD,
        and the space of the first piece is the one that the normaliser added."""
        out, run, first = [], b"", True
        for i in ids:
            if self.is_byte[i]:
                run += self.bytes[i]
                first = False
                continue
            if run:
                out.append(_utf8(run))
                run = b""
            piece = self.bytes[i].decode()
            if piece and first:
                piece, first = piece.removeprefix(" ") if i != self.unknown else piece, False
            out.append(piece)
        return "".join([*out, _utf8(run)])


def _utf8(run: bytes) -> str:
    out, i = [], 0
    while i < len(run):
        lead = run[i]
        size = 1 if lead < 0x80 else 2 if lead >> 5 == 6 else 3 if lead >> 4 == 14 else 4 if lead >> 3 == 30 else 1
        try:
            out.append(run[i : i + size].decode())
        except UnicodeDecodeError:
            out.append("�")
            size = 1
        i += size
    return "".join(out)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """(id, n_tokens, ids, decoded) per row: ids as little-endian unsigned 32-bit integers with begin and end ids, and the
    text that they decode to. ``check`` compares each Arrow batch with the library and fails on a difference."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        gc.disable()  # the memory is many small objects without cycles, which would be gone through again and again
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                done, first_open, size = [], 0, 0
                for k, text in enumerate(texts, 1):
                    size += len(text)
                    if size >= TOGETHER or k == len(texts):
                        some = texts[first_open:k]
                        done += (found := model.encode_all(some))
                        if check:
                            model.check(some, found)
                        model.fresh, model.fresh_ids = [], []
                        first_open, size = k, 0
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(i) // 4 for i, _ in done], pa.int64()), pa.array([i for i, _ in done], pa.binary()),
                     pa.array([d for _, d in done], pa.binary()).cast(pa.string())], names=["id", "n_tokens", "ids", "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(column(id_col).alias("id"), column(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_tokens long, ids binary, decoded string").withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) per row of packed ids, for any ids of the vocabulary; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            texts = [model.decode(np.frombuffer(i or b"", "<u4").tolist()) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(column(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return encoded.select(id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
