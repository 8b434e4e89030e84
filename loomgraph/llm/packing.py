"""Packing documents into training sequences of a fixed width.

Method: best-fit decreasing. A document longer than a window is first cut into full
windows. The rest, longest first, each go to the open window with the least room that is
enough, found by a segment tree indexed by remaining room. A task packs its documents in
runs of some four million tokens; a run's windows that are not nearly full are joined and
cut into full ones. What is left of that is packed with the next run, and in the end cut
at powers of two, which need no padding. Nothing is shuffled; no token leaves its task.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import ByteBPE

RUN = 4 << 20
#: A window with more than this part of its width free is joined with others of the kind.
LOOSE = 1 / 64
#: At most so many pieces of at most so many characters are remembered by a worker: some 150 MB.
MEMORY, REMEMBERED = 600_000, 32
#: Pieces longer than this are merged by a heap, in n log n steps.
LONG = 4_096

_APART = re.compile(r"(?<=\S) (?=\S)")


class Rooms:
    """Open windows by remaining room: a segment tree of counts over the rooms 0 .. width."""

    def __init__(self, width: int):
        self.size = 1 << (width + 1).bit_length()
        self.tree = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(width + 1)]

    def _add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.tree[at] += by
            at >>= 1

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, window) with the least room of `need` or more; None if there is none."""
        at = need + self.size
        while not self.tree[at]:
            while at & 1:  # a right child has nothing to its right under this parent
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.size:
            at = 2 * at if self.tree[2 * at] else 2 * at + 1
        room = at - self.size
        self._add(room, -1)
        return room, self.windows[room].pop()


def best_fit(lengths: list[int], width: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (index, start, length), each of at most width in all; every place of every index is in one of them."""
    windows = [[(i, at, width)] for i, n in enumerate(lengths) for at in range(0, n - width + 1, width)]
    rooms = Rooms(width)
    for i in sorted((i for i, n in enumerate(lengths) if n % width), key=lambda i: (-(lengths[i] % width), i)):
        n = lengths[i] % width
        found = rooms.take(n)
        if found is None:
            found = width, len(windows)
            windows.append([])
        windows[found[1]].append((i, lengths[i] - n, n))
        if found[0] > n:
            rooms.put(found[0] - n, found[1])
    return windows


def joined(windows: list[list[tuple[int, int, int]]], width: int, loose: float) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """(windows, rest): those with more than loose * width of room end to end, cut into full ones; the rest is shorter than a window. The fullest come first, so that what is cut is mostly what fits nowhere."""
    fill = [sum(n for _, _, n in w) for w in windows]
    out, rest, size = [w for w, f in zip(windows, fill) if width - f <= loose * width], [], 0
    for w, f in sorted(((w, f) for w, f in zip(windows, fill) if width - f > loose * width), key=lambda x: -x[1]):
        for i, at, n in w:
            while size + n >= width:
                out.append([*rest, (i, at, width - size)])
                at, n, rest, size = at + width - size, n - (width - size), [], 0
            if n:
                rest.append((i, at, n))
                size += n
    return out, rest


def powers(window: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The window's pieces, cut into sequences whose sizes are the powers of two that its own is the sum of."""
    rest = list(reversed(window))
    left = sum(n for _, _, n in window)
    while left:
        size, out = 1 << (left.bit_length() - 1), []
        left -= size
        while size:
            i, at, n = rest.pop()
            out.append((i, at, min(n, size)))
            if n > size:
                rest.append((i, at + size, n - size))
            size -= min(n, size)
        yield out


class Encoder:
    """Ids of whole texts as bytes (little-endian, 32 bits). A text is cut at single spaces between two other characters, where no match of the pattern can go on; words met again are answered from memory."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        ranks = {t: i for i, t in enumerate(tokens) if t}
        self.short = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.long: ByteBPE | None = None
        self.memory = _Words(self)

    def piece(self, text: str) -> bytes:
        if len(text) <= LONG:
            return np.array(self.short(text), dtype="<u4").tobytes()
        if self.long is None:
            self.long = ByteBPE(self.tokens, self.pattern)
        return self.long.encode(text).tobytes()

    def encode(self, text: str) -> bytes:
        words, look = text.split(" "), self.memory.__getitem__
        if len(words) == 1:
            return self.piece(text)
        try:
            if not words[0] or words[0][-1].isspace():
                raise _Joined
            return self.piece(words[0]) + b"".join(map(look, words[1:]))
        except _Joined:
            words = _APART.split(text)
            return self.piece(words[0]) + b"".join(self.piece(" " + w) if w[0].isspace() or w[-1].isspace() else look(w) for w in words[1:])


class _Joined(Exception):
    """A space beside other white space: no place to cut."""


class _Words(dict):
    """The ids of " " + word by word."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Joined
        ids = self.encoder.piece(" " + word)
        if len(word) <= REMEMBERED:
            if len(self) >= MEMORY:
                self.clear()
            self[word] = ids
        return ids


def read_vocabulary(path: str) -> list[bytes]:
    """The tokens of a byte-level JSON vocabulary by id, without its special ones. Bytes are written there as characters: printable ones as themselves, others in order from U+0100 on."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}
    special = {t["content"] for t in told["added_tokens"]}
    found = {i: bytes(byte[c] for c in t) for t, i in told["model"]["vocab"].items() if t not in special}
    return [found.get(i, b"") for i in range(max(found) + 1)]


@lru_cache(maxsize=2)
def _encoder(tokens: tuple[bytes, ...], pattern: str) -> Encoder:
    return Encoder(list(tokens), pattern)


def pack(docs: DataFrame, tokens: list[bytes], pattern: str, width: int = 2048, end: int = 1, keep_ids: bool = False) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece, and with keep_ids its ids.

    A document is its text's ids and then `end`; null and empty texts are `end` alone.
    Repeated rows are documents of their own, also without doc_id; other columns are not
    read. A sequence's number is its task's, then its own in the task: a run over the
    same files gives the same ones. The vocabulary is broadcast; the tokenizer bounds it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(tokens))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    last = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        task, number = TaskContext.get().partitionId() << 36, 0
        # Waiting pieces: (document, its start there, its ids, the document's tokens).
        wait: list[tuple[pa.Scalar, int, bytes, int]] = []
        held = 0

        def told(rows: list[tuple], ids: list[bytes]) -> pa.RecordBatch:
            columns = [pa.array([r[0] for r in rows], type_of), *(pa.array([r[j] for r in rows], pa.int64()) for j in range(1, len(names)))]
            if keep_ids:
                columns.append(pa.array([np.frombuffer(b, dtype="<u4").astype(np.int64) for b in ids], pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(columns, names + ["ids"] * keep_ids)

        def packed(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal wait, held, number
            found = best_fit([len(w[2]) // 4 for w in wait], width)
            full, rest = joined(found, width, LOOSE)
            rows, all_ids = [], []
            for sequence in [*full, *(powers(rest) if final else ())]:
                offset = 0
                for i, at, n in sequence:
                    doc, start, ids, whole = wait[i]
                    part = ids[4 * at : 4 * (at + n)]
                    rows.append((doc, start + at, n, zlib.crc32(part), whole, task + number, offset))
                    all_ids.append(part)
                    offset += n
                number += 1
                if len(rows) >= 4_096:
                    yield told(rows, all_ids)
                    rows, all_ids = [], []
            if rows:
                yield told(rows, all_ids)
            wait = [(wait[i][0], wait[i][1] + at, wait[i][2][4 * at : 4 * (at + n)], wait[i][3]) for i, at, n in rest]
            held = sum(n for _, _, n in rest)

        type_of = None
        for b in batches:
            type_of = b.schema.field(0).type
            for doc, text in zip(b.column(0), b.column(1)):
                ids = encoder.encode(text.as_py() or "") + last
                wait.append((doc.as_py(), 0, ids, len(ids) // 4))
                held += len(ids) // 4
                if held >= RUN:
                    yield from packed(False)
        if wait:
            yield from packed(True)

    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names[1:])
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", ids array<long>" if keep_ids else ""))


def sequences(pieces: DataFrame, width: int = 2048, pad: int = 0) -> DataFrame:
    """Pieces with ids -> sequence_id, ids, lengths: whole sequences, padded to the width unless their size is a power of two, and the sizes of their pieces, between which no attention goes. A sequence's pieces are at most its width."""
    rows = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    ids, size = F.flatten(F.col("p.ids")), F.aggregate("p.length", F.lit(0).cast("long"), lambda a, n: a + n)
    rows = rows.select("sequence_id", ids.alias("ids"), size.alias("size"), F.col("p.length").alias("lengths"))
    missing = F.when(F.bit_count("size") == 1, 0).otherwise(width - F.col("size")).cast("int")
    return rows.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad).cast("long"), missing)).alias("ids"), "lengths")
