"""Byte-level BPE: encode whole texts by a table of merge ranks, and decode the ids.

Method: two tiers. A minimal perfect hash over the vocabulary answers a pre-token that
is itself a token, with one probe and one comparison. Any other pre-token is merged by
a heap over a linked list of its bytes, in n log n steps, so a pre-token of a million
bytes is no trap. Pre-tokens met again are answered from a bounded memory.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import lean

#: At most so many pre-tokens of at most so many characters are remembered by a worker, with their ids as bytes: some 120 MB.
MEMORY, REMEMBERED = 600_000, 32
#: What a worker keeps of them when a task ends: Spark goes on using it for other work, which needs the room.
KEPT = 100_000
BLOCK = 100_000


class PerfectHash:
    """Hash and displace: n keys to 0 .. n-1. Buckets of several keys, largest first, take the first displacement that puts all on free places; single keys take what is left."""

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n // 3)
        rows: list[list[tuple[int, int]]] = [[] for _ in range(self.buckets)]
        for i, key in enumerate(keys):
            h = xxhash.xxh3_128_intdigest(key)
            rows[(h & 0xFFFFFFFF) % self.buckets].append((h >> 32, i))
        self.shift = [0] * self.buckets
        self.at = [-1] * self.n
        order = sorted(range(self.buckets), key=lambda b: -len(rows[b]))
        free = self.n - 1
        for b in order:
            if len(rows[b]) > 1:
                d = 0
                while True:
                    places = [self._place(h, d) for h, _ in rows[b]]
                    if len(set(places)) == len(places) and all(self.at[p] < 0 for p in places):
                        break
                    d += 1
                self.shift[b] = d
                for p, (_, i) in zip(places, rows[b]):
                    self.at[p] = i
            elif rows[b]:
                while self.at[free] >= 0:
                    free -= 1
                self.at[free] = rows[b][0][1]
                self.shift[b] = -1 - free

    def _place(self, h: int, d: int) -> int:
        return ((h & 0xFFFFFFFF) + d * ((h >> 32 & 0xFFFFFFFF) | 1) + (h >> 64) * (d >> 16)) % self.n

    def index(self, key: bytes) -> int:
        """The key's index in the given list; of any other key, some index or other."""
        h = xxhash.xxh3_128_intdigest(key)
        d = self.shift[(h & 0xFFFFFFFF) % self.buckets]
        return self.at[-1 - d if d < 0 else self._place(h >> 32, d)]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: always the lowest rank first, leftmost on ties."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    get = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        j = after[i]
        if j <= i or j >= n or after[j] != end:
            continue
        after[i] = end
        after[j] = -1
        if end < n:
            before[end] = i
            if (r := get(piece[i : after[end]])) is not None:
                heappush(heap, (r, i, after[end]))
        if (p := before[i]) >= 0 and (r := get(piece[p:end])) is not None:
            heappush(heap, (r, p, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class _Memory(dict):
    def __init__(self, find: Callable[[str], bytes]):
        self.find = find

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMORY:
            self.clear()
        ids = self.find(piece)
        if len(piece) <= REMEMBERED:
            self[piece] = ids
        return ids


class ByteBPE:
    def __init__(self, tokens: list[bytes], pattern: str):
        """tokens[i] is the bytes of id i; ids are ranks."""
        self.tokens = tokens
        self.ranks = {t: i for i, t in enumerate(tokens) if t}
        self.ids = [i for i, t in enumerate(tokens) if t]
        self.words = PerfectHash([tokens[i] for i in self.ids])
        self.pattern = regex.compile(pattern)
        self.memory = _Memory(self._find)

    def _find(self, piece: str) -> bytes:
        b = piece.encode("utf-8", "replace")
        i = self.ids[self.words.index(b)]
        return np.array([i] if self.tokens[i] == b else merge(b, self.ranks), dtype="<u4").tobytes()

    def forget(self) -> None:
        """Only the KEPT pieces found first, among them the frequent ones, stay in memory."""
        if len(self.memory) > KEPT:
            kept = dict(islice(self.memory.items(), KEPT))
            self.memory = _Memory(self._find)
            self.memory.update(kept)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of the whole text as unsigned 32-bit integers; none for null or empty text."""
        if not text:
            return np.empty(0, dtype="<u4")
        look = self.memory.__getitem__
        if len(text) <= 1 << 20:
            return np.frombuffer(b"".join(map(look, self.pattern.findall(text))), dtype="<u4")
        found, parts = self.pattern.finditer(text), []
        while block := [m[0] for m in islice(found, BLOCK)]:
            parts.append(b"".join(map(look, block)))
        return np.frombuffer(b"".join(parts), dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        look = self.tokens.__getitem__
        return b"".join(b"".join(map(look, ids[i : i + (1 << 20)].tolist())) for i in range(0, len(ids), 1 << 20))


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token, rank), in the order of their ranks. The file belongs to the installation; its size is that of the vocabulary."""
    with open(path, "rb") as f:
        found = {int(r): base64.b64decode(t) for t, r in map(bytes.split, f) if t}
    return [found.get(i, b"") for i in range(max(found) + 1)]


@lru_cache(maxsize=2)
def _tokenizer(tokens: tuple[bytes, ...], pattern: str) -> ByteBPE:
    return ByteBPE(list(tokens), pattern)


def encode_decode(docs: DataFrame, tokens: list[bytes], pattern: str, keep_ids: bool = False) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, n_tokens, ids_sha256, decoded_sha256, and with keep_ids also ids and decoded (binary).

    Null and empty texts have no ids and the digests of nothing. Each row stands for
    itself; other columns are not read. The vocabulary is broadcast: its size is fixed
    by the tokenizer, not by the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _tokenizer(shared.value, pattern)
        try:
            for b in batches:
                for at in range(0, len(b), 500):
                    part = b.slice(at, 500)
                    n, sha, back, ids_out, decoded_out = [], [], [], [], []
                    for text in part.column(1):
                        ids = bpe.encode(text.as_py())
                        decoded = bpe.decode(ids)
                        n.append(len(ids))
                        sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                        back.append(hashlib.sha256(decoded).hexdigest())
                        if keep_ids:
                            ids_out.append(ids.astype(np.int64))
                            decoded_out.append(decoded)
                    out = {"doc_id": part.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(sha, pa.string()), "decoded_sha256": pa.array(back, pa.string())}
                    if keep_ids:
                        out |= {"ids": pa.array(ids_out, pa.list_(pa.int64())), "decoded": pa.array(decoded_out, pa.binary())}
                    yield pa.RecordBatch.from_pydict(out)
        finally:
            bpe.forget()

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(lean(run), schema + (", ids array<long>, decoded binary" if keep_ids else ""))
