"""Helpers that every training-data operator shares."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import stage_table

#: The word pattern of every contract, and the bytes it leaves out.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[list(SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BLOCK = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15)


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """A Parquet table in the shared folder, read back."""
    return stage_table(df, name)


def durable(df: DataFrame) -> DataFrame:
    return stage_table(df, "step")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let_go() -> None:
    """Gives memory that this process has freed back to the system. Arrow and the C library keep it otherwise, in every worker and through all later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of batches, after which its worker lets go of memory: Spark uses the worker for other tasks, and it shares the executor's memory with others."""

    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            let_go()

    return task


def held_out(doc_id: Column) -> Column:
    """True for the fifth of documents whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def whole_row(df: DataFrame) -> Column:
    """All columns as one, `row`, beside which any name is free."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")


def hash_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most limit rows, those with the smallest hash of key. A threshold from the number of rows comes first, so that tasks together send little more than the limit, however many they are."""
    space = 1 << 40
    rows = df.select(whole_row(df), F.col(key).alias("key"), F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(space)).alias("dice"))
    n = rows.count()
    if n > limit:
        rows = rows.where(F.col("dice") < int(space * min(1.0, (1.2 * limit + 100) / n)))
    return rows.orderBy("dice", "key").limit(limit).select("row.*")


def id_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most limit distinct values of key, those with the smallest hash, nulls left out; repeated ones count once. A threshold from the number of rows comes first, as in hash_sample."""
    space = 1 << 40
    dice = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(space))
    ids = df.select(key).where(F.col(key).isNotNull())
    n = ids.count()
    if n > limit:
        ids = ids.where(dice < int(space * min(1.0, (1.2 * limit + 100) / n)))
    return ids.distinct().orderBy(dice, key).limit(limit)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: each input bit reaches each output bit."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers = np.cumprod(np.full(1024, _BASE, dtype=np.uint64), dtype=np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        size = max(n, 2 * len(_powers))
        more = np.cumprod(np.full(size, _BASE, dtype=np.uint64), dtype=np.uint64)
        if size > 1 << 20:  # one giant word: use the table once
            return more
        _powers = more
    return _powers


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words in an array of UTF-8 bytes."""
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    np.logical_not(_IS_SEP[data], out=inside[1:-1].view(bool))
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _block_hashes(data: np.ndarray) -> np.ndarray:
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    owner = np.repeat(np.arange(len(starts)), lengths)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(owner)) - first[owner]
    values = (data[place + starts[owner]].astype(np.uint64) + np.uint64(1)) * _powers_to(int(lengths.max()))[place]
    return mix64(np.add.reduceat(values, first) ^ (lengths.astype(np.uint64) << np.uint64(48)))


def word_hashes(text: bytes, lower: bool = False) -> np.ndarray:
    """A 64-bit hash for each word of the whole text, in order. Blocks are cut between words, so memory stays bounded by the text and the block."""
    data = np.frombuffer(text, dtype=np.uint8)
    if lower:
        data = _LOWER[data]
    if len(data) <= _BLOCK:
        return _block_hashes(data)
    parts, at = [], 0
    while at < len(data):
        end = min(at + _BLOCK, len(data))
        while end < len(data):
            gap = np.flatnonzero(_IS_SEP[data[end : end + 65536]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + 65536, len(data))
        parts.append(_block_hashes(data[at:end]))
        at = end
    return np.concatenate(parts)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of width words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = mix64(hashes[:n])
    for j in range(1, width):
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + n])
    return out


def as_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.uint64).view(np.int64)
