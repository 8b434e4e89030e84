"""Statistics of whole documents, for the quality operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import windows, word_bounds, word_hashes

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words",
    "word_length",
    "word_length_spread",
    "distinct_words",
    "top_word",
    "upper",
    "digits",
    "symbols",
    "points",
    "exclamations",
    "repeat_words",
    "dup_lines",
    "log_line_words",
    "short_words",
)

#: The classes of bytes.
_KIND = np.zeros(256, dtype=np.uint8)
for _kind, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"#*$%&|<>", b".,;:?\"'()", b"!", b"\n", bytes(range(0x80, 0xC0))), start=1):
    _KIND[list(_bytes)] = _kind
_UPPER, _LOWER, _DIGIT, _SYMBOL, _POINT, _SHOUT, _LINE, _REST = range(1, 9)


def repeated_words(hashes: np.ndarray, width: int = 5) -> int:
    """How many words lie in some window of that many words which the text has twice or more."""
    w = windows(hashes, width)
    if len(w) < 2:
        return 0
    order = np.argsort(w, kind="stable")
    s = w[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(w), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b"\x20\x09\x0a\x0b\x0c\x0d")]
    return len(lines) - len(set(lines))


def describe(text: bytes | None) -> tuple[tuple[int, ...], np.ndarray]:
    """COUNTS and FEATURES of a text. Null and empty texts have counts of 0 and features of 0."""
    if not text:
        return (0,) * len(COUNTS), np.zeros(len(FEATURES))
    data = np.frombuffer(text, dtype=np.uint8)
    starts, ends = word_bounds(data)
    n = len(starts)
    kinds = np.bincount(_KIND[data], minlength=9)
    n_dup = dup_lines(text)
    if not n:
        return (0, 0, int(kinds[_SYMBOL]), n_dup, 0), np.zeros(len(FEATURES))
    rest = np.concatenate(([0], np.cumsum((data & 0xC0) == 0x80)))
    lengths = (ends - starts) - (rest[ends] - rest[starts])
    chars = int(lengths.sum())
    hashes = word_hashes(text)
    n_repeat = repeated_words(hashes)
    s = np.sort(hashes)
    heads = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    top = int(np.diff(np.append(heads, n)).max())
    upper, lower = kinds[_UPPER], kinds[_LOWER]
    lines = kinds[_LINE] + 1
    share = np.array([kinds[_DIGIT], kinds[_SYMBOL], kinds[_POINT], kinds[_SHOUT]]) / chars
    features = [np.log1p(n), chars / n, lengths.std(), len(heads) / n, top / n, upper / max(1, upper + lower), *share, n_repeat / n, n_dup / lines, np.log(n / lines), (lengths <= 3).mean()]
    return (n, chars, int(kinds[_SYMBOL]), n_dup, n_repeat), np.array(features)


def document_stats(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, COUNTS (long), features (array of double); a row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = [describe(t.as_py()) for t in b.column(1).cast(pa.binary())]
            counts = np.array([c for c, _ in both], dtype=np.int64).reshape(-1, len(COUNTS))
            columns = [b.column(0), *(pa.array(counts[:, i]) for i in range(len(COUNTS))), pa.array([f for _, f in both], type=pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *COUNTS, "features"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, features array<double>")


def feature_matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, len(FEATURES))
