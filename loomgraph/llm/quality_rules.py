"""Quality rules: gradient-boosted trees over document statistics.

Method: histogram trees of fixed depth with logistic loss, grown by the driver on a
bounded number of labelled rows. Along chosen features a tree's leaves may only fall,
so a document never gains by more repetition or more symbols: a split is allowed only
if its sides keep that order, and the middle of the two bounds what lies below it. The
trees are kept flat, as arrays in heap order, and scored a level at a time for all rows
and trees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, shared_table
from .docstats import COUNTS, FEATURES, document_stats, feature_matrix
from .quality_qda import labelled

TRAIN_ROWS = 20_000
#: Features along which a score may only fall.
FALLING = ("symbols", "exclamations", "repeat_words", "dup_lines", "top_word")


class Trees:
    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, least: float = 1.0, ridge: float = 1.0, falling: tuple[str, ...] = FALLING):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge = rounds, depth, rate, bins, least, ridge
        self.falling = np.array([f in falling for f in FEATURES])

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        n, d = x.shape
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(d)]
        code = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(d)], axis=1)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        nodes = 2 ** (self.depth + 1) - 1
        self.feature = np.zeros((self.rounds, nodes), dtype=np.int32)
        self.cut = np.full((self.rounds, nodes), np.inf)
        self.value = np.zeros((self.rounds, nodes))
        margin = np.full(n, self.start)
        width = self.bins + 1
        for t in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
            node = np.zeros(n, dtype=np.int64)
            low, high = np.full(nodes, -np.inf), np.full(nodes, np.inf)
            for level in range(self.depth):
                for v in range(2**level - 1, 2 ** (level + 1) - 1):
                    rows = np.flatnonzero(node == v)
                    best = self._split(code[rows], grad[rows], hess[rows], cuts, width, low[v], high[v]) if len(rows) else None
                    left, right = 2 * v + 1, 2 * v + 2
                    low[left] = low[right] = low[v]
                    high[left] = high[right] = high[v]
                    if best is None:  # all rows go left, to a leaf in the end
                        node[rows] = left
                        continue
                    j, c, a, b = best
                    self.feature[t, v], self.cut[t, v] = j, cuts[j][c]
                    if self.falling[j]:
                        low[left] = max(low[v], (a + b) / 2)
                        high[right] = min(high[v], (a + b) / 2)
                    node[rows] = np.where(code[rows, j] <= c, left, right)
            leaf_g = np.bincount(node, weights=grad, minlength=nodes)
            leaf_h = np.bincount(node, weights=hess, minlength=nodes)
            self.value[t] = self.rate * np.clip(-leaf_g / (leaf_h + self.ridge), low, high)
            margin += self.value[t, node]
        return self

    def _split(self, code, grad, hess, cuts, width, low, high):
        total_g, total_h = grad.sum(), hess.sum()
        weigh = lambda g, h: np.clip(-g / (h + self.ridge), low, high)
        gain_of = lambda g, h, w: -(g * w + 0.5 * (h + self.ridge) * w * w)
        base = gain_of(total_g, total_h, weigh(total_g, total_h))
        best, most = None, base + 1e-6
        for j in range(code.shape[1]):
            if not len(cuts[j]):
                continue
            g = np.cumsum(np.bincount(code[:, j], weights=grad, minlength=width))[: len(cuts[j])]
            h = np.cumsum(np.bincount(code[:, j], weights=hess, minlength=width))[: len(cuts[j])]
            a, b = weigh(g, h), weigh(total_g - g, total_h - h)
            gain = gain_of(g, h, a) + gain_of(total_g - g, total_h - h, b)
            gain[(h < self.least) | (total_h - h < self.least)] = -np.inf
            if self.falling[j]:
                gain[a < b] = -np.inf
            c = int(np.argmax(gain))
            if gain[c] > most:
                most, best = gain[c], (j, c, a[c], b[c])
        return best

    def score(self, x: np.ndarray) -> np.ndarray:
        n = len(x)
        node = np.zeros((n, self.rounds), dtype=np.int64)
        trees, rows = np.arange(self.rounds), np.arange(n)[:, None]
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.cut[trees, node])
        return 1 / (1 + np.exp(-(self.start + self.value[trees, node].sum(axis=1))))


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """docs(doc_id, text, ...), labels(doc_id, quality, ...) -> doc_id, COUNTS, base_failed, score, kept; a row per row.

    The trees learn from at most train_rows labelled documents, those with the smallest
    hash of doc_id, none held out; of several rows of a doc_id from the least. Without
    rows of both classes the method keeps everything. Null, empty and blank texts have
    counts of 0 and fail the base rules.
    """
    stats = shared_table(document_stats(docs), "stats")
    known = labelled(stats, labels, "quality").groupBy("doc_id").agg(F.min(F.struct("features", "label")).alias("s")).select("doc_id", "s.*")
    sample = hash_sample(known, "doc_id", train_rows).select("features", "label").toArrow().combine_chunks()
    x, y = feature_matrix(sample["features"].combine_chunks()), sample["label"].to_numpy().astype(np.float64)
    model = Trees().fit(x, y) if 0 < y.sum() < len(y) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(feature_matrix(b.column("features"))) if model and len(b) else np.ones(len(b))
            failed = base_failed(b.column("n_words").to_numpy(), b.column("n_repeat_words").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))], ["doc_id", *COUNTS, "base_failed", "score", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", *COUNTS, "features").mapInArrow(run, f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, score double, kept boolean")
