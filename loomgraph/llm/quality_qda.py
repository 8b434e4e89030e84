"""Quality classifier: regularised quadratic discriminant.

Method: each class is a Gaussian over transformed document statistics. Counts, sums
and products of all labelled training rows are one aggregation; the driver gets two
rows. Class covariances are shrunk towards the pooled covariance and its diagonal. A
score is the logistic of the difference of the log densities, from Mahalanobis
distances by the cached Cholesky factors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, shared_table
from .docstats import FEATURES, document_stats, feature_matrix

#: Which features are shares, to be taken as logarithms.
_SHARES = np.array([f in ("top_word", "upper", "digits", "symbols", "points", "exclamations", "repeat_words", "dup_lines") for f in FEATURES])
_FLOOR = 0.01


def transform(x: np.ndarray) -> np.ndarray:
    """Shares become logarithms with a floor, which spreads small values; the rest stays."""
    return np.where(_SHARES, np.log(np.maximum(x, 0) + _FLOOR), x)


class Discriminant:
    """Two Gaussians. moments[c] = (n, sums, products) of class c."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], to_pooled: float = 0.1, to_diagonal: float = 0.05):
        d = len(FEATURES)
        self.log_prior, self.means, self.factors, self.log_dets = [], [], [], []
        total = sum(m[0] for m in moments.values())
        means = {c: m[1] / m[0] for c, m in moments.items()}
        scatter = {c: m[2] - m[0] * np.outer(means[c], means[c]) for c, m in moments.items()}
        pooled = sum(scatter.values()) / max(1.0, total) + 1e-4 * np.eye(d)
        for c in (0, 1):
            if c not in moments:
                raise ValueError("labelled rows of both classes are needed")
            cov = (1 - to_pooled) * scatter[c] / max(1.0, moments[c][0]) + to_pooled * pooled
            cov = (1 - to_diagonal) * cov + to_diagonal * np.diag(np.diag(pooled))
            factor = np.linalg.cholesky(cov)
            self.means.append(means[c])
            self.factors.append(np.linalg.solve(factor, np.eye(d)))
            self.log_dets.append(2 * np.log(np.diag(factor)).sum())
            self.log_prior.append(np.log(moments[c][0] / total))

    def log_density(self, z: np.ndarray, c: int) -> np.ndarray:
        y = (z - self.means[c]) @ self.factors[c].T
        return -0.5 * ((y * y).sum(axis=1) + self.log_dets[c]) + self.log_prior[c]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = transform(x)
        return 1 / (1 + np.exp(-np.clip(self.log_density(z, 1) - self.log_density(z, 0), -50, 50)))


def _moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    d = len(FEATURES)
    z = [F.log(F.greatest(F.lit(0.0), F.col("features")[i]) + _FLOOR) if _SHARES[i] else F.col("features")[i] for i in range(d)]
    rows = rows.select("label", *(z[i].alias(f"z{i}") for i in range(d)))
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    found = {}
    for r in rows.groupBy("label").agg(F.count(F.lit(1)), *(F.sum(f"z{i}") for i in range(d)), *(F.sum(F.col(f"z{i}") * F.col(f"z{j}")) for i, j in pairs)).collect():
        products = np.zeros((d, d))
        for (i, j), v in zip(pairs, r[2 + d :]):
            products[i, j] = products[j, i] = v
        found[int(r[0])] = float(r[1]), np.array(r[2 : 2 + d]), products
    return found


def labelled(stats: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Training rows with label 0 or 1: labels of no held-out document. Labels other than 0 and 1 are left out; of several for one document the smallest counts."""
    known = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(column).alias("label"))
    return stats.where(~held_out(F.col("doc_id"))).join(known, "doc_id")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """docs(doc_id, text, ...), labels(doc_id, quality, ...) -> doc_id, held_out, score, predicted; a row per row.

    Null, empty and blank texts have statistics of 0 and are scored like any text.
    Without training rows of both classes every score is 0.5. Other columns are not
    read.
    """
    stats = shared_table(document_stats(docs), "stats")
    moments = _moments(labelled(stats, labels, "quality"))
    model = Discriminant(moments) if set(moments) == {0, 1} else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(feature_matrix(b.column(2))) if model and len(b) else np.full(len(b), 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "features").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
