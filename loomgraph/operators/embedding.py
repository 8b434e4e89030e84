"""Embeddings of strings: offline encoder, weighted PCA, component choice, projection, centroids, close pairs."""

from __future__ import annotations

import importlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stage_table

DIMENSIONS = 64


def encode_strings(strings: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """The offline encoder: hashed character trigrams, of unit length."""
    out = np.zeros((len(strings), dimensions))
    for i, s in enumerate(strings):
        padded = f"  {s} "
        for j in range(len(padded) - 2):
            h = zlib.crc32(padded[j : j + 3].encode("utf-8", "replace"))
            out[i, h % dimensions] += 1.0 if h & 0x80000000 else -1.0
        out[i, 0] += 1e-3  # never a zero vector
    return out / np.linalg.norm(out, axis=1, keepdims=True)


@lru_cache(maxsize=2)
def load_encoder(name: str = "offline") -> Callable[[list[str]], np.ndarray]:
    """Strings -> unit vectors. `offline` is the encoder above; any other name is `module:factory`, whose factory() loads a model and returns such a function. It is loaded once a worker."""
    if name == "offline":
        return encode_strings
    module, _, factory = name.partition(":")
    return getattr(importlib.import_module(module), factory or "load")()


def encode(items: DataFrame, encoder: str = "offline") -> DataFrame:
    """items(role, item, ...) with a column `v`: each distinct row is encoded once."""
    at = items.columns.index("item")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = load_encoder(encoder)(b.column(at).to_pylist()) if len(b) else np.empty((0, 1))
            v = pa.array(list(np.asarray(v, dtype=np.float64)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns, v], [*b.schema.names, "v"])

    return items.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in items.dtypes) + ", v array<double>")


def weighted_moments(points: DataFrame) -> dict[str, tuple[float, np.ndarray, np.ndarray]]:
    """points(role, n, v) -> role: total weight, weighted sum, weighted products. Each task sends one row a role; the driver gets one."""
    schema = "role string, total double, sums array<double>, products array<double>"

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, list] = {}
        for b in batches:
            for role, rows in b.groupby("role"):
                x, c = np.array(rows["v"].tolist()), rows["n"].to_numpy(dtype=float)
                part = (c.sum(), c @ x, (x * c[:, None]).T @ x)
                found[role] = [a + p for a, p in zip(found[role], part)] if role in found else list(part)
        yield pd.DataFrame([(r, t, s, p.ravel()) for r, (t, s, p) in found.items()], columns=["role", "total", "sums", "products"])

    def whole(p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(p["role"].iloc[0], p["total"].sum(), np.sum(p["sums"].tolist(), axis=0), np.sum(p["products"].tolist(), axis=0))], columns=["role", "total", "sums", "products"])

    rows = points.select("role", "n", "v").mapInPandas(partial, schema).groupBy("role").applyInPandas(whole, schema).collect()
    return {r["role"]: (r["total"], np.array(r["sums"]), np.array(r["products"]).reshape(len(r["sums"]), -1)) for r in rows}


def covariance(total: float, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of rows repeated by their weights."""
    mean = sums / total
    return mean, (products - total * np.outer(mean, mean)) / max(total - 1, 1.0)


def spectrum(total: float, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, eigenvalues (descending, min(N, d) of them) and eigenvectors, their largest component positive."""
    mean, cov = covariance(total, sums, products)
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    keep = int(min(total, len(values)))
    values, vectors = np.maximum(values[::-1][:keep], 0.0), vectors[:, ::-1][:, :keep]
    return mean, values, vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(keep)])


def choose_components(values: np.ndarray) -> int:
    """Up to two: all. Else up to the largest gap, first on ties; if that keeps less than half of the variance, the first count that keeps 85 %."""
    if len(values) <= 2 or values.sum() <= 0:
        return len(values)
    k = int(np.argmax(values[:-1] - values[1:])) + 1
    share = np.cumsum(values) / values.sum()
    if share[k - 1] < 0.5:
        k = int(np.argmax(share >= 0.85)) + 1
    return k


def project(points: DataFrame, bases: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """points(..., role, v) with v replaced by its centred coordinates. bases: role -> mean, vectors."""
    names = points.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = zip(b.column(names.index("role")).to_pylist(), b.column(names.index("v")).to_pylist())
            v = pa.array([(np.asarray(v) - bases[r][0]) @ bases[r][1] for r, v in both], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([v if n == "v" else c for n, c in zip(names, b.columns)], names)

    return points.mapInArrow(run, points.schema)


def choose_by_rows(spectra: DataFrame) -> DataFrame:
    """spectra(role, k from 1, ev descending) -> role, components: choose_components as a plan."""
    by = Window.partitionBy("role").orderBy("k")
    whole = Window.partitionBy("role")
    w = spectra.withColumns({"gap": F.col("ev") - F.lead("ev").over(by), "cum": F.sum("ev").over(by) / F.nullif(F.sum("ev").over(whole), F.lit(0.0)), "total": F.sum("ev").over(whole)})
    g = w.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.max("total").alias("total"), F.max_by(F.struct("k", "cum"), F.when(F.col("gap").isNotNull(), F.struct("gap", -F.col("k")))).alias("g"), F.min(F.when(F.col("cum") >= 0.85, F.col("k"))).alias("kc"))
    return g.select("role", F.when((F.col("n") <= 2) | (F.col("total") <= 0), F.col("n")).when(F.col("g.cum") < 0.5, F.col("kc")).otherwise(F.col("g.k")).cast("int").alias("components"))


def spectra(moments: dict[str, tuple[float, np.ndarray, np.ndarray]]) -> list[tuple[str, int, float]]:
    """(role, k, eigenvalue): as many rows as roles times dimensions."""
    return [(role, k, float(v)) for role, m in moments.items() for k, v in enumerate(spectrum(*m)[1], 1)]


def centroids(members: DataFrame, group: str = "cluster_id", key: str = "item") -> DataFrame:
    """members(group, item_idx, key, v) -> group, center: the member nearest by cosine to the mean of the members' vectors; distances are rounded to 12 digits, then the first member wins."""
    flat = members.select(group, "item_idx", F.posexplode("v").alias("i", "x"))
    mean = flat.groupBy(group, "i").agg(F.avg("x").alias("m"))
    sums = flat.join(mean, [group, "i"]).groupBy(group, "item_idx").agg(F.sum(F.col("x") * F.col("m")).alias("xm"), F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("m") * F.col("m")).alias("mm"))
    distance = sums.select(group, "item_idx", F.round(1 - F.col("xm") / F.nullif(F.sqrt("xx") * F.sqrt("mm"), F.lit(0.0)), 12).alias("distance"))
    best = distance.groupBy(group).agg(F.min(F.struct(F.coalesce("distance", F.lit(1.0)).alias("distance"), "item_idx")).alias("b"))
    best = best.select(group, F.col("b.item_idx").alias("item_idx"), F.col("b.distance").alias("distance"))
    return best.join(members.select(group, "item_idx", F.col(key).alias("center")), [group, "item_idx"]).select(group, "center", "distance")
