"""Approximate nearest neighbours by learned partitions.

Method: on a bounded sample, the neighbour graph is cut into balanced partitions: a
median bisection starts, then moves that gain neighbours on their own side refine it
under a size limit. A small network learns which partitions a vector's neighbours lie
in. It places every vector into its most probable partition and routes a query to the
several most probable ones, where all candidates are reranked by exact distance.

Partitions hold about PART_ROWS distinct vectors, at every size: small tables have
LEAST_PARTS, and beyond MOST_PARTS each partition is cut in the same way on a bounded
sample of its own, with a network of its own, to MOST_PARTS squared in all.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, hash_sample, shared_table

SAMPLE_ROWS = 16_384
PART_ROWS = 1_500
LEAST_PARTS, MOST_PARTS = 8, 256
LEAST_PROBES = 3
CHUNK_ROWS, BLOCK_ROWS = 8_192, 4_096
GRAPH_DEGREE = 10
LEAST_STEPS = 600


def neighbour_graph(x: np.ndarray, k: int = GRAPH_DEGREE) -> np.ndarray:
    """Row i: the k nearest rows to row i, itself left out."""
    k = min(k, len(x) - 1)
    squares = (x * x).sum(axis=1)
    out = np.empty((len(x), k), dtype=np.int64)
    for at in range(0, len(x), 1024):
        block = x[at : at + 1024]
        d = squares[None, :] - 2 * block @ x.T
        d[np.arange(len(block)), at + np.arange(len(block))] = np.inf
        out[at : at + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.15, rounds: int = 12) -> np.ndarray:
    """A partition number, 0 to parts - 1 (a power of two), for each row."""
    part = np.zeros(len(x), dtype=np.int64)
    level = 1
    while level < parts:
        new = part * 2
        for p in range(level):
            rows = np.flatnonzero(part == p)
            if len(rows) < 2:
                continue
            centred = x[rows] - x[rows].mean(axis=0)
            axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            order = np.argsort(centred @ axis, kind="stable")
            new[rows[order[len(rows) // 2 :]]] += 1
        part, level = new, level * 2
    limit = int(np.ceil(slack * len(x) / parts))
    for _ in range(rounds):
        count = np.zeros((len(x), parts), dtype=np.int32)
        np.add.at(count, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(count, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        best = count.argmax(axis=1)
        gain = count[np.arange(len(x)), best] - count[np.arange(len(x)), part]
        moves = np.flatnonzero(gain > 0)
        moves = moves[np.argsort(-gain[moves], kind="stable")]
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in moves[: max(1, len(moves) // 2)]:
            if size[best[i]] < limit:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


class Router:
    """One hidden layer, trained by Adam to tell the partitions of a vector and its neighbours."""

    def __init__(self, x: np.ndarray, target: np.ndarray, hidden: int = 96, epochs: int = 40, batch: int = 256, rate: float = 3e-3):
        rng = np.random.default_rng(7)
        self.mean, self.scale = x.mean(axis=0), x.std() + 1e-9
        z = ((x - self.mean) / self.scale).astype(np.float32)
        d, parts = z.shape[1], target.shape[1]
        w = [rng.normal(0, 1 / np.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), (hidden, parts)), np.zeros(parts)]
        self.w = [a.astype(np.float32) for a in w]
        m, v, t = [np.zeros_like(a) for a in self.w], [np.zeros_like(a) for a in self.w], 0
        epochs = max(epochs, -(-LEAST_STEPS * batch // len(z)))
        for epoch in range(epochs):
            order = rng.permutation(len(z))
            for at in range(0, len(z), batch):
                rows = order[at : at + batch]
                h = np.maximum(z[rows] @ self.w[0] + self.w[1], 0)
                g = (self._soft(h @ self.w[2] + self.w[3]) - target[rows]) / len(rows)
                back = (g @ self.w[2].T) * (h > 0)
                t += 1
                step = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
                for i, grad in enumerate((z[rows].T @ back, back.sum(axis=0), h.T @ g, g.sum(axis=0))):
                    m[i] = 0.9 * m[i] + 0.1 * grad
                    v[i] = 0.999 * v[i] + 0.001 * grad * grad
                    self.w[i] = self.w[i] - (step * m[i] / (np.sqrt(v[i]) + 1e-8)).astype(np.float32)

    @staticmethod
    def _soft(a: np.ndarray) -> np.ndarray:
        e = np.exp(a - a.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale).astype(np.float32)
        return self._soft(np.maximum(z @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3])


def fit_router(x: np.ndarray, parts: int) -> Router | None:
    """None for a single partition."""
    if parts < 2:
        return None
    graph = neighbour_graph(x)
    part = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts), dtype=np.float32)
    near = np.concatenate([part[:, None], part[graph]], axis=1)
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), near.ravel()), 1.0 / near.shape[1])
    return Router(x, target)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def shape_of(rows: int) -> tuple[int, int]:
    """How many partitions the first network tells apart, and how many each of the second ones; powers of two."""
    parts = LEAST_PARTS
    while parts > 1 and parts > rows // 2:
        parts //= 2
    while rows / (2 * parts) >= PART_ROWS:
        parts *= 2
    if parts <= MOST_PARTS:
        return parts, 1
    first = 1
    while first * first < parts and first < MOST_PARTS:
        first *= 2
    return first, min(MOST_PARTS, parts // first)


class Routers:
    """The first network and, by its partitions, the second ones; a partition without rows in the sample has none and stays whole."""

    def __init__(self, first: Router | None, second: dict[int, Router], parts: tuple[int, int]):
        self.first, self.second, self.parts = first, second, parts

    def coarse(self, x: np.ndarray) -> np.ndarray:
        return self.first(x) if self.first else np.ones((len(x), 1))

    def _fine(self, x: np.ndarray, part: int) -> np.ndarray:
        if part in self.second:
            return self.second[part](x)
        return np.eye(1, self.parts[1]).repeat(len(x), axis=0)

    def place(self, x: np.ndarray) -> np.ndarray:
        part = self.coarse(x).argmax(axis=1)
        out = part * self.parts[1]
        if self.parts[1] > 1:
            for c in np.unique(part):
                rows = np.flatnonzero(part == c)
                out[rows] += self._fine(x[rows], int(c)).argmax(axis=1)
        return out

    def route(self, x: np.ndarray, mass: float, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, partition): for each row the most probable partitions, until they hold `mass` of its probability and `least` vectors (sizes: of each partition), LEAST_PROBES at least."""
        rows, parts = np.arange(len(x)), self.parts
        p = self.coarse(x)
        row, part, p = self._most(np.repeat(rows, parts[0]), np.tile(np.arange(parts[0]), len(x)), p.ravel(), mass, sizes.reshape(parts).sum(axis=1), least)
        if parts[1] > 1:
            found = []
            for c in np.unique(part):
                at = np.flatnonzero(part == c)
                fine = self._fine(x[row[at]], int(c)) * p[at, None]
                found.append((np.repeat(row[at], parts[1]), np.tile(c * parts[1] + np.arange(parts[1]), len(at)), fine.ravel()))
            row, part, p = self._most(*(np.concatenate(a) for a in zip(*found)), mass, sizes, least)
        return row, part

    @staticmethod
    def _most(row: np.ndarray, part: np.ndarray, p: np.ndarray, mass: float, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((part, -p, row))
        row, part, p = row[order], part[order], p[order]
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.empty(0, dtype=np.int64)
        count = np.diff(np.append(first, len(row)))
        before = lambda v: (total := np.cumsum(v) - v) - np.repeat(total[first], count)
        take = (before(p) < mass) | (before(np.ones(len(p))) < LEAST_PROBES) | (before(sizes[part].astype(np.float64)) < least)
        return row[take], part[take], p[take]


def fit_routers(points: DataFrame, rows: int, sample_rows: int) -> Routers:
    """The networks for a table of distinct vectors (vid, v). Each is fitted on at most sample_rows vectors, those with the smallest hashes; at most MOST_PARTS second ones are sent to the driver, of one size whatever the data."""
    parts = shape_of(rows)
    sample = _matrix(hash_sample(points.select("vid", "v"), "vid", sample_rows).select("v").toPandas()["v"])
    first = fit_router(sample, parts[0])
    if parts[1] < 2:
        return Routers(first, {}, parts)
    share = points.sparkSession.sparkContext.broadcast(Routers(first, {}, (parts[0], 1)))
    dice = F.pmod(F.xxhash64("vid", F.lit(1)), F.lit(1 << 30))
    some = points.select("vid", "v", dice.alias("dice")).where(F.col("dice") < int((1 << 30) * min(1.0, 0.7 * sample_rows * parts[0] / rows)))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                b = b.reset_index(drop=True)
                yield b.assign(part=share.value.place(_matrix(b["v"])).astype(np.int64))

    kind = points.schema["v"].dataType.simpleString()
    placed = some.mapInPandas(place, f"vid long, v {kind}, dice long, part long")
    # A partition with far more rows than others still sends a bounded number: the limit also runs before the shuffle.
    placed = placed.withColumn("r", F.row_number().over(Window.partitionBy("part").orderBy("dice", "vid"))).where(F.col("r") <= sample_rows)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(group.sort_values(["dice", "vid"])["v"])
        return pd.DataFrame({"part": group["part"].iloc[:1].to_numpy(), "router": [pickle.dumps(fit_router(x, parts[1]) if len(x) >= 2 * parts[1] else None)]})

    second = placed.groupBy("part").applyInPandas(fit, "part long, router binary").toLocalIterator()
    return Routers(first, {r["part"]: m for r in second if (m := pickle.loads(bytes(r["router"])))}, parts)


def nearest_neighbours(vectors: DataFrame, is_query: str = "vec_id % 100 = 0", k: int = 10, mass: float = 0.95, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """vectors(vec_id, embedding, ...) -> query_id, rank, vec_id, score for each query's k nearest other rows by Euclidean distance.

    Null and zero vectors, those with a null or non-finite component and those of
    another length than most take no part, nor do rows without vec_id. Equal vectors
    are searched once: of each, the k + 1 smallest vec_ids are enough for every result.
    Ties go to the smaller vec_id. With k or fewer candidates all are returned. A query is
    routed to the partitions that together hold `mass` of its probability, LEAST_PROBES
    at least, and more than k vectors; a mass above 1 probes all. Rows that repeat a
    vec_id count once per vector. Each partition is cut into chunks, and
    its queries into blocks, by its own counts.
    """
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0)
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    good = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v"))
    usual = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").head()
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    if usual is None:
        return spark.createDataFrame([], schema)
    good = good.where(F.size("v") == usual["n"])
    # The ranking limit also runs before the shuffle, so a very common vector sends k + 1 rows a task.
    ranked = good.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    points = ranked.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).withColumn("vid", F.col("ids")[0])
    points = shared_table(points, "points")
    routers = spark.sparkContext.broadcast(fit_routers(points, points.count(), sample_rows))
    asked = durable(good.where(is_query).select("vec_id", "v"))
    queries = asked.groupBy("v").agg(F.min("vec_id").alias("qid"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                b = b.reset_index(drop=True)
                yield b.assign(part=routers.value.place(_matrix(b["v"])).astype(np.int64))

    placed = durable(points.select("vid", "ids", "v").mapInPandas(place, f"vid long, ids array<long>, v {kind}, part long"))
    # One row a partition: at most MOST_PARTS squared.
    parts = routers.value.parts
    sizes = np.zeros(parts[0] * parts[1], dtype=np.int64)
    for r in placed.groupBy("part").count().collect():
        sizes[r["part"]] = r["count"]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                b = b.reset_index(drop=True)
                i, part = routers.value.route(_matrix(b["v"]), mass, sizes, k + 1)
                yield b.iloc[i].assign(part=part.astype(np.int64))

    routed = durable(queries.mapInPandas(route, f"v {kind}, qid long, part long"))
    counts = lambda df, n, name: df.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / n).cast("int").alias(name))
    shape = F.broadcast(durable(counts(placed, CHUNK_ROWS, "chunks").join(counts(routed, BLOCK_ROWS, "blocks"), "part")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.join(shape, "part").withColumn("chunk", F.pmod(F.xxhash64("vid"), F.col("chunks")).cast("int")).withColumn("block", every("blocks"))
    right = routed.join(shape, "part").withColumn("block", F.pmod(F.xxhash64("qid"), F.col("blocks")).cast("int")).withColumn("chunk", every("chunks"))

    def search(a: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(q):
            x, vid = _matrix(a["v"]), a["vid"].to_numpy()
            for qid, v in zip(q["qid"], q["v"]):
                gap = x - np.asarray(v, dtype=np.float64)
                d = np.sqrt((gap * gap).sum(axis=1))
                near = np.flatnonzero(d <= np.partition(d, min(k, len(d) - 1))[min(k, len(d) - 1)])
                near = near[np.lexsort((vid[near], d[near]))[: k + 1]]
                out += [(qid, d[i], a["ids"].iloc[i]) for i in near]
        return pd.DataFrame(out, columns=["qid", "score", "ids"])

    on = ["part", "chunk", "block"]
    left, right = left.select("vid", "ids", "v", *on), right.select("qid", "v", *on)
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(search, "qid long, score double, ids array<long>")
    found = found.select("qid", "score", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("qid").orderBy("score", "vec_id")
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    members = asked.join(queries, "v").select(F.col("vec_id").alias("query_id"), "qid").distinct()
    out = members.join(found, "qid").where("query_id <> vec_id")
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
