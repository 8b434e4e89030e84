"""Vectors near one another by angle: a metric tree built level by level, so that any pair within an angle meets in some group of bounded size.

A node of more than BLOCK vectors gets pivots, those of a sample of its own vectors that
are farthest from one another, and each vector goes to the child of the nearest one; a
child keeps the largest angle to its pivot. On the way back down a vector visits each
child that can hold one within the angle asked for. As angles obey the triangle
inequality, that is none whose pivot is farther than the child's largest angle and the
angle asked for, and none whose pivot is farther by twice that angle than the nearest
one. How many leaves a vector visits depends on how many vectors are near it, not on how
many there are. No pivots go through the driver: they meet their node's vectors in groups
of some GROUP rows.

Where the pivots would leave a vector more than SAVES of its node to meet, as with
vectors scattered evenly, a split only copies vectors. Such a node stays whole and its
blocks meet one another: all pairs, which is what is left to do, in groups as bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import drop_tables, stage_table

BLOCK = 2_048
FAN = 256
SAMPLE = 4
GROUP = 32_768
SAVES = 0.5
#: Vectors compared, and pairs told, at a time.
CELLS = 1 << 21
PAIRS = 1 << 18


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), dtype=np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _apart(x: np.ndarray, most: int) -> np.ndarray:
    """At most `most` of the unit vectors: the first, then always the one farthest from all before; equal ones once."""
    to, chosen = _angles(x, x[:1])[:, 0], [0]
    while len(chosen) < most and to.max() > 1e-7:
        chosen.append(int(to.argmax()))
        to = np.minimum(to, _angles(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))  # off by some 1e-8 where vectors are as good as equal


def _salted(rows: DataFrame, sizes: DataFrame, node: str) -> DataFrame:
    """Rows of nodes of sizes(node, n), dealt to groups of some GROUP rows."""
    return rows.join(sizes.select(F.col("node").alias(node), "n"), node).withColumn("salt", F.pmod(F.xxhash64("k", F.lit("group")), F.ceil(F.col("n") / GROUP)).cast("int")).drop("n")


def _for_each_salt(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    return rows.join(sizes.select("node", "n"), "node").withColumn("salt", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / GROUP).cast("int") - 1))).drop("n")


def _saves(x: np.ndarray, pivots: np.ndarray, angle: float) -> bool:
    """Whether, by a sample of a node's unit vectors, these pivots spare a vector enough of the others."""
    to = _angles(x, pivots)
    home, low = to.argmin(axis=1), to.min(axis=1)
    size, radius = np.bincount(home, minlength=len(pivots)), np.zeros(len(pivots))
    np.maximum.at(radius, home, low)
    visited = (to <= radius + angle) & (to <= low[:, None] + 2 * angle)
    return float((visited @ size).mean()) <= SAVES * len(x)


def _grow(rows: DataFrame, fields: str, angle: float) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """rows(b, k, v, node) at their leaves, the children(node, child, pivot, radius) of each level, and leaves(node, n)."""
    levels, done, leaves = [], [], []
    sizes = stage_table(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).withColumn("flat", F.lit(False)))

    def assign(p: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(p):
            return pd.DataFrame({c: [] for c in ("b", "k", "v", "node", "angle")}, dtype=object)
        to = _angles(_unit(p["v"]), np.array(pivots["pivots"].iloc[0].tolist()))
        child = [f"{n}/{i}" for n, i in zip(p["node"], to.argmin(axis=1))]
        return pd.DataFrame({c: p[c].to_numpy() for c in ("b", "k", "v")} | {"node": child, "angle": to.min(axis=1)})

    def choose(batches):
        for p in batches:
            chosen = []
            for v, most in zip(p["some"], p["most"]):
                x = _unit(v)
                pivots = _apart(x, most)
                # Equal vectors have one pivot; their node is known as flat by its only child.
                chosen.append(pivots.tolist() if len(pivots) == 1 or _saves(x, pivots, angle) else [])
            yield pd.DataFrame({"node": p["node"].to_numpy(), "pivots": chosen})

    while True:
        big = sizes.where((F.col("n") > BLOCK) & ~F.col("flat"))
        small = sizes.join(big.select("node"), "node", "left_anti")
        leaves.append(small.select("node", "n"))
        done.append(rows.join(small.select("node"), "node", "left_semi").select("b", "k", "v", "node"))
        if not big.head(1):
            return reduce(DataFrame.unionByName, done), levels, stage_table(reduce(DataFrame.unionByName, leaves))
        dice = F.pmod(F.xxhash64("k", F.lit(len(levels))), F.lit(1 << 30))
        most = F.least(F.lit(FAN), 4 * F.ceil(F.col("n") / BLOCK)).cast("int").alias("most")
        some = rows.join(big.select("node", "n", most), "node").withColumn("dice", dice).where(F.col("dice") < (1 << 30) * (1.2 * SAMPLE * F.col("most") + 20) / F.col("n"))
        some = some.groupBy("node", "most").agg(F.sort_array(F.collect_list(F.struct("dice", "k", "v")))["v"].alias("some"))
        pivots = stage_table(some.mapInPandas(choose, "node string, pivots array<array<double>>"))
        whole = pivots.where(F.size("pivots") == 0).select("node")
        leaves.append(big.join(whole, "node", "left_semi").select("node", "n"))
        done.append(rows.join(whole, "node", "left_semi").select("b", "k", "v", "node"))
        pivots, big = pivots.where(F.size("pivots") > 0), big.join(whole, "node", "left_anti")
        rows = rows.join(whole, "node", "left_anti")
        dealt = _salted(rows.select("b", "k", "v", "node"), big, "node").groupBy("node", "salt")
        assigned = dealt.cogroup(_for_each_salt(pivots, big).groupBy("node", "salt")).applyInPandas(assign, f"{fields}, node string, angle double")
        assigned = stage_table(assigned)
        made = assigned.groupBy(F.col("node").alias("child")).agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius"))
        named = pivots.select("node", F.posexplode("pivots").alias("i", "pivot")).select("node", F.concat_ws("/", "node", F.col("i").cast("string")).alias("child"), "pivot")
        made = named.join(made, "child")
        # Where one child takes nearly all, its vectors are as good as equal, and only blocks of any of them help.
        made = stage_table(made.join(big.select("node", F.col("n").alias("above")), "node").withColumn("flat", F.col("n") > 0.9 * F.col("above")))
        levels.append(made.select("node", "child", "pivot", "radius"))
        rows = assigned.select("b", "k", "v", "node")
        sizes = made.select(F.col("child").alias("node"), "n", "flat")


def near_groups(points: DataFrame, angle: float, by: str, key: str, wide: int = 1) -> DataFrame:
    """points(by, key, v) -> b, k, v, leaf, part, guest.

    Two rows of one `by` within the angle are in exactly one group (leaf, part) as two
    residents of part 0, or as a guest and a resident; keys are unique in a `by`. Rows
    whose vector is null, zero or not finite are left out. A group has at most BLOCK residents and
    about as many guests. Nodes that stay whole have blocks of up to `wide` times BLOCK,
    where 16 blocks are not enough: the wider they are, the fewer copies of a vector.
    """
    kinds = dict(points.dtypes)
    fields = f"b {kinds[by]}, k {kinds[key]}, v array<double>"
    rows = points.select(F.col(by).alias("b"), F.col(key).alias("k"), F.col("v").cast("array<double>").alias("v"))
    rows = rows.withColumn("s", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).where("s > 0 and s < double('infinity')").drop("s")
    rows = stage_table(rows.withColumn("node", F.to_json(F.struct("b"))), "points")
    placed, levels, sizes = _grow(rows, fields, angle)
    size = F.least(F.greatest(F.col("n") / 16, F.lit(float(BLOCK))), F.lit(float(wide * BLOCK)))
    blocks = sizes.select("node", F.ceil(F.col("n") / size).cast("int").alias("blocks"), F.greatest(size, F.lit(float(BLOCK))).alias("size"))
    name = lambda i: F.concat(F.col("node"), F.lit("#"), i.cast("string"))
    placed = placed.join(blocks, "node").withColumn("leaf", name(F.pmod(F.xxhash64("k", F.lit("block")), F.col("blocks")))).select("b", "k", "v", "leaf")
    placed = stage_table(placed)
    visits = placed.withColumn("at", F.to_json(F.struct("b")))

    def descend(p: pd.DataFrame, below: pd.DataFrame) -> pd.DataFrame:
        if not len(p) or not len(below):
            return pd.DataFrame({c: [] for c in ("b", "k", "v", "leaf", "at")}, dtype=object)
        below = below.sort_values("child")
        to = _angles(_unit(p["v"]), np.array(below["pivot"].tolist()))
        i, j = np.nonzero((to <= below["radius"].to_numpy() + angle) & (to <= to.min(axis=1, keepdims=True) + 2 * angle))
        return pd.DataFrame({c: p[c].to_numpy()[i] for c in ("b", "k", "v", "leaf")} | {"at": below["child"].to_numpy()[j]})

    arrived = []
    for children in levels:
        inner = children.select(F.col("node").alias("at")).distinct()
        arrived.append(visits.join(inner, "at", "left_anti"))
        visits = visits.join(inner, "at", "left_semi")
        # A row may leave for every child: the more children, the smaller the groups.
        width = children.groupBy("node").agg(F.greatest(F.lit(1.0), F.count(F.lit(1)) / 8).alias("width"))
        here = visits.groupBy(F.col("at").alias("node")).agg(F.count(F.lit(1)).alias("n"))
        here = stage_table(here.join(width, "node").select("node", (F.col("n") * F.col("width")).alias("n")))
        both = _salted(visits, here, "at").groupBy("at", "salt").cogroup(_for_each_salt(children, here).withColumnRenamed("node", "at").groupBy("at", "salt"))
        visits = stage_table(both.applyInPandas(descend, f"{fields}, leaf string, at string"))
    visits = reduce(DataFrame.unionByName, [*arrived, visits]).withColumnRenamed("at", "node").join(blocks, "node")
    visits = visits.withColumn("to", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), name)))
    guests = visits.where("leaf < to").select("b", "k", "v", F.col("to").alias("leaf"), "size")
    if levels or sizes.where(F.col("n") > BLOCK).head(1):
        guests = stage_table(guests)
        parts = stage_table(guests.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.first("size")).cast("int").alias("parts")))
        guests = guests.join(parts, "leaf").withColumn("part", F.pmod(F.xxhash64("k", F.lit("part")), F.col("parts")).cast("int"))
        residents = placed.join(parts, "leaf", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
        tell = lambda r, guest: r.select("b", "k", "v", "leaf", "part", F.lit(guest).alias("guest"))
        return tell(residents, False).unionByName(tell(guests, True))
    drop_tables(rows)
    return placed.select("b", "k", "v", "leaf", F.lit(0).alias("part"), F.lit(False).alias("guest"))


def close_pairs(points: DataFrame, threshold: float, by: str = "role", key: str = "item") -> DataFrame:
    """points(by, key, v) -> by, a, b (a < b), distance for the pairs with cosine distance below the threshold. Zero vectors pair with none; keys are unique in a `by`."""
    kinds = dict(points.dtypes)
    angle = float(np.arccos(np.clip(1 - threshold, -1, 1))) + 1e-6

    def tell(p: pd.DataFrame, found: list) -> pd.DataFrame:
        k, (i, j, d) = p["k"].to_numpy(), (np.concatenate(c) for c in zip(*found))
        return pd.DataFrame({by: p["b"].iloc[np.zeros(len(i), dtype=int)].to_numpy(), "a": k[np.minimum(i, j)], "b": k[np.maximum(i, j)], "distance": d})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = pd.concat(list(batches), ignore_index=True).sort_values("k", kind="stable", ignore_index=True)
        x, guest = _unit(p.pop("v")), p["guest"].to_numpy()
        home = np.flatnonzero(~guest)
        xh, step, found, n = x[home], max(1, CELLS // max(1, len(home))), [], 0
        for mine in (np.flatnonzero(guest), home if not p["part"].iloc[0] else home[:0]):
            for at in range(0, len(mine), step):
                some = mine[at : at + step]
                d = 1 - x[some] @ xh.T
                near = d < threshold
                if not guest[some[0]]:
                    near &= some[:, None] < home
                i, j = np.nonzero(near)
                found.append((some[i], home[j], d[i, j]))
                n += len(i)
                if n > PAIRS:
                    yield tell(p, found)
                    found, n = [], 0
        if n:
            yield tell(p, found)

    groups = near_groups(points, angle, by, key, wide=8).groupBy("leaf", "part")
    return groups.applyInPandas(run, f"{by} {kinds[by]}, a {kinds[key]}, b {kinds[key]}, distance double")


def close_links(points: DataFrame, threshold: float, by: str = "role", key: str = "item") -> DataFrame:
    """points(by, key, v) -> by, a, b: some of close_pairs, of the same connected components. A group gives no more links than it has rows, however dense it is."""
    kinds = dict(points.dtypes)
    angle = float(np.arccos(np.clip(1 - threshold, -1, 1))) + 1e-6

    def run(p: pd.DataFrame) -> pd.DataFrame:
        x, k, guest = _unit(p["v"]), p["k"].to_numpy(), p["guest"].to_numpy()
        home = np.flatnonzero(~guest)
        near = np.zeros((len(p), len(home)), dtype=bool)
        for mine in (np.flatnonzero(guest), home if not p["part"].iloc[0] else home[:0]):
            near[mine] = 1 - x[mine] @ x[home].T < threshold
        a, b, left = [], [], np.ones(len(p), dtype=bool)
        for start in home:
            if not left[start]:
                continue
            # What is linked to start, step by step, each by the link that found it.
            left[start], edge = False, np.array([start])
            while len(edge):
                step = []
                for i in edge:
                    at = np.flatnonzero(home == i)
                    new = np.flatnonzero(near[:, at[0]] & left) if len(at) else np.empty(0, dtype=np.int64)
                    more = home[near[i] & left[home]]
                    new = np.unique(np.concatenate([new, more]))
                    left[new] = False
                    a += [k[i]] * len(new)
                    b += k[new].tolist()
                    step.append(new)
                edge = np.concatenate(step)
        return pd.DataFrame({by: p["b"].iloc[[0] * len(a)].to_numpy(), "a": pd.Series(a, dtype=object), "b": pd.Series(b, dtype=object)})

    groups = near_groups(points, angle, by, key).groupBy("leaf", "part")
    return groups.applyInPandas(run, f"{by} {kinds[by]}, a {kinds[key]}, b {kinds[key]}")
