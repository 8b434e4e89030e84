"""Average-linkage clustering of the items of each role by cosine distance.

Only pairs closer than the threshold are linked; their connected components hold every
merge, as an average below the threshold needs one such pair. Each component is then
clustered exactly by itself: a small one by a task, a large one in rounds of merges.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import order_key
from ..storage import drop_tables, stage_table
from .components import connected_components
from .embedding import choose_by_rows, project, spectra, spectrum, weighted_moments
from .hypergraph import indexed
from .metric_tree import close_links, near_groups

#: Components of at most so many items are clustered by one task each, from a matrix of distances of some 72 MB at most.
MOST_ITEMS = 3_000
DIGITS = 12


def average_linkage(x: np.ndarray, threshold: float) -> np.ndarray:
    """Cluster numbers by first member. Nearest-neighbour chains with the averaging update; merges strictly below the threshold."""
    n = len(x)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = 1 - unit @ unit.T
    np.fill_diagonal(d, np.inf)
    size, alive, parent = np.ones(n), np.ones(n, dtype=bool), np.arange(n)
    chain: list[int] = []
    frozen = np.zeros(n, dtype=bool)
    while True:
        if not chain:
            left = np.flatnonzero(alive & ~frozen)
            if not len(left):
                break
            chain = [int(left[0])]
        a = chain[-1]
        row = np.where(alive, d[a], np.inf)
        row[a] = np.inf
        b = int(np.argmin(row))
        if len(chain) > 1 and row[chain[-2]] <= row[b]:
            b = chain[-2]
        if not row[b] < threshold:
            # What is nearest to the end of a chain only gets farther: it never merges.
            frozen[a] = True
            chain.pop()
            continue
        if len(chain) > 1 and b == chain[-2]:
            chain = chain[:-2]
            keep, gone = min(a, b), max(a, b)
            d[keep] = (size[keep] * d[keep] + size[gone] * d[gone]) / (size[keep] + size[gone])
            d[:, keep] = d[keep]
            d[keep, keep] = np.inf
            size[keep] += size[gone]
            alive[gone] = False
            parent[gone] = keep
        else:
            chain.append(b)
    root = np.arange(n)
    for i in range(n):
        while parent[root[i]] != root[i]:
            root[i] = parent[root[i]]
    order = {r: k for k, r in enumerate(dict.fromkeys(root))}
    return np.array([order[r] for r in root])


def _nearest(p: pd.DataFrame, threshold: float, turn: int) -> pd.DataFrame:
    """(k, other, d) for each row of a group of near_groups: the row of least average distance in the group, if that is below the threshold. Of equal ones a hash of the pair chooses, the same on both sides."""
    x, k, guest = np.array(p["v"].tolist(), dtype=np.float64), p["k"].to_numpy(), p["guest"].to_numpy()
    home = np.flatnonzero(~guest)
    mark = np.array([zlib.crc32(f"{turn} {i}".encode()) for i in k], dtype=np.uint64)
    found = []
    for mine in (np.flatnonzero(guest), home if not p["part"].iloc[0] else home[:0]):
        d = np.round(1 - x[mine] @ x[home].T, DIGITS)
        d[mine[:, None] == home[None, :]] = np.inf
        for rows, columns, e in ((mine, home, d), (home, mine, d.T)) if len(mine) and guest[mine[0]] else ((mine, home, d),):
            if not len(rows) or not len(columns):
                continue
            least = e.min(axis=1)
            for i in np.flatnonzero(least < threshold):
                same = columns[e[i] == least[i]]
                tie = (mark[same] + mark[rows[i]]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
                j = np.lexsort((same, tie))[0]
                found.append((k[rows[i]], k[same[j]], least[i], int(tie[j])))
    return pd.DataFrame(found, columns=["k", "other", "d", "tie"])


def _turn(threshold: float, turn: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda p: _nearest(p, threshold, turn)


def linkage_rounds(points: DataFrame, threshold: float, by: str = "part", key: str = "node") -> DataFrame:
    """points(by, key, v) -> key, head: the clusters of average_linkage for parts of any size, head being one of the cluster's keys.

    A cluster is a row: the mean of its unit vectors and its size, as the average of
    1 - u.v over all pairs of two clusters is 1 less the product of their means. Each
    round finds every cluster's nearest one in the groups of a metric tree and merges
    those that are each other's nearest; average distances never put a merged pair
    nearer to a third, so these are the merges of the plain method. A cluster with none
    below the threshold never merges and leaves. Equal vectors are one from the start.
    Among exactly equal distances the order of merges is by hash. Keys are unique.
    """
    # Means are no longer than one, so their angle is at most that of unit vectors of the same product, if that is positive.
    angle = float(np.arccos(1 - threshold)) + 1e-6 if threshold <= 1 else float(np.pi)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    unit = points.select(F.col(by).alias("part"), F.col(key).alias("node"), F.transform("v", lambda x: x / norm).alias("v"))
    equal = stage_table(unit.groupBy("part", "v").agg(F.min("node").alias("id"), F.count(F.lit(1)).cast("double").alias("size")))
    labels = stage_table(unit.join(equal.select("part", "v", "id"), ["part", "v"]).select("node", F.col("id").alias("head")))
    state = equal.select("part", "id", "v", "size")
    kind = dict(state.dtypes)["id"]
    for turn in itertools.count():
        groups = near_groups(state, angle, "part", "id").groupBy("leaf", "part")
        found = groups.applyInPandas(_turn(threshold, turn), f"k {kind}, other {kind}, d double, tie long")
        best = stage_table(found.groupBy("k").agg(F.min(F.struct("d", "tie", "other"))["other"].alias("other")))
        back = best.select(F.col("k").alias("other"), F.col("other").alias("k"))
        pairs = stage_table(best.join(back, ["k", "other"]).where("k < other").select(F.col("k").alias("id"), F.col("other").alias("gone")))
        if not pairs.head(1):
            return labels
        kept = state.join(best.select(F.col("k").alias("id")), "id", "left_semi").join(pairs.select(F.col("gone").alias("id")), "id", "left_anti").join(pairs, "id", "left")
        other = state.select(F.col("id").alias("gone"), F.col("v").alias("w"), F.col("size").alias("more"))
        all_of = F.col("size") + F.coalesce("more", F.lit(0.0))
        mean = F.when(F.col("more").isNull(), F.col("v")).otherwise(F.zip_with("v", "w", lambda a, b: (a * F.col("size") + b * F.col("more")) / all_of))
        after = stage_table(kept.join(other, "gone", "left").select("part", "id", mean.alias("v"), all_of.alias("size")))
        moved = pairs.select(F.col("gone").alias("head"), F.col("id").alias("up"))
        renamed = stage_table(labels.join(moved, "head", "left").select("node", F.coalesce("up", "head").alias("head")))
        drop_tables(state, labels, best, pairs)
        state, labels = after, renamed


def cluster_items(points: DataFrame, threshold: float = 0.15, projection: str = "centered_pca", most: int = MOST_ITEMS) -> DataFrame:
    """points(role, item, n, first_ord, v) -> role, cluster_id, item_idx, item; clusters and members by first appearance.

    With centered_pca, items are centred by their weighted mean and projected on the
    chosen components first; an item that then is zero puts its whole role into one
    cluster. A component of at most `most` items is one task's, a larger one is clustered
    in rounds that no task holds.
    """
    # First appearances may be of any type that sorts; from here on they are strings that sort alike.
    first = order_key(F.col("first_ord"), points.schema["first_ord"].dataType)
    points = stage_table(points.select("role", "item", "n", first.alias("first_ord"), "v"), "points")
    if projection == "centered_pca":
        moments = weighted_moments(points)
        rows = points.sparkSession.createDataFrame(spectra(moments), "role string, k int, ev double")
        count = {r["role"]: r["components"] for r in choose_by_rows(rows).collect()}
        bases = {}
        for role, m in moments.items():
            mean, _, vectors = spectrum(*m)
            bases[role] = mean, vectors[:, : count[role]]
        points = stage_table(project(points, bases), "projected")
    single = points.groupBy("role").agg(F.max((F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x) <= 1e-24).cast("int")).alias("whole"), F.count(F.lit(1)).alias("items"))
    single = single.select("role", ((F.col("whole") == 1) & (F.col("items") > 1)).alias("whole"))
    points = points.join(single, "role")
    links = close_links(points.where("not whole").select("role", "item", "v"), threshold)
    key = lambda c: F.to_json(F.struct(F.col("role").alias("r"), F.col(c).alias("i")))
    roots = connected_components(links.select(key("a").alias("u"), key("b").alias("v")))
    named = points.withColumn("node", key("item")).join(roots, "node", "left")
    named = named.withColumn("part", F.when(F.col("whole"), F.lit("")).otherwise(F.coalesce("root", "node")))

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["first_ord", "item"], kind="stable")
        if len(p) == 1 or bool(p["whole"].iloc[0]):
            label = np.zeros(len(p), dtype=int)
        else:
            label = average_linkage(np.array(p["v"].tolist()), threshold)
        first = p["node"].to_numpy()[[int(np.flatnonzero(label == k)[0]) for k in label]]
        return pd.DataFrame({c: p[c].to_numpy() for c in ("role", "item", "first_ord")} | {"head": first})[["role", "head", "item", "first_ord"]]

    named = stage_table(named.select("role", "part", "whole", "node", "item", "first_ord", "v"), "named")
    many = stage_table(named.groupBy("role", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("role", "part"))
    large = named.join(many, ["role", "part"], "left_semi")
    out = named.join(many, ["role", "part"], "left_anti").groupBy("role", "part").applyInPandas(run, "role string, head string, item string, first_ord string")
    if many.head(1):
        out = out.unionByName(large.where("whole").select("role", F.col("part").alias("head"), "item", "first_ord"))
        rounds = linkage_rounds(large.where("not whole"), threshold)
        out = out.unionByName(large.join(rounds, "node").select("role", "head", "item", "first_ord"))
    out = stage_table(out, "clusters")
    heads = out.groupBy("role", "head").agg(F.min(F.struct("first_ord", "item")).alias("first"))
    heads = heads.select("role", "head", "first.first_ord", "first.item")
    number = indexed(heads, ("role", "first_ord", "item"), "cluster_id", by="role")
    heads = heads.join(number, ["role", "first_ord", "item"]).select("role", "head", F.col("cluster_id").cast("int").alias("cluster_id"))
    at = F.row_number().over(Window.partitionBy("role", "head").orderBy("first_ord", "item")) - 1
    return out.withColumn("item_idx", at).join(heads, ["role", "head"]).select("role", "cluster_id", "item_idx", "item")
