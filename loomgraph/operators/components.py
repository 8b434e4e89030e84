"""Connected components over a table of links, by contraction in DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stage_table


def connected_components(links: DataFrame, joins: str | None = None) -> DataFrame:
    """(u, v) links -> (node, root), root being the smallest node of the component.

    Each round hooks every node to its smallest neighbour, shortens the resulting
    chains by pointer jumping and contracts the links to the roots, so the number of
    rounds is logarithmic in the longest path. Hubs cost no more than other nodes:
    minima are pre-aggregated before their shuffle, and no neighbour list is built.
    joins: a hint for all joins, such as merge, where no table may go through the driver.
    Null ends and self-links are left out. No links give an empty result.
    """
    told = lambda side: side if joins is None else side.hint(joins)
    links = links.where("u is not null and v is not null and u <> v")
    edges = stage_table(links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    roots = None
    while edges.head(1):
        both = edges.union(edges.select("v", "u"))
        hooks = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("root"))
        hooks = stage_table(hooks)
        while True:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("upper"))
            jumped = stage_table(hooks.join(told(up), "root").select("node", F.col("upper").alias("root"), (F.col("upper") != F.col("root")).alias("moved")))
            moved = jumped.where("moved").head(1)
            hooks = jumped.select("node", "root")
            if not moved:
                break
        if roots is None:
            roots = hooks
        else:
            roots = roots.join(told(hooks.select(F.col("node").alias("root"), F.col("root").alias("upper"))), "root", "left")
            roots = stage_table(roots.select("node", F.coalesce("upper", "root").alias("root")))
        a = hooks.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        b = hooks.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        edges = edges.join(told(a), "u").join(told(b), "v").where("ru <> rv")
        edges = stage_table(edges.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) if roots is None else roots
