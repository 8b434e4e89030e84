"""The hypergraph of entities and themes, as sparse rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import theme_or_other
from ..storage import stage_table
from .community import detect_communities

HUB = 4_096


def memberships(triples: DataFrame) -> DataFrame:
    """Distinct (entity, theme). Empty entities stay."""
    theme = theme_or_other(F.col("theme_association"))
    return triples.select(F.explode(F.array("subject", "object")).alias("entity"), theme.alias("theme")).distinct()


def indexed(values: DataFrame, columns: tuple[str, ...], name: str, by: str | None = None) -> DataFrame:
    """The distinct values of the columns with dense indices from 0 in sorted order, by the first column apart if `by` names it. No task holds all rows: ranges are sorted apart and start after the counts of those before."""
    rows = values.select(*columns).distinct().repartitionByRange(*columns).withColumn("_part", F.spark_partition_id())
    group = ("_part", by) if by else ("_part",)
    rows = stage_table(rows.withColumn("_at", F.row_number().over(Window.partitionBy(*group).orderBy(*columns))), "index")
    # A row a range (and value of `by`): as many as tasks.
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    order = (Window.partitionBy(by) if by else Window.partitionBy(F.lit(0))).orderBy("_part")
    before = counts.select(*group, (F.sum("n").over(order) - F.col("n")).alias("_base"))
    return rows.join(before, list(group)).select(*columns, (F.col("_base") + F.col("_at") - 1).alias(name))


def incidence(members: DataFrame) -> DataFrame:
    """entity, theme, entity_idx, theme_idx, value = 1.0."""
    out = members.join(indexed(members, ("entity",), "entity_idx"), "entity").join(indexed(members, ("theme",), "theme_idx"), "theme")
    return out.select("entity", "theme", "entity_idx", "theme_idx", F.lit(1.0).alias("value"))


def entity_degree(members: DataFrame) -> DataFrame:
    return members.groupBy("entity").agg(F.count(F.lit(1)).alias("degree"))


def _pairs(members: DataFrame, over: str, of: str) -> DataFrame:
    """(a, b, shared): for values a, b of `of`, in how many values of `over` they are together, a = b included.

    A hub of `over` has as many pairs as its members squared, and they are the result's;
    but no task makes them alone: its members are dealt to tiles of two blocks each.
    """
    sizes = stage_table(members.groupBy(over).agg(F.ceil(F.count(F.lit(1)) / HUB).cast("int").alias("n")), "hubs")
    rows = members.join(sizes, over).withColumn("at", F.pmod(F.xxhash64(of), F.col("n")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    a = rows.select(over, F.col("at").alias("i"), every.alias("j"), F.col(of).alias("a"))
    b = rows.select(over, every.alias("i"), F.col("at").alias("j"), F.col(of).alias("b"))
    return a.join(b, [over, "i", "j"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))


def laplacian(members: DataFrame) -> DataFrame:
    """Non-zero entries: -(number of shared themes) for different entities; the diagonal is zero."""
    both = _pairs(members, "theme", "entity").where("a <> b")
    return both.select(F.col("a").alias("row"), F.col("b").alias("col"), (-F.col("shared")).cast("double").alias("value"))


def theme_overlap(members: DataFrame) -> DataFrame:
    """theme_a, theme_b, shared entities; the diagonal holds the themes' sizes."""
    return _pairs(members, "entity", "theme").select(F.col("a").alias("theme_a"), F.col("b").alias("theme_b"), "shared")


def containment_candidates(members: DataFrame, threshold: float) -> DataFrame:
    """(parent, child) pairs of themes, among them all of which the parent holds the threshold of the child's entities.

    With a child's entities from the rarest on, a parent that holds k of s must hold one
    of the first s - k + 1. So a child is looked up by these alone, and what many themes
    share brings few together.
    """
    size = members.groupBy("theme").agg(F.count(F.lit(1)).alias("size"))
    rare = members.join(entity_degree(members), "entity").select("theme", "degree", "entity")
    ranked = indexed(rare, ("theme", "degree", "entity"), "at", by="theme").join(size, "theme")
    first = ranked.where(F.col("at") <= F.col("size") - F.ceil(threshold * F.col("size") - 1e-9))
    pairs = first.select(F.col("theme").alias("child"), "entity").join(members.select(F.col("theme").alias("parent"), "entity"), "entity")
    return pairs.where("parent <> child").select("parent", "child").distinct()


def theme_inheritance(members: DataFrame, threshold: float = 0.80) -> DataFrame:
    """(parent, child, shared, share) where the parent holds at least threshold of the child's entities. Only pairs that rare entities bring together are counted, not all that overlap."""
    if threshold <= 0:
        raise ValueError("the threshold must be positive")
    members = stage_table(members.select("entity", "theme"), "members")
    pairs = stage_table(containment_candidates(members, threshold), "candidates")
    held = pairs.join(members.select(F.col("theme").alias("child"), "entity"), "child").join(members.select(F.col("theme").alias("parent"), "entity"), ["parent", "entity"])
    shared = held.groupBy("parent", "child").agg(F.count(F.lit(1)).alias("shared"))
    size = members.groupBy(F.col("theme").alias("child")).agg(F.count(F.lit(1)).alias("size"))
    return shared.join(size, "child").withColumn("share", F.col("shared") / F.col("size")).where(F.col("share") >= threshold).select("parent", "child", "shared", "share")


def inheritance_map(inheritance: DataFrame) -> DataFrame:
    return inheritance.groupBy("parent").agg(F.array_sort(F.collect_list("child")).alias("children"))


def degree_centrality(members: DataFrame) -> DataFrame:
    """kind, label, centrality of the vertices of the bipartite graph: degree / (vertices - 1). A single vertex has 1."""
    e = members.groupBy(F.lit("entity").alias("kind"), F.col("entity").alias("label")).agg(F.count(F.lit(1)).alias("degree"))
    t = members.groupBy(F.lit("theme").alias("kind"), F.col("theme").alias("label")).agg(F.count(F.lit(1)).alias("degree"))
    both = e.union(t)
    n = both.agg(F.count(F.lit(1)).alias("n"))
    return both.crossJoin(F.broadcast(n)).select("kind", "label", F.when(F.col("n") > 1, F.col("degree") / (F.col("n") - 1)).otherwise(1.0).alias("centrality"))


def bipartite_edges(members: DataFrame) -> DataFrame:
    """src, dst, weight of the bipartite graph: entities and themes as nodes of their own kind, each membership in both directions, so that the directed objective is the undirected one."""
    entity, theme = F.concat(F.lit("entity:"), F.col("entity")), F.concat(F.lit("theme:"), F.col("theme"))
    rows = members.select(entity.alias("src"), theme.alias("dst"))
    return rows.union(rows.select("dst", "src")).select("src", "dst", F.lit(1.0).alias("weight"))


def bipartite_communities(members: DataFrame, resolution: float = 1.0) -> DataFrame:
    """kind, label, community: the communities of entities and themes together."""
    found = detect_communities(bipartite_edges(members), resolution)
    cut = F.instr("node", ":")
    return found.select(F.substring_index("node", ":", 1).alias("kind"), F.col("node").substr(cut + 1, F.length("node")).alias("label"), "community")


def counts(triples: DataFrame, members: DataFrame) -> DataFrame:
    """One row: nodes and collapsed edges of the graph, entities, themes and memberships of the hypergraph."""
    ends = triples.where("subject <> '' and object <> ''").select("subject", "object").distinct()
    graph = ends.agg(F.count(F.lit(1)).alias("edges"))
    nodes = ends.select(F.explode(F.array("subject", "object")).alias("node")).agg(F.countDistinct("node").alias("nodes"))
    hyper = members.agg(F.countDistinct("entity").alias("entities"), F.countDistinct("theme").alias("themes"), F.count(F.lit(1)).alias("memberships"))
    return nodes.crossJoin(graph).crossJoin(hyper)
