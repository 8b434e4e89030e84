"""Normalization of triple strings, and role-specific lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import preprocess
from .hypergraph import indexed
from .triples import ROLES, role_items


def token_batches(items: DataFrame, size: int = 50) -> DataFrame:
    """Distinct items of each role in sorted order, numbered into batches; by ranges, so no task holds a whole role."""
    rows = indexed(items, ("role", "item"), "at", by="role")
    return rows.select("role", "item", F.floor(F.col("at") / size).cast("int").alias("batch"))


def normalization_details(triples: DataFrame) -> DataFrame:
    """Each (role, original) with its normalized string, whether it changed, and its first place."""
    rows = role_items(triples).groupBy("role", "item").agg(F.min(F.struct("ord", "role_pos")).alias("first"))
    done = rows.select("role", F.col("item").alias("original"), preprocess(F.col("item")).alias("normalized"), F.col("first.ord").alias("first_ord"))
    return done.withColumn("was_changed", F.col("original") != F.col("normalized"))


def normalize_triples(triples: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Preprocess the three roles, then look each up in mapping(role, original, normalized), unique on (role, original); a miss stays. Raw strings stay in raw_ columns. A frequent string's rows are one partition of the join, which adaptive execution splits, as the mapping's side is not summed."""
    out = triples.select("*", *(F.col(r).alias(f"raw_{r}") for r in ROLES))
    out = out.withColumns({r: preprocess(F.col(r)) for r in ROLES})
    if mapping is None:
        return out
    for r in ROLES:
        m = mapping.where(F.col("role") == r).select(F.col("original").alias(r), F.col("normalized").alias("_new"))
        out = out.join(m, r, "left").withColumn(r, F.coalesce("_new", r)).drop("_new")
    return out


def resolve_names(triples: DataFrame, mapping: DataFrame) -> DataFrame:
    """Look up each role in mapping(role, member, label), unique on (role, member); a miss stays, an empty string is not looked up. `hit` marks rows with a hit, identity ones included."""
    out = triples.withColumn("hit", F.lit(False))
    for r in ROLES:
        m = mapping.where((F.col("role") == r) & (F.col("member") != "")).select(F.col("member").alias(r), F.col("label").alias("_label"))
        out = out.join(m, r, "left").withColumn("hit", F.col("hit") | F.col("_label").isNotNull()).withColumn(r, F.coalesce("_label", r)).drop("_label")
    return out


def recent_entities(triples: DataFrame, limit: int = 100, group: str = "doc_id") -> DataFrame:
    """The latest entities of each document by first appearance, subjects before objects of one triple."""
    cells = F.array(F.struct(F.lit(0).alias("pos"), F.col("subject").alias("entity")), F.struct(F.lit(1).alias("pos"), F.col("object").alias("entity")))
    seen = triples.select(group, "ord", F.explode(cells).alias("c")).groupBy(group, F.col("c.entity").alias("entity")).agg(F.min(F.struct("ord", "c.pos")).alias("first"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("first")))
    return seen.withColumn("rank", rank).where(F.col("rank") <= limit).select(group, "entity", "rank")
