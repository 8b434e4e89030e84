"""Themes: frequency ranking, prompt blocks, consolidation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, title_key


def theme_frequency(themes: DataFrame) -> DataFrame:
    """themes(ord, title, description, reasoning) -> key, freq, first_ord and the first spelling's fields."""
    first = F.min_by(F.struct("title", "description", "reasoning"), "ord")
    t = themes.groupBy(title_key(F.col("title")).alias("key")).agg(F.count(F.lit(1)).alias("freq"), F.min("ord").alias("first_ord"), first.alias("f"))
    return t.select("key", "freq", "first_ord", "f.*")


def theme_blocks(frequency: DataFrame) -> DataFrame:
    """One row: the blocks of all themes, most frequent first. The number of distinct themes bounds its size."""
    block = F.format_string("Title: %s (Frequency: %d)\nDescription: %s\nReasoning: %s", "title", "freq", "description", "reasoning")
    ranked = frequency.select(F.struct((-F.col("freq")).alias("a"), F.col("first_ord").alias("b"), block.alias("block")).alias("r"))
    rows = F.sort_array(F.collect_list("r"))
    return ranked.agg(F.array_join(F.transform(rows, lambda r: r["block"]), "\n\n").alias("blocks"), F.count(F.lit(1)).alias("n_themes"))


def consolidate(frequency: DataFrame, default_domain: str = "General") -> DataFrame:
    """One row (master_domain, master_themes): the offline stand-in for a model takes the most frequent title as domain. Without themes the default domain."""
    ranked = frequency.select(F.struct((-F.col("freq")).alias("a"), F.col("first_ord").alias("b"), strip(F.col("title")).alias("t")).alias("r"))
    titles = F.transform(F.sort_array(F.collect_list("r")), lambda r: r["t"])
    return ranked.agg(titles.alias("master_themes")).select(F.coalesce(F.get("master_themes", F.lit(0)), F.lit(default_domain)).alias("master_domain"), "master_themes")
