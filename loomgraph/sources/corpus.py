"""Corpora as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hypergraph import indexed


def text_files(spark: SparkSession, folder: str, patterns: tuple[str, ...] = ("*.txt", "*.md")) -> DataFrame:
    """A row per whole UTF-8 file of the folder itself: doc_id by pattern and path, text, path."""
    rows = None
    for i, pattern in enumerate(patterns):
        part = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "false").text(folder, wholetext=True)
        part = part.select(F.lit(i).alias("pattern"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
        rows = part if rows is None else rows.union(part)
    number = indexed(rows, ("pattern", "path"), "doc_id")  # of the names alone: texts are read once, for the join
    return rows.join(number, ["pattern", "path"]).select("doc_id", "text", "path")


def in_memory(spark: SparkSession, texts: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
