"""Edge weights of a stream of triples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edge_counts(stream: DataFrame, time: str = "ts", window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Streaming triples(ts, subject, predicate, object) -> window, src, dst, weight, closed by the watermark."""
    t = stream.withWatermark(time, late).where("subject <> '' and object <> ''")
    grouped = t.groupBy(F.window(time, window).alias("window"), F.col("subject").alias("src"), F.col("object").alias("dst"))
    return grouped.agg(F.count(F.lit(1)).cast("double").alias("weight"))


def fold_batch(path: str):
    """For foreachBatch: each batch's collapsed edges are one table under path, replaced if the batch comes again."""

    def write(batch: DataFrame, epoch: int) -> None:
        edges = batch.where("subject <> '' and object <> ''").groupBy(F.col("subject").alias("src"), F.col("object").alias("dst")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
        edges.write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return write


def folded(spark, path: str) -> DataFrame:
    """The edges of all batches so far."""
    return spark.read.parquet(path).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
