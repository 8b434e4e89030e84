"""Vectors of strings that outlive the run that encoded them."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.embedding import encode
from ..storage import drop_tables, stage_table

FIELDS = "string_key string, v array<double>"


class VectorStore:
    """An append-only table of vectors for each encoder, keyed by a digest of the string.

    Strings that have a vector are not encoded again, also by another run over a grown
    corpus in the same folder. `revision` tells versions of a model with the same name
    apart. A task's vectors are in the table as soon as it ends, even if the job fails
    later; what was written twice counts once. Null strings have a null vector and are
    not encoded; an empty string is a string.
    """

    def __init__(self, spark: SparkSession, folder: str, encoder: str = "offline", revision: str = ""):
        name = hashlib.sha256(json.dumps([encoder, revision]).encode()).hexdigest()[:32]
        self.spark, self.encoder, self.path = spark, encoder, f"{folder.rstrip('/')}/encoder-{name}"
        target = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
            self._append(spark.createDataFrame([], FIELDS))

    def _append(self, rows: DataFrame) -> None:
        rows.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(self.path)

    def vectors(self) -> DataFrame:
        """string_key, v: one row a string. It is dealt by the key, so a join on it deals these rows no second time."""
        return self.spark.read.schema(FIELDS).parquet(self.path).dropDuplicates(["string_key"])

    def encode(self, items: DataFrame) -> DataFrame:
        """items(item, ...) with a column `v`, in the order of columns that `encode` has. A string is encoded once however many rows have it; a hot string's rows meet its one vector in a join that adaptive execution splits."""
        if {"string_key", "v"} & set(items.columns):
            raise ValueError("string_key and v are columns of the store")
        keyed = items.withColumn("string_key", F.sha2(F.col("item").cast("binary"), 256))
        strings = keyed.where("string_key is not null").groupBy("string_key").agg(F.first("item").alias("item"))
        todo = stage_table(strings.join(self.vectors().select("string_key"), "string_key", "left_anti"), "strings")
        if not todo.isEmpty():
            self._append(encode(todo, self.encoder).select("string_key", "v"))
        drop_tables(todo)
        return keyed.join(self.vectors(), "string_key", "left").select(*items.columns, "v")
