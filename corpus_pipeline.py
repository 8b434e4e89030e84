"""Documents to token ids, in five stages.

toxicity: documents predicted toxic go. ngram_join: of documents that links of four-word
shingles connect, the one with the smallest doc_id stays. personal_data: found spans are
masked in the text. mixing: each document is repeated by its copies, none to three. bpe:
the texts are encoded, decoded and digested.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of
documents. run() writes each stage's result as Parquet and reads it back. Null, empty
and blank texts pass the first three stages and have no copies in the fourth; rows
without doc_id pass the second, as nothing tells them apart; repeated rows go or stay
together, but for the second stage, which keeps one. Extra columns pass unread, whatever
their names. An empty table stays empty.

The stages that work on texts in Python set the session's limit of rows in an Arrow batch
to BATCH_ROWS, where it is higher: a batch is held by the executor's JVM and by its
workers, several times over. It stays so when stages are called one by one, as what they
return is run later; run() puts it back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm.byte_bpe import encode_decode, read_ranks
from loomgraph.llm.common import read_table, shared_table
from loomgraph.llm.mixing import mix_documents
from loomgraph.llm.ngram_join import keep_one
from loomgraph.llm.pii import mask_documents
from loomgraph.llm.toxicity import drop_toxic

#: Rows of an Arrow batch at most, some megabytes of text.
BATCH_ROWS = 1_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"), threshold=0.5)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return keep_one(docs, width=4, percent=85)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mask_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs, weights=(1, 2, 3))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return encode_decode(docs, read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity), ("ngram_join", ngram_join), ("personal_data", personal_data), ("mixing", mixing), ("bpe", bpe)]

#: Models, masks and token ids can't be expressed in SQL; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    before = spark.conf.get(BATCH_SETTING)
    try:
        for name, stage in STAGES:
            docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    finally:
        spark.conf.set(BATCH_SETTING, before)
    return docs
