"""Answers to structured calls that outlive the run that asked for them."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import drop_tables, stage_table

FIELDS = "call string, ok boolean, payload string, error string"


class Ledger:
    """An append-only table of answers, keyed by a digest of the step, the provider's settings and all that the call is told.

    Calls whose key has an answer are not made again, also by another run over another
    corpus in the same folder; failed ones are. A task's answers are in the table as soon
    as it ends, even if the job fails later: files move there when a task commits. So at
    most `calls_per_task` answers a running task are lost with a run. max_tasks, if given,
    bounds the tasks that make calls at the same time.
    """

    def __init__(self, spark: SparkSession, folder: str, calls_per_task: int = 32, max_tasks: int = 0):
        self.spark, self.path, self.calls_per_task, self.max_tasks = spark, folder.rstrip("/"), calls_per_task, max_tasks
        target = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
            self._append(spark.createDataFrame([], FIELDS))

    def _append(self, rows: DataFrame) -> None:
        rows.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(self.path)

    def key(self, step: str, settings: dict, told: tuple, columns: tuple[str, ...]) -> Column:
        """Of a call that is told the columns of its row and, with all rows, `told`."""
        head = json.dumps([step, settings, told], sort_keys=True, default=str, ensure_ascii=False)
        return F.sha2(F.concat(F.lit(head), F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})).cast("binary"), 256)

    def answers(self) -> DataFrame:
        """call, ok, payload, error: one row a key, an answer rather than a failure."""
        rows = self.spark.read.schema(FIELDS).parquet(self.path)
        return rows.groupBy("call").agg(F.max(F.struct("ok", "payload", "error")).alias("a")).select("call", "a.*")

    def parts(self, calls: int) -> int:
        return max(1, -(-calls // self.calls_per_task))

    def complete(self, rows: DataFrame, ask) -> DataFrame:
        """rows(call, ...) with ok, payload and error; ask(rows) -> call, ok, payload, error makes the calls that are missing."""
        rows = stage_table(rows, "calls")
        known = self.answers().where("ok").select("call")
        todo = stage_table(rows.join(known, "call", "left_anti").dropDuplicates(["call"]), "todo")
        calls = todo.count()
        if calls:
            parts = self.parts(calls)
            turns = -(-parts // self.max_tasks) if self.max_tasks else 1
            for turn in range(turns):
                some = todo.where(F.pmod(F.xxhash64("call"), F.lit(turns)) == turn) if turns > 1 else todo
                self._append(ask(some.repartition(min(parts, self.max_tasks or parts))))
        drop_tables(todo)
        return rows.join(self.answers(), "call", "left")
