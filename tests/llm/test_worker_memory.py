"""What the pipeline's tasks leave in an executor's memory."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest

import corpus_pipeline

ROOT = Path(__file__).resolve().parents[2]
WORKER = """
import re
import pyarrow as pa
from loomgraph.llm.common import lean

def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

pins = []
def run(batches):
    for b in batches:
        some = [bytes(1000) for _ in range(100_000)]
        pins.append(some[-1])  # what is freed below it stays with the C library
        batch = pa.record_batch({"text": ["x" * 1000] * 50_000})
        yield b

rows = pa.record_batch({"doc_id": [1, 2]})
before = held()
out = list(RUN(iter([rows, rows])))
assert out == [rows, rows]
print(held() - before)
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_a_task_gives_freed_memory_back():
    kept = {name: float(subprocess.run([sys.executable, "-c", WORKER.replace("RUN", name)], cwd=ROOT, capture_output=True, text=True, check=True).stdout) for name in ("run", "lean(run)")}
    assert kept["lean(run)"] < 20 < 60 < kept["run"]


def test_stages_work_on_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(b)], pa.int64())})

    before = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    docs = spark.range(3_500, numPartitions=1).selectExpr("id as doc_id", "concat('text ', id) as text")
    try:
        assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) > 1_000
        corpus_pipeline.bpe(spark, docs, "")
        found = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
        assert sum(found) == 3_500 and max(found) <= 1_000
        spark.conf.set(corpus_pipeline.BATCH_SETTING, "200")  # a lower limit stays
        corpus_pipeline.bpe(spark, docs, "")
        assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == "200"
    finally:
        spark.conf.set(corpus_pipeline.BATCH_SETTING, before)
