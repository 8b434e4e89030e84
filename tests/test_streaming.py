import sys

from pyspark import cloudpickle

from loomgraph.operators import model_calls
from loomgraph.sources.providers import OfflineProvider
from loomgraph.streaming import edges as E
from loomgraph.streaming import registry

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this module


def test_batches_fold(spark, tmp_path):
    rows = [("2024-01-01 00:01:00", "a", "p", "b"), ("2024-01-01 00:02:00", "a", "q", "b"), ("2024-01-01 00:09:00", "b", "p", "c"), ("2024-01-01 00:09:00", "", "p", "c")]
    t = spark.createDataFrame(rows, "t string, subject string, predicate string, object string").selectExpr("cast(t as timestamp) ts", "subject", "predicate", "object")
    t.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(t.schema).parquet(str(tmp_path / "in"))
    q = stream.writeStream.foreachBatch(E.fold_batch(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {(r.src, r.dst): r.weight for r in E.folded(spark, str(tmp_path / "out")).collect()}
    assert got == {("a", "b"): 2.0, ("b", "c"): 1.0}
    q = E.edge_counts(stream).writeStream.format("memory").queryName("w").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert {(r.src, r.dst, r.weight) for r in spark.table("w").collect()} == {("a", "b", 2.0), ("b", "c", 1.0)}


def test_registry_outlives_a_restart(spark, tmp_path):
    """Chunks of documents over several batches and two starts: the answers of the batch form."""

    class Recording(OfflineProvider):
        def triples(self, text, domain, themes, entities):
            if text == "down":
                raise RuntimeError("down")
            return {"triples": [{"subject": text, "predicate": "knows", "object": "|".join(entities) or "-", "source_quote": text, "certainty_score": 1}]}

    name, store = registry.STORE
    before = spark.conf.get(name)
    spark.conf.set(name, store)
    try:
        schema = "doc_id long, chunk_idx int, chunk string"
        rows = [[(1, 0, "a"), (2, 0, "x")], [(1, 2, "c"), (1, 1, "b")], [(1, 3, "down"), (2, 1, "y"), (3, 0, "z")], [(1, 4, "d"), (2, 2, "a")]]
        for start in (rows[:2], rows[2:]):
            for batch in start:
                spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
            found = registry.stream_triples(stream, Recording(), registry=3)
            query = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
            query.awaitTermination(300)
            assert query.exception() is None
        whole = spark.createDataFrame([r for batch in rows for r in batch], schema)
        want = sorted(map(tuple, model_calls.triple_answers(whole, Recording(), registry=3).collect()))
        got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select("doc_id", "chunk_idx", "ok", "payload", "error").collect()))
        assert got == want and any("-|b|a|-" in (r[3] or "") for r in got) and sum(not r[2] for r in got) == 1
    finally:
        spark.conf.set(name, before)
