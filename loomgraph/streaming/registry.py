"""Triple extraction from a stream of chunks, with each document's registry of entities as state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.model_calls import CALL, _latest, entities_of
from ..sources.providers import call

#: State of several variables a key needs this store.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Registry(StatefulProcessor):
    """The entities of a document so far, by first appearance: one state row each, appended as they come."""

    def __init__(self, provider, domain: str, themes: str, registry: int):
        self.told = provider, domain, themes, registry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getListState("known", "entity string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        provider, domain, themes, registry = self.told
        entities = dict.fromkeys(r[0] for r in self.known.get()) if self.known.exists() else {}
        new, out = [], []
        for chunk_idx, chunk in sorted((int(i), c) for p in rows for i, c in zip(p["chunk_idx"], p["chunk"])):
            ok, payload, error = call(provider.triples, chunk, domain, themes, _latest(entities, registry))
            for name in entities_of(payload) if ok else ():
                if name not in entities:
                    entities[name] = None
                    new.append((name,))
            out.append((key[0], chunk_idx, ok, payload, error))
        if new:
            self.known.appendList(new)
        yield pd.DataFrame(out, columns=["doc_id", "chunk_idx", "ok", "payload", "error"])

    def close(self) -> None:
        pass


def stream_triples(chunks: DataFrame, provider, domain: str = "General", themes: str = "", registry: int = 100) -> DataFrame:
    """A stream of chunks(doc_id, chunk_idx, chunk) -> the answers, as model_calls.triple_answers of all chunks gives them, if a document's chunks come in order.

    The registry of a document is in the state store, so it outlives a restart from the
    same checkpoint. A micro-batch's chunks of one document are asked in order by one
    task. The session needs the store that STORE names.
    """
    kind = chunks.schema["doc_id"].dataType.simpleString()
    rows = chunks.select("doc_id", "chunk_idx", "chunk").groupBy("doc_id")
    return rows.transformWithStateInPandas(statefulProcessor=_Registry(provider, domain, themes, registry), outputStructType=f"doc_id {kind}, chunk_idx int, {CALL}", outputMode="Append", timeMode="None")
