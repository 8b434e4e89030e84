"""The model-dependent steps, as Arrow batches around a provider.

Each step's answers are kept as a table with ok, payload and error; `errors_of` lists the
calls that failed, so none vanishes. Ids pass as Arrow arrays, never as floats.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.ledger import Ledger
from ..sources.providers import ask, call
from ..storage import stage_table
from .embedding import centroids
from .hypergraph import indexed
from .normalize import token_batches
from .triples import ORD, parse_triples, place

CALL = "ok boolean, payload string, error string"
AT_ONCE = 3
#: Columns that name a call's row, and no part of what it is told.
IDS = ("doc_id", "chunk_idx", "role", "cluster_id", "community")


def _fields(rows: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)


def _calls(rows: DataFrame, keep: tuple[str, ...], method: Callable, arguments: Callable, at_once: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows_ = b.to_pylist()
            answers = list(ask(method, (arguments(r) for r in rows_), at_once))
            kept = [b.column(b.schema.get_field_index(c)) for c in keep]
            told = [pa.array([a[i] for a in answers], t) for i, t in enumerate((pa.bool_(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*kept, *told], [*keep, "ok", "payload", "error"])

    return rows.mapInArrow(run, f"{_fields(rows.select(*keep))}, {CALL}")


def _asked(rows: DataFrame, keep: tuple[str, ...], method: Callable, arguments: Callable, at_once: int = AT_ONCE, ledger: Ledger | None = None, step: str = "", settings: dict | None = None, told: tuple = ()) -> DataFrame:
    """The columns `keep` of rows, and the answer to method(*arguments(row)) for each row, at most at_once calls in flight a task. With a ledger, calls that it has an answer to are not made; what a call is told are its row's columns, but for ids, and `told`."""
    if ledger is None:
        return _calls(rows, keep, method, arguments, at_once)
    columns = tuple(c for c in rows.columns if c not in IDS)
    rows = rows.withColumn("call", ledger.key(step, settings or {}, told, columns))
    done = ledger.complete(rows, lambda some: _calls(some, ("call",), method, arguments, at_once))
    return done.select(*keep, "ok", "payload", "error")


def _settings(provider) -> dict:
    return {**provider.settings(), "class": type(provider).__qualname__}


def errors_of(step: str, answers: DataFrame) -> DataFrame:
    """(step, error, calls) of the calls that failed."""
    return answers.where("not ok").groupBy(F.lit(step).alias("step"), "error").agg(F.count(F.lit(1)).alias("calls"))


def theme_answers(chunks: DataFrame, provider, at_once: int = AT_ONCE, ledger: Ledger | None = None) -> DataFrame:
    """chunks(doc_id, chunk_idx, chunk) -> doc_id, chunk_idx and the answer."""
    return _asked(chunks.select("doc_id", "chunk_idx", "chunk"), ("doc_id", "chunk_idx"), provider.themes, lambda r: (r["chunk"],), at_once, ledger, "themes", _settings(provider))


def themes_of(answers: DataFrame) -> DataFrame:
    """ord, title, description, reasoning; failed calls and incomplete themes give nothing."""
    t = F.posexplode(F.from_json("payload", "themes array<struct<title:string,description:string,reasoning:string>>")["themes"]).alias("i", "t")
    rows = answers.where("ok").select("doc_id", "chunk_idx", t).where("t.title is not null and t.description is not null and t.reasoning is not null")
    return rows.select(place(F.col("doc_id"), F.col("chunk_idx"), F.col("i")).alias("ord"), "t.*")


def discover_themes(chunks: DataFrame, provider, at_once: int = AT_ONCE) -> DataFrame:
    return themes_of(theme_answers(chunks, provider, at_once))


def consolidate_themes(ranked: DataFrame, blocks: DataFrame, provider, default_domain: str = "General", ledger: Ledger | None = None) -> DataFrame:
    """One row (master_domain, master_themes, ok, payload, error). ranked: the one row of themes.consolidate; blocks: that of theme_blocks. Where the call fails, or its answer has no domain, the ranked titles stay; without themes nobody is asked."""
    row = ranked.select("master_domain", "master_themes").crossJoin(blocks.select("blocks"))
    told = _asked(row, ("master_domain", "master_themes"), lambda text, titles: provider.consolidate(text, titles) if titles else {}, lambda r: (r["blocks"] or "", r["master_themes"] or []), 1, ledger, "consolidate", _settings(provider))
    got = F.from_json("payload", "master_domain string, master_themes array<string>")
    told = told.withColumn("g", F.when(F.col("ok"), got))
    domain = F.coalesce(F.nullif(F.trim("g.master_domain"), F.lit("")), F.col("master_domain"), F.lit(default_domain))
    return told.select(domain.alias("master_domain"), F.coalesce("g.master_themes", "master_themes").alias("master_themes"), "ok", "payload", "error")


def _latest(entities: dict, registry: int) -> list[str]:
    """The last `registry` of the entities in their order, without a walk over all of them."""
    return list(itertools.islice(reversed(entities), registry))[::-1]


def triple_answers(chunks: DataFrame, provider, domain: str = "General", themes: str = "", registry: int = 100, ledger: Ledger | None = None) -> DataFrame:
    """chunks(doc_id, chunk_idx, chunk) -> doc_id, chunk_idx and the answer.

    A document's chunks are asked in order, each with the latest `registry` entities of
    the document so far, by first appearance. Chunks stream through a task, so a
    document may be of any length; documents run side by side in the tasks. With a
    ledger, a chunk that has an answer gives its entities to the registry unasked.
    """
    parts = max(1, int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = chunks.select("doc_id", "chunk_idx", "chunk")
    if ledger is None:
        rows = rows.withColumns({"call": F.lit(""), "known": F.lit(None).cast("string")})
    else:
        rows = rows.withColumn("call", ledger.key("triples", _settings(provider), (domain, themes, registry), ("doc_id", "chunk_idx", "chunk")))
        rows = stage_table(rows.join(ledger.answers().where("ok").select("call", F.col("payload").alias("known")), "call", "left").select("doc_id", "chunk_idx", "chunk", "call", "known"), "calls")
        parts = min(ledger.max_tasks or 1 << 30, max(parts, ledger.parts(rows.where("known is null").count())))
    dealt = rows.repartition(parts, "doc_id").sortWithinPartitions("doc_id", "chunk_idx")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, entities = object(), {}
        for b in batches:
            answers = []
            for doc, chunk, old in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(4).to_pylist()):
                if doc != now:
                    now, entities = doc, {}
                ok, payload, error = call(provider.triples, chunk, domain, themes, _latest(entities, registry)) if old is None else (True, old, None)
                if ok:
                    for name in entities_of(payload):
                        entities.setdefault(name)
                answers.append((ok, payload, error))
            told = [pa.array([a[i] for a in answers], t) for i, t in enumerate((pa.bool_(), pa.string(), pa.string()))]
            fresh = b.column(4).is_null()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), fresh, *told], ["doc_id", "chunk_idx", "call", "fresh", "ok", "payload", "error"])

    done = dealt.mapInArrow(run, f"{_fields(rows.select('doc_id', 'chunk_idx'))}, call string, fresh boolean, {CALL}")
    if ledger is None:
        return done.select("doc_id", "chunk_idx", "ok", "payload", "error")
    ledger._append(done.where("fresh").select("call", "ok", "payload", "error"))
    return rows.select("doc_id", "chunk_idx", "call").join(ledger.answers(), "call", "left").select("doc_id", "chunk_idx", "ok", "payload", "error")


def entities_of(payload: str) -> Iterator[str]:
    """The subjects and objects of an answer's triples, in order."""
    found = json.loads(payload)
    found = found.get("triples") if isinstance(found, dict) else None
    for t in found if isinstance(found, list) else []:
        for role in ("subject", "object"):
            if isinstance(t, dict) and isinstance(t.get(role), str) and t[role].strip():
                yield t[role].strip()


def triples_of(answers: DataFrame) -> DataFrame:
    """doc_id and the valid triples with ord."""
    t = parse_triples(answers.where("ok").select("doc_id", "chunk_idx", "payload"))
    return t.select(place(F.col("doc_id"), F.col("chunk_idx"), F.col("elem_idx")).alias("ord"), "doc_id", "subject", "predicate", "object", "source_quote", "certainty_score", "theme_association")


def extract_triples(chunks: DataFrame, provider, domain: str = "General", themes: str = "", registry: int = 100) -> DataFrame:
    return triples_of(triple_answers(chunks, provider, domain, themes, registry))


def normalize_tokens(items: DataFrame, provider, domain: str, size: int = 50, at_once: int = AT_ONCE, ledger: Ledger | None = None) -> DataFrame:
    """items(role, item) -> role, original, normalized, error: one call per batch of distinct items. A failed call leaves its batch as it is and tells its error with each row; a token missing from the answer stays too; answers for other strings are ignored, of several the last counts."""
    rows = token_batches(items, size).groupBy("role", "batch").agg(F.sort_array(F.collect_list("item")).alias("tokens")).select("role", "tokens")
    answers = _asked(rows, ("role", "tokens"), provider.normalize, lambda r: (r["tokens"], domain), at_once, ledger, "normalize", _settings(provider), (domain,))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = []
            for role, tokens, ok, payload, error in zip(p["role"], p["tokens"], p["ok"], p["payload"], p["error"]):
                answer = json.loads(payload) if ok else {}
                found = answer.get("tokens") if isinstance(answer, dict) else None
                new = {t["original"]: t["normalized"] for t in found or [] if isinstance(t, dict) and isinstance(t.get("original"), str) and isinstance(t.get("normalized"), str)}
                out += [(role, t, new.get(t, t), error) for t in tokens]
            yield pd.DataFrame(out, columns=["role", "original", "normalized", "error"])

    return answers.mapInPandas(read, "role string, original string, normalized string, error string")


def _per_cluster(clusters: DataFrame) -> DataFrame:
    """A cluster's members are one call's argument, so their list is bounded by what a model can be asked."""
    item = F.struct("item_idx", "item")
    rows = clusters.groupBy("role", "cluster_id").agg(F.sort_array(F.collect_list(item)).alias("m"))
    return rows.select("role", "cluster_id", F.transform("m", lambda x: x["item"]).alias("members"))


def validate_answers(clusters: DataFrame, provider, domain: str, at_once: int = AT_ONCE, ledger: Ledger | None = None) -> DataFrame:
    """role, cluster_id and the answer, for clusters of several items."""
    rows = _per_cluster(clusters).where(F.size("members") > 1)
    return _asked(rows, ("role", "cluster_id"), provider.validate, lambda r: (r["members"], domain), at_once, ledger, "validate", _settings(provider), (domain,))


def split_clusters(clusters: DataFrame, answers: DataFrame) -> DataFrame:
    """Clusters whose accuracy a common name would destroy fall apart into single items; others stay, also where the call failed. Clusters keep their order, numbers close up."""
    destroyed = F.lower(F.get_json_object("payload", "$.accuracy_destroyed")).isin("true", "1")
    asked = answers.select("role", "cluster_id", (F.col("ok") & F.coalesce(destroyed, F.lit(False))).alias("destroyed"))
    out = clusters.join(asked, ["role", "cluster_id"], "left").withColumn("i", F.when(F.coalesce("destroyed", F.lit(False)), F.col("item_idx")).otherwise(F.lit(0)))
    number = indexed(out, ("role", "cluster_id", "i"), "number", by="role")
    at = F.row_number().over(Window.partitionBy("role", "cluster_id", "i").orderBy("item_idx")) - 1
    return out.withColumn("at", at).join(number, ["role", "cluster_id", "i"]).select("role", F.col("number").cast("int").alias("cluster_id"), F.col("at").alias("item_idx"), "item")


def validate_clusters(clusters: DataFrame, provider, domain: str, at_once: int = AT_ONCE) -> DataFrame:
    return split_clusters(clusters, validate_answers(clusters, provider, domain, at_once))


def central_items(clusters: DataFrame, vectors: DataFrame) -> DataFrame:
    """role, cluster_id, center of the clusters of several items. vectors(role, item, v) are the raw embeddings."""
    many = clusters.groupBy("role", "cluster_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("role", "cluster_id")
    rows = clusters.join(many, ["role", "cluster_id"], "left_semi").join(vectors.select("role", "item", "v"), ["role", "item"])
    rows = rows.withColumn("group", F.to_json(F.struct("role", "cluster_id")))
    return centroids(rows, "group", "item").select(F.from_json("group", "role string, cluster_id int").alias("g"), "center").select("g.*", "center")


def lift_answers(clusters: DataFrame, vectors: DataFrame, provider, domain: str, at_once: int = AT_ONCE, ledger: Ledger | None = None) -> DataFrame:
    """role, cluster_id, center and the answer: the model is told the central item with the members."""
    rows = _per_cluster(clusters).join(central_items(clusters, vectors), ["role", "cluster_id"])
    return _asked(rows, ("role", "cluster_id", "center"), provider.lift, lambda r: (r["members"], domain, r["center"]), at_once, ledger, "lift", _settings(provider), (domain,))


def labels_of(clusters: DataFrame, answers: DataFrame) -> DataFrame:
    """role, member, label: the verified hypernym of a cluster, else its central item; a single item is its own label."""
    g = F.from_json("payload", "formal_hypernym string, members_verified boolean")
    name = F.when(F.col("ok") & F.coalesce(F.col("g.members_verified"), F.lit(False)), F.col("g.formal_hypernym"))
    names = answers.withColumn("g", g).select("role", "cluster_id", F.coalesce(name, "center").alias("label"))
    return clusters.join(names, ["role", "cluster_id"], "left").select("role", F.col("item").alias("member"), F.coalesce("label", "item").alias("label"))


def taxonomic_lift(clusters: DataFrame, vectors: DataFrame, provider, domain: str, at_once: int = AT_ONCE) -> DataFrame:
    return labels_of(clusters, lift_answers(clusters, vectors, provider, domain, at_once))


def schema_answers(tree: DataFrame, provider, domain: str, inheritance: str | DataFrame = "", at_once: int = AT_ONCE, ledger: Ledger | None = None) -> DataFrame:
    """hierarchy rows -> community and the answer. A community's edges are one call's argument. inheritance: what each call is told of the themes, or rows(community, inherited)."""
    line = lambda e: F.format_string("%s -[%s]-> %s", e["source"], F.coalesce(e["predicate"], F.lit("links")), e["target"])
    rows = tree.select("community", "nodes", F.coalesce(F.transform("edges", line), F.array().cast("array<string>")).alias("lines"))
    if isinstance(inheritance, str):
        rows = rows.withColumn("inherited", F.lit(inheritance))
    else:
        rows = rows.join(inheritance.select("community", "inherited"), "community", "left").withColumn("inherited", F.coalesce("inherited", F.lit("")))
    return _asked(rows, ("community",), provider.schema, lambda r: ({"nodes": r["nodes"], "edges": r["lines"]}, domain, r["inherited"]), at_once, ledger, "schemas", _settings(provider), (domain,))


def inherited_themes(partition: DataFrame, members: DataFrame, inheritance: DataFrame) -> DataFrame:
    """community, inherited: what is part of what among the themes of a community's own nodes, as one argument of its call."""
    own = stage_table(partition.join(members.withColumnRenamed("entity", "node"), "node").select("community", "theme").distinct())
    pairs = inheritance.join(own.select("community", F.col("theme").alias("parent")), "parent").join(own.select("community", F.col("theme").alias("child")), ["community", "child"])
    line = F.format_string("%s is part of %s", "child", "parent")
    return pairs.groupBy("community").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("parent", "child", line.alias("line")))), lambda x: x["line"]), "; ").alias("inherited"))


def schemas_of(answers: DataFrame) -> DataFrame:
    """community and the generated schema; failed calls give nothing."""
    schema = "title string, summary string, core_theme string, key_learnings array<string>, isolated_facts array<string>, protocols_code string, concrete_models_code string"
    return answers.where("ok").select("community", F.from_json("payload", schema).alias("s")).select("community", "s.*")


def synthesize_schemas(tree: DataFrame, provider, domain: str, inheritance: str | DataFrame = "", at_once: int = AT_ONCE) -> DataFrame:
    return schemas_of(schema_answers(tree, provider, domain, inheritance, at_once))
