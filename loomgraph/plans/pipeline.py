"""From documents to communities, hypergraph and schemas, stage by stage; finished stages are not run again."""

from __future__ import annotations

import hashlib
import json
import time
from dataclasses import asdict
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import chunk_documents, theme_or_other
from ..operators import cluster, community, embedding, graph, hypergraph, model_calls, normalize, themes, triples
from ..sources import sinks
from ..sources.ledger import Ledger
from ..sources.providers import free_memory, make_provider
from ..sources.vectors import VectorStore


def corpus_print(docs: DataFrame) -> list[str]:
    """What tells a corpus from others, repeated rows included: its count and two sums of row hashes, which no pair of equal rows cancels."""
    wide = lambda seed: F.coalesce(F.sum(F.xxhash64("doc_id", "text", F.lit(seed)).cast("decimal(38,0)")), F.lit(0)).cast("string")
    return [str(x) for x in docs.agg(F.count(F.lit(1)), wide(0), wide(1)).head()]


#: Rows of a kind that export draws or writes, at most.
MOST_DRAWN = 20_000


class Pipeline:
    """run(docs) -> a dict of DataFrames by stage, or just the metrics and errors of an empty run if no triple was found.

    Each stage is a table in folder/<key>/<stage>; the key hashes settings, provider
    settings and the documents. A stage whose table is complete is read, not computed.
    Calls that any run in the folder has an answer to are not made again (Ledger).
    """

    def __init__(self, spark: SparkSession, folder: str, config: Config = Config(), provider=None):
        self.spark, self.folder, self.config = spark, folder.rstrip("/"), config
        self.provider = provider or make_provider(config, free_memory() if config.context_source == "dynamic" else 0.0)
        self.log = sinks.logger()

    def _key(self, docs: DataFrame) -> str:
        # What says how calls are made, and by whose leave, changes no table.
        manner = ("api_key", "credentials", "max_concurrent", "max_tasks", "calls_per_task", "retry_wait")
        told = json.dumps([{k: v for k, v in asdict(self.config).items() if k not in manner}, self.provider.settings(), type(self.provider).__qualname__, corpus_print(docs)], sort_keys=True, default=str)
        return hashlib.sha256(told.encode()).hexdigest()[:16]

    def _stage(self, name: str, make) -> DataFrame:
        path = f"{self.base}/{name}"
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target):
            began = time.time()
            make().write.mode("overwrite").parquet(path)
            self.log.info("stage %s: %.1f s", name, time.time() - began)
        return self.spark.read.parquet(path)

    def run(self, docs: DataFrame) -> dict[str, DataFrame]:
        c, p, began = self.config, self.provider, time.time()
        self.base = f"{self.folder}/{self._key(docs)}"
        ledger = Ledger(self.spark, f"{self.folder}/ledger", c.calls_per_task, c.max_tasks)
        failed: list[DataFrame] = []

        def answers(name: str, make) -> DataFrame:
            table = self._stage(f"{name}_answers", make)
            failed.append(model_calls.errors_of(name, table))
            return table

        told = answers("themes", lambda: model_calls.theme_answers(chunk_documents(docs, c.theme_chunk_words, c.overlap_words), p, c.max_concurrent, ledger))
        found = self._stage("original_themes", lambda: model_calls.themes_of(told))
        ranked = themes.theme_frequency(found)
        master = answers("distilled_themes", lambda: model_calls.consolidate_themes(themes.consolidate(ranked, c.default_domain), themes.theme_blocks(ranked), p, c.default_domain, ledger))
        master = master.select("master_domain", "master_themes")
        first = master.head()
        domain, titles = first["master_domain"], ", ".join(first["master_themes"] or [])
        told_triples = answers("triples", lambda: model_calls.triple_answers(chunk_documents(docs, c.triple_chunk_words, c.overlap_words), p, domain, titles, c.registry_entities, ledger))
        raw = self._stage("original_triplets", lambda: model_calls.triples_of(told_triples))
        out = {"original_themes": found, "distilled_themes": master, "original_triplets": raw}
        if not raw.head(1):
            return out | {"errors": reduce(DataFrame.unionByName, failed), "metrics": run_metrics(docs, raw, raw)}
        clean = raw
        if c.normalize_text:
            plain = normalize.normalize_triples(raw)
            mapping = self._stage("normalization_mapping_details", lambda: model_calls.normalize_tokens(triples.role_items(plain), p, domain, c.token_batch, c.max_concurrent, ledger))
            failed.append(mapping.where("error is not null").groupBy(F.lit("normalize").alias("step"), "error").agg(F.count(F.lit(1)).alias("calls")))
            clean = self._stage("normalized_triplets", lambda: normalize.normalize_triples(raw, mapping))
            out |= {"normalization_mapping_details": mapping, "normalized_triplets": clean}
        points = self._stage("embeddings", lambda: VectorStore(self.spark, f"{self.folder}/vectors", c.encoder).encode(triples.item_counts(triples.role_items(clean, c.compress_fields))))
        groups = self._stage("clusters_identified", lambda: cluster.cluster_items(points, c.distance_threshold, c.projection))
        judged = answers("validate", lambda: model_calls.validate_answers(groups, p, domain, c.max_concurrent, ledger))
        checked = self._stage("verified_clusters", lambda: model_calls.split_clusters(groups, judged))
        lifted = answers("lift", lambda: model_calls.lift_answers(checked, points, p, domain, c.max_concurrent, ledger))
        names = self._stage("hypernym_mapping", lambda: model_calls.labels_of(checked, lifted))
        mapped = self._stage("mapped_triplets", lambda: normalize.resolve_names(clean, names))
        edges = self._stage("edges", lambda: graph.edges(mapped))
        parts = self._stage("modularity_partition", lambda: community.detect_communities(edges, c.resolution))
        tree = self._stage("extracted_hierarchy", lambda: graph.hierarchy(edges, parts, c.min_community_size))
        members = self._stage("memberships", lambda: hypergraph.memberships(mapped))
        out |= {
            "incidence": self._stage("incidence", lambda: hypergraph.incidence(members)),
            "laplacian": self._stage("laplacian", lambda: hypergraph.laplacian(members)),
            "theme_overlap": self._stage("theme_overlap", lambda: hypergraph.theme_overlap(members)),
            "centrality": self._stage("centrality", lambda: hypergraph.degree_centrality(members)),
            "hypergraph_communities": self._stage("hypergraph_communities", lambda: hypergraph.bipartite_communities(members, c.resolution)),
            "counts": self._stage("counts", lambda: hypergraph.counts(mapped, members)),
        }
        down = self._stage("theme_inheritance", lambda: hypergraph.theme_inheritance(members, c.overlap_threshold))
        told_schemas = answers("schemas", lambda: model_calls.schema_answers(tree, p, domain, model_calls.inherited_themes(parts, members, down), c.max_concurrent, ledger))
        schemas = self._stage("schemas_read", lambda: model_calls.schemas_of(told_schemas))
        errors = self._stage("errors", lambda: reduce(DataFrame.unionByName, failed))
        out |= {"clusters_identified": groups, "verified_clusters": checked, "hypernym_mapping": names, "mapped_triplets": mapped, "edges": edges, "modularity_partition": parts, "extracted_hierarchy": tree, "memberships": members, "theme_inheritance": down, "schemas": schemas, "errors": errors, "document_lengths": docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("characters")), "metrics": run_metrics(docs, raw, mapped)}
        self.seconds = time.time() - began
        self.log.info("done in %.1f s", self.seconds)
        return out

    def export(self, stages: dict[str, DataFrame], folder: Path, most: int = MOST_DRAWN) -> Path:
        """The schemas as files, the run log, and pages of the graph, its communities and the hypergraph. Only communities of the least size are drawn. Raises where schemas, nodes or links would be more than `most`: they all go to the driver, and no page shows more."""
        folder = Path(folder)

        def rows(df: DataFrame, what: str) -> list:
            found = df.limit(most + 1).collect()
            if len(found) > most:
                raise ValueError(f"more than {most} {what}: raise min_community_size, or export less")
            return found

        parts = stages["modularity_partition"]
        large = graph.community_sizes(parts).where(F.col("size") >= self.config.min_community_size)
        nodes = parts.join(large, "community", "left_semi")
        drawn = nodes.select("node")
        edges = stages["edges"].join(drawn.withColumnRenamed("node", "src"), "src", "left_semi").join(drawn.withColumnRenamed("node", "dst"), "dst", "left_semi")
        degree = graph.node_degree(stages["edges"])
        links = rows(sinks.edge_labels(edges), "edges")
        sinks.graph_page(rows(sinks.role_nodes(stages["mapped_triplets"], degree).join(drawn, "node", "left_semi"), "nodes"), links, folder / "triples.html", "Triples")
        sinks.graph_page(rows(sinks.community_nodes(degree, nodes), "nodes"), links, folder / "communities.html", "Communities")
        groups = stages["hypergraph_communities"]
        groups = groups.join(groups.groupBy("community").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= self.config.min_community_size), "community", "left_semi")
        shown = lambda kind: groups.where(F.col("kind") == kind).select(F.col("label").alias(kind))
        members = stages["memberships"].join(shown("entity"), "entity", "left_semi").join(shown("theme"), "theme", "left_semi")
        vertices = sinks.hypergraph_nodes(groups, stages["centrality"], graph.theme_predicates(stages["mapped_triplets"]))
        sinks.graph_page(rows(vertices, "vertices"), rows(sinks.hypergraph_links(members), "memberships"), folder / "hypergraph.html", "Hypergraph")
        told = stages["metrics"].head().asDict() | stages["counts"].head().asDict() | {"seconds": round(getattr(self, "seconds", 0.0), 1), "context": self.provider.context}
        sinks.run_log(told | {f"errors, {r['step']}": f"{r['calls']} x {r['error']}" for r in rows(stages["errors"].orderBy("step", "error"), "errors")}, folder / "run.md")
        schemas = [r.asDict(recursive=True) for r in rows(stages["schemas"].orderBy("community"), "schemas")]
        return sinks.write_schemas(schemas, stages["distilled_themes"].head()["master_domain"], folder)


def run_metrics(docs: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: documents and characters, and distinct counts before and after."""
    d = docs.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("characters"))
    a = before.agg(F.count(F.lit(1)).alias("triples"), *(F.countDistinct(r).alias(f"{r}s_before") for r in triples.ROLES))
    b = after.agg(*(F.countDistinct(r).alias(f"{r}s_after") for r in triples.ROLES), F.countDistinct(theme_or_other(F.col("theme_association"))).alias("themes"))
    return d.crossJoin(a).crossJoin(b)
