"""Registered queries over the driver tables, and the SQL that checks them.

Triple sources: `rel` from customers, nations and orders; `part` from parts; `doc` by
rule extraction from documents. Each is plain SQL on both engines.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import chunk_documents, edge_text, json_in_answer, node_size, preprocess
from ..operators import cluster, community, embedding, graph, hypergraph, metric_tree, model_calls, normalize, themes, triples
from ..operators.components import connected_components
from ..sources.corpus import table
from ..sources import sinks
from ..sources.providers import OfflineProvider
from ..storage import stage_table
from .pipeline import run_metrics

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

def rel(spark: SparkSession, d: str) -> DataFrame:
    o, c, n = table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.select(F.col("o_orderkey").alias("ord"), F.col("c_name").alias("subject"), F.col("o_orderpriority").alias("predicate"), F.col("n_name").alias("object"), F.col("c_mktsegment").alias("theme_association"))


def part(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.col("p_brand").alias("subject"), F.lit("has type").alias("predicate"), F.col("p_type").alias("object"), F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("theme_association"))


def doc(spark: SparkSession, d: str) -> DataFrame:
    return triples.rule_triples(table(spark, d, "documents"))


REL = "rel as (select o_orderkey ord, c_name subject, o_orderpriority predicate, n_name object, c_mktsegment theme from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"
PART = "part_t as (select p_partkey ord, p_brand subject, 'has type' predicate, p_type object, 'size ' || p_size theme from part)"
DOC = r"""sent as (select doc_id, source, unnest(string_split_regex(text, '[.\n]')) sentence, generate_subscripts(string_split_regex(text, '[.\n]'), 1) - 1 sent_idx from documents),
sw as (select *, list_filter(string_split_regex(sentence, '\s+'), lambda x: x <> '') w from sent),
doc as (select {'d': doc_id, 's': sent_idx} ord, doc_id, sent_idx::int sent_idx, w[1] subject, w[2] predicate, w[len(w)] object, sentence source_quote, source theme from sw where len(w) >= 3)"""
ITEMS = "items as (select ord, 0 role_pos, 'subject' role, subject item from doc where subject <> '' union all select ord, 1, 'predicate', predicate from doc where predicate <> '' union all select ord, 2, 'object', object from doc where object <> '')"
CLEAN = r"trim(regexp_replace(lower(regexp_replace(replace({0}, '_', ' '), '[<>/\\|\[\]{{}}]', '', 'g')), '\s+', ' ', 'g'))"
MEMBERS = "members as (select distinct entity, theme from (select subject entity, theme from part_t union all select object, theme from part_t))"
GIVEN = "given as (select c_name node, n_regionkey::bigint community from customer join nation on c_nationkey = n_nationkey union select n_name, n_regionkey::bigint from nation)"
EDGES = "edges as (select subject src, object dst, count(*)::double weight from rel where subject <> '' and object <> '' group by 1, 2)"


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(
    r"""with w as (select doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') ws from documents),
k as (select doc_id, ws, unnest(generate_series(0, greatest(0, ceil((len(ws) - 200) / 150.0)::bigint))) chunk_idx from w where len(ws) > 0)
select doc_id, chunk_idx::int chunk_idx, array_to_string(ws[chunk_idx * 150 + 1 : chunk_idx * 150 + 200], ' ') chunk from k"""
)
def chunk_documents_200_50(spark, d):
    return chunk_documents(table(spark, d, "documents"), 200, 50)


@query(f"select doc_id, {CLEAN.format('text')} normalized from documents")
def preprocess_text(spark, d):
    return table(spark, d, "documents").select("doc_id", preprocess(F.col("text")).alias("normalized"))


def _flat(t: DataFrame, ord_: str = "ord", prefix: str = "") -> DataFrame:
    """A place in a document as two columns."""
    return t.withColumns({f"{prefix}doc_id": F.col(f"{ord_}.doc_id"), f"{prefix}sent_idx": F.col(f"{ord_}.elem_idx")}).drop(ord_)


@query(f"with {DOC} select doc_id, sent_idx, subject, predicate, object, source_quote, 1.0::double certainty_score, theme theme_association from doc")
def triples_rule_extract(spark, d):
    return _flat(doc(spark, d))


@query(
    """select event_id, 0 elem_idx, 'user ' || user_id subject, event_type predicate, cast(value as varchar) object, case when event_id % 3 = 0 then 'Other' else event_type end theme_association
from events where event_id % 7 <> 0 and event_id % 5 <> 0 and event_id % 11 <> 0"""
)
def triples_json_validated(spark, d):
    e = table(spark, d, "events")
    subject = F.when(F.col("event_id") % 7 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" user "), F.col("user_id").cast("string"), F.lit("\t")))
    score = F.when(F.col("event_id") % 5 == 0, F.lit("bad")).when(F.col("event_id") % 11 == 0, F.lit("1.5")).otherwise(F.lit(" 0.5 "))
    theme = F.when(F.col("event_id") % 3 != 0, F.col("event_type"))
    good = F.to_json(F.struct(subject.alias("subject"), F.col("event_type").alias("predicate"), F.col("value").cast("string").alias("object"), F.lit("q").alias("source_quote"), score.alias("certainty_score"), theme.alias("theme_association")))
    payload = F.concat(F.lit('{"triples": ['), good, F.lit(', 7, {"subject": 3}]}'))
    return triples.parse_triples(e.select("event_id", payload.alias("payload"))).select("event_id", "elem_idx", "subject", "predicate", "object", "theme_association")


def _themes(spark, d):
    t = table(spark, d, "documents")
    title = F.when(F.col("doc_id") % 3 == 0, F.upper("source")).otherwise(F.concat(F.lit(" "), F.col("source")))
    return t.select(F.col("doc_id").alias("ord"), title.alias("title"), F.col("lang").alias("description"), F.concat(F.lit("seen in "), F.col("doc_id").cast("string")).alias("reasoning"))


THEMES = "themes as (select doc_id ord, case when doc_id % 3 = 0 then upper(source) else ' ' || source end title, lang description, 'seen in ' || doc_id reasoning from documents), freq as (select lower(trim(title)) as key, count(*) freq, min(ord) first_ord, arg_min(title, ord) title, arg_min(description, ord) description, arg_min(reasoning, ord) reasoning from themes group by 1)"


@query(f"with {THEMES} select * from freq")
def theme_frequency(spark, d):
    return themes.theme_frequency(_themes(spark, d))


@query(f"with {THEMES} select string_agg('Title: ' || title || ' (Frequency: ' || freq || ')' || chr(10) || 'Description: ' || description || chr(10) || 'Reasoning: ' || reasoning, chr(10) || chr(10) order by freq desc, first_ord) blocks, count(*) n_themes from freq")
def theme_blocks(spark, d):
    return themes.theme_blocks(themes.theme_frequency(_themes(spark, d)))


@query(f"with {THEMES} select arg_min(trim(title), (-freq, first_ord)) master_domain, string_agg(trim(title), '|' order by freq desc, first_ord) master_themes from freq")
def theme_consolidation(spark, d):
    return themes.consolidate(themes.theme_frequency(_themes(spark, d))).withColumn("master_themes", F.array_join("master_themes", "|"))


@query(f"with {DOC}, {ITEMS} select role, item original, {CLEAN.format('item')} normalized, min(ord).d first_doc_id, min(ord).s::int first_sent_idx, item <> {CLEAN.format('item')} was_changed from items group by role, item")
def normalization_details(spark, d):
    return _flat(normalize.normalization_details(doc(spark, d)), "first_ord", "first_")


@query(f"with {DOC}, {ITEMS}, t as (select distinct role, item from items) select role, item, ((row_number() over (partition by role order by item) - 1) // 50)::int batch from t")
def token_batches(spark, d):
    return normalize.token_batches(triples.role_items(doc(spark, d)))


@query(f"with {DOC}, {ITEMS} select role, item, count(*) n, min(ord).d first_doc_id, min(ord).s::int first_sent_idx from items group by role, item")
def role_item_counts(spark, d):
    return _flat(triples.item_counts(triples.role_items(doc(spark, d))), "first_ord", "first_")


@query(
    f"""with {DOC}, seen as (select doc_id, entity, min(sent_idx * 2 + pos) first from (select doc_id, sent_idx, 0 pos, subject entity from doc union all select doc_id, sent_idx, 1, object from doc) group by 1, 2),
r as (select doc_id, entity, (row_number() over (partition by doc_id order by first desc))::int as rank from seen) select * from r where rank <= 100"""
)
def recent_entities(spark, d):
    return normalize.recent_entities(doc(spark, d).withColumn("doc_id", F.col("ord.doc_id")))


def _labels(t: DataFrame) -> DataFrame:
    items = triples.role_items(t).select("role", F.col("item").alias("member")).distinct()
    return items.where(F.length("member") % 2 == 0).select("role", "member", F.concat(F.upper("role"), F.lit(":"), F.substring("member", 1, 3)).alias("label"))


@query(
    f"""with {DOC}, {ITEMS}, m as (select distinct role, item member, upper(role) || ':' || substr(item, 1, 3) label from items where length(item) % 2 = 0)
select doc_id, sent_idx, coalesce(a.label, subject) subject, coalesce(b.label, predicate) predicate, coalesce(c.label, object) object, (a.label is not null or b.label is not null or c.label is not null) hit from doc
left join m a on a.role = 'subject' and a.member = subject left join m b on b.role = 'predicate' and b.member = predicate left join m c on c.role = 'object' and c.member = object"""
)
def map_lookup_resolve(spark, d):
    t = triples.rule_triples(table(spark, d, "documents"))
    return _flat(normalize.resolve_names(t, _labels(t)).select("ord", "subject", "predicate", "object", "hit"))


EDGE_COLUMNS = "subject src, object dst, count(*)::double weight, arg_min(predicate, ord) predicate, string_agg(distinct predicate, '|' order by predicate) predicates"


def _edges(t: DataFrame) -> DataFrame:
    return graph.edges(t).select("src", "dst", "weight", "predicate", F.array_join("predicates", "|").alias("predicates"))


@query(f"with {REL} select {EDGE_COLUMNS} from rel group by 1, 2")
def edges_weighted(spark, d):
    return _edges(rel(spark, d))


@query(f"with {DOC} select {EDGE_COLUMNS} from doc group by 1, 2")
def edges_weighted_doc(spark, d):
    return _edges(doc(spark, d))


@query(f"with {REL}, {EDGES} select src || ' -[' || (select arg_min(predicate, ord) from rel r where r.subject = src and r.object = dst) || ']-> ' || dst line, weight from edges")
def edge_lines(spark, d):
    return graph.edges(rel(spark, d)).select(edge_text(F.col("src"), F.col("predicate"), F.col("dst")).alias("line"), "weight")


@query(f"with {REL}, {EDGES} select node, count(*) degree, least(greatest(5 * count(*), 15), 50)::bigint size from (select src node from edges union all select dst from edges) group by 1")
def node_degree(spark, d):
    return graph.node_degree(graph.edges(rel(spark, d))).withColumn("size", node_size(F.col("degree")).cast("long"))


@query(f"with {PART} select distinct subject entity, 'out' direction, object other, predicate from part_t union select distinct object, 'in', subject, predicate from part_t")
def entity_neighborhoods(spark, d):
    return graph.entity_neighborhoods(part(spark, d))


@query(f"with {REL} select theme, row_number() over (partition by theme order by ord) - 1 pos, predicate from rel")
def theme_predicates(spark, d):
    return graph.theme_predicates(rel(spark, d))


@query(f"with {PART}, {MEMBERS} select entity, theme, (dense_rank() over (order by entity) - 1)::bigint entity_idx, (dense_rank() over (order by theme) - 1)::bigint theme_idx, 1.0::double as value from members")
def incidence_matrix(spark, d):
    return hypergraph.incidence(hypergraph.memberships(part(spark, d)))


@query(f"with {PART}, {MEMBERS} select entity, count(*) degree from members group by 1")
def entity_theme_degree(spark, d):
    return hypergraph.entity_degree(hypergraph.memberships(part(spark, d)))


@query(f"with {PART}, {MEMBERS} select a.entity as row, b.entity col, -count(*)::double as value from members a join members b using (theme) where a.entity <> b.entity group by 1, 2")
def laplacian_entries(spark, d):
    return hypergraph.laplacian(hypergraph.memberships(part(spark, d)))


OVERLAP = "overlap_t as (select a.theme theme_a, b.theme theme_b, count(*) shared from members a join members b using (entity) group by 1, 2)"


@query(f"with {PART}, {MEMBERS}, {OVERLAP} select * from overlap_t")
def theme_overlap(spark, d):
    return hypergraph.theme_overlap(hypergraph.memberships(part(spark, d)))


@query(f"with {PART}, {MEMBERS}, {OVERLAP} select o.theme_a parent, o.theme_b child, o.shared, round(o.shared / s.shared, 6) share from overlap_t o join overlap_t s on s.theme_a = o.theme_b and s.theme_b = o.theme_b where o.theme_a <> o.theme_b and o.shared / s.shared >= 0.8")
def theme_inheritance(spark, d):
    return hypergraph.theme_inheritance(hypergraph.memberships(part(spark, d)), 0.8).withColumn("share", F.round("share", 6))


@query(f"with {PART}, {MEMBERS}, v as (select 'entity' kind, entity label, count(*) degree from members group by 2 union all select 'theme', theme, count(*) from members group by 2) select kind, label, round(degree / ((select count(*) from v) - 1), 6) centrality from v")
def degree_centrality(spark, d):
    return hypergraph.degree_centrality(hypergraph.memberships(part(spark, d))).withColumn("centrality", F.round("centrality", 6))


def _given(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    a = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_name").alias("node"), F.col("n_regionkey").cast("long").alias("community"))
    return a.union(n.select("n_name", F.col("n_regionkey").cast("long"))).distinct()


@query(f"with {REL}, {EDGES}, {GIVEN} select a.community, src, dst, weight from edges join given a on a.node = src join given b on b.node = dst where a.community = b.community")
def community_internal_edges(spark, d):
    return graph.internal_edges(graph.edges(rel(spark, d)), _given(spark, d)).select("community", "src", "dst", "weight")


@query(f"with {GIVEN} select community, count(*) size from given group by 1")
def community_sizes(spark, d):
    return graph.community_sizes(_given(spark, d))


@query(
    f"""with {REL}, {EDGES}, {GIVEN}, e as (select a.community ca, b.community cb, weight from edges join given a on a.node = src join given b on b.node = dst),
p as (select c, sum(i) i, sum(o) o, sum(k) k from (select ca c, case when ca = cb then weight else 0 end i, weight o, 0 k from e union all select cb, 0, 0, weight from e) group by 1)
select round(sum(i) - sum(o * k) / sum(o), 6) objective, round((sum(i) - sum(o * k) / sum(o)) / sum(o), 6) modularity from p"""
)
def modularity_given_partition(spark, d):
    q = graph.modularity(graph.edges(rel(spark, d)), _given(spark, d))
    return q.select(F.round("objective", 6).alias("objective"), F.round("modularity", 6).alias("modularity"))


@query("select a.vec_id a, b.vec_id b, round(1 - list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 4) distance from embeddings a join embeddings b on a.vec_id < b.vec_id where 1 - list_cosine_similarity(a.embedding::double[], b.embedding::double[]) < 0.65")
def cosine_pairs_below(spark, d):
    p = table(spark, d, "embeddings").select(F.lit("all").alias("role"), "vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return metric_tree.close_pairs(p, 0.65, "role", "vec_id").select("a", "b", F.round("distance", 4).alias("distance"))


@query(
    """with x as (select label, vec_id, unnest(embedding::double[]) v, generate_subscripts(embedding, 1) i from embeddings), m as (select label, i, avg(v) m from x group by 1, 2),
s as (select x.label, vec_id, round(1 - sum(v * m) / (sqrt(sum(v * v)) * sqrt(sum(m * m))), 12) dist from x join m using (label, i) group by 1, 2)
select label, arg_min(vec_id, (dist, vec_id)) center, round(min(dist), 6) distance from s group by 1"""
)
def embedding_centroid(spark, d):
    m = table(spark, d, "embeddings").select("label", F.col("vec_id").alias("item_idx"), "vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return embedding.centroids(m, "label", "vec_id").withColumn("distance", F.round("distance", 6))


@query(
    """with x as (select label, unnest(embedding::double[]) v, generate_subscripts(embedding, 1) i from embeddings), s as (select label, i, var_samp(v) ev from x group by 1, 2),
k as (select *, row_number() over (partition by label order by ev desc, i) k from s), w as (select *, ev - lead(ev) over (partition by label order by k) gap, sum(ev) over (partition by label order by k) / sum(ev) over (partition by label) cum, count(*) over (partition by label) n from k),
g as (select label, max(n) total, arg_max(k, (gap, -k)) filter (gap is not null) kg, min(case when cum >= 0.85 then k end) kc from w group by 1)
select g.label::varchar as role, (case when total <= 2 then total when w.cum < 0.5 then kc else kg end)::int components from g join w on w.label = g.label and w.k = g.kg"""
)
def explained_variance_select(spark, d):
    """Components by the variances along the axes, for each label."""
    x = table(spark, d, "embeddings").select(F.col("label").cast("string").alias("role"), F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "v"))
    ev = x.groupBy("role", "i").agg(F.var_samp("v").alias("ev"))
    return embedding.choose_by_rows(ev.select("role", F.row_number().over(Window.partitionBy("role").orderBy(F.desc("ev"), "i")).alias("k"), "ev"))


@query("select doc_id, case when doc_id % 8 = 6 then 'no ' || doc_id else '{\"id\": ' || doc_id || '}' end answer from documents")
def answer_json(spark, d):
    """After an output mark or not; fenced with or without a tag, bare, with prose and braces around, and none."""
    i = F.col("doc_id")
    body = F.concat(F.lit('{"id": '), i.cast("string"), F.lit("}"))
    shapes = (
        (F.lit("so {x} Output:\n"), F.lit("")),
        (F.lit("here:\n```json\n"), F.lit("\n``` done")),
        (F.lit("I say "), F.lit(" only")),
        (F.lit("{x} Output:\nwell\nOutput:\n```json "), F.lit("``` done {y}")),
        (F.lit("first\n```\n"), F.lit("\n```\nthen {y}")),
        (F.lit("{x} Output:\nSure: "), F.lit(" is it")),
        (None, None),
        (F.lit("```json\n"), F.lit("\n```\n```json\n{\"id\": 0}\n```")),
    )
    raw = F.concat(F.lit("{x} Output:\nno "), i.cast("string"))
    for k, (before, after) in enumerate(shapes):
        if before is not None:
            raw = F.when(i % 8 == k, F.concat(before, body, after)).otherwise(raw)
    return table(spark, d, "documents").select("doc_id", json_in_answer(raw).alias("answer"))


@query(
    f"""with {DOC} select (select count(*) from documents) documents, (select sum(length(text))::bigint from documents) characters, count(*) triples,
count(distinct subject) subjects_before, count(distinct predicate) predicates_before, count(distinct object) objects_before,
count(distinct {CLEAN.format('subject')}) subjects_after, count(distinct {CLEAN.format('predicate')}) predicates_after, count(distinct {CLEAN.format('object')}) objects_after, count(distinct theme) themes from doc"""
)
def run_metrics_doc(spark, d):
    docs = table(spark, d, "documents")
    raw = triples.rule_triples(docs)
    return run_metrics(docs, raw, normalize.normalize_triples(raw))


def _points(spark, d):
    p = table(spark, d, "part")
    names = p.groupBy(F.lit("subject").alias("role"), F.col("p_name").alias("item")).agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_ord"))
    return embedding.encode(names)


@query(
    """with w as (select o_custkey, count(*) n from orders group by 1),
x as (select c_mktsegment as role, n, unnest([{'i': 0, 'x': c_nationkey::double}, {'i': 1, 'x': c_acctbal}, {'i': 2, 'x': (c_custkey % 7)::double}], recursive := true), [c_nationkey::double, c_acctbal, (c_custkey % 7)::double] v from customer join w on c_custkey = o_custkey),
y as (select role, n, i, x, unnest([0, 1, 2]) j, unnest(v) z from x)
select role, i::int i, j::int j, round((sum(n * x * z) - sum(n * x) * sum(n * z) / sum(n)) / (sum(n) - 1), 3) covariance from y group by 1, 2, 3"""
)
def weighted_covariance(spark, d):
    """Of customers, weighted by their orders, for each market segment."""
    n = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    v = F.array(F.col("c_nationkey").cast("double"), F.col("c_acctbal"), (F.col("c_custkey") % 7).cast("double"))
    points = table(spark, d, "customer").join(n, "c_custkey").select(F.col("c_mktsegment").alias("role"), "n", v.alias("v"))
    rows = [(role, i, j, float(x)) for role, m in embedding.weighted_moments(points).items() for (i, j), x in np.ndenumerate(embedding.covariance(*m)[1])]
    return spark.createDataFrame(rows, "role string, i int, j int, covariance double").withColumn("covariance", F.round("covariance", 3))


#: Triples whose theme is null for some rows and empty for others.
_NO_THEME = "case predicate when '1-URGENT' then null when '2-HIGH' then '' else theme_association end"


@query(f"""with {REL}, t as (select subject, object, coalesce(nullif(case predicate when '1-URGENT' then null when '2-HIGH' then '' else theme end, ''), 'Other') theme from rel)
select distinct entity, theme from (select subject entity, theme from t union all select object, theme from t)""")
def memberships_default_theme(spark, d):
    return hypergraph.memberships(rel(spark, d).withColumn("theme_association", F.expr(_NO_THEME))).select("entity", "theme")


@query()
def cluster_agglomerative(spark, d):
    return cluster.cluster_items(_points(spark, d), 0.3, "none")


@query()
def cluster_centered_pca(spark, d):
    return cluster.cluster_items(_points(spark, d), 0.15)


@query(
    """with s as (select n_name, count(*) size, least(min(c_name), n_name) head from customer join nation on c_nationkey = n_nationkey group by 1),
r as (select n_name, (row_number() over (order by size desc, head) - 1)::int community from s) select c_name node, community from customer join nation on c_nationkey = n_nationkey join r using (n_name) union all select n_name, community from r"""
)
def communities_detected(spark, d):
    """Customers with their nation, weight 50, and with the customer of the order after theirs, weight 1. The graph is connected; the best communities are the nations with their customers, which SQL numbers."""
    o, c, n = table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "nation")
    home = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_name").alias("src"), F.col("n_name").alias("dst"), F.lit(50.0).alias("weight"))
    by = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", F.col("c_name").alias("src"))
    after = by.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("src").alias("dst"))
    mixed = by.join(after, "o_orderkey").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return community.detect_communities(home.unionByName(mixed))


@query(
    """with e as (select o_custkey c, l_partkey p, count(*) w from lineitem join orders on l_orderkey = o_orderkey group by 1, 2)
select count(distinct c) + count(distinct p) nodes, count(*) edges, sum(w)::double weight, true placed, true connected, true settled, true better from e"""
)
def communities_objective(spark, d):
    """Communities of customers and the parts that they order, held to what any good partition fulfils: each node has one community, communities are connected, no node gains by a move, and the objective is above that of the parts of five brands with the customers that order most of these."""
    line, o, p = table(spark, d, "lineitem"), table(spark, d, "orders"), table(spark, d, "part")
    bought = line.join(o, line.l_orderkey == o.o_orderkey).select(F.concat(F.lit("c"), "o_custkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst"), "l_partkey")
    edges = stage_table(bought.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight")), "bought")
    found = stage_table(community.detect_communities(edges), "found")
    brand = p.select(F.concat(F.lit("p"), "p_partkey").alias("node"), F.expr("cast(substr(p_brand, 7, 1) as int)").alias("community"))
    most = edges.join(brand.withColumnRenamed("node", "dst"), "dst").groupBy("src", "community").agg(F.sum("weight").alias("w"))
    most = most.groupBy(F.col("src").alias("node")).agg(F.max_by("community", F.struct("w", "community")).alias("community"))
    plain = brand.unionByName(most)
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    same = lambda name, end: found.select(F.col("node").alias(end), F.col("community").alias(name))
    inner = edges.join(same("a", "src"), "src").join(same("b", "dst"), "dst").where("a = b").select(F.col("src").alias("u"), F.col("dst").alias("v"))
    roots = found.join(connected_components(inner), "node", "left").groupBy("community").agg(F.count_distinct(F.coalesce("root", "node")).alias("parts"))
    objective = lambda name, partition: graph.modularity(edges, partition).select(F.col("objective").alias(name))
    rows = edges.agg(F.count(F.lit(1)).alias("edges"), F.sum("weight").alias("weight"))
    for one in (
        nodes.join(found, "node", "left").agg(F.count(F.lit(1)).alias("nodes"), F.count("community").alias("placed")),
        roots.agg((F.max("parts") == 1).alias("connected")),
        graph.best_move(edges, found).select((F.coalesce("gain", F.lit(0.0)) < 1e-6).alias("settled")),
        objective("q", found),
        objective("plain", plain),
    ):
        rows = rows.crossJoin(F.broadcast(one))
    return rows.select("nodes", "edges", "weight", (F.col("placed") == F.col("nodes")).alias("placed"), "connected", "settled", (F.col("q") > F.col("plain")).alias("better"))


CHUNKS = r"""w as (select doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') ws from documents),
k as (select doc_id, ws, unnest(generate_series(0, greatest(0, ceil((len(ws) - 200) / 150.0)::bigint))) chunk_idx from w where len(ws) > 0),
chunks as (select doc_id, chunk_idx::int chunk_idx, array_to_string(ws[chunk_idx * 150 + 1 : chunk_idx * 150 + 200], ' ') chunk from k)"""


@query(
    f"""with {CHUNKS}, s as (select doc_id, chunk_idx, unnest(string_split(chunk, '.')) sentence, generate_subscripts(string_split(chunk, '.'), 1) i from chunks),
t as (select doc_id, chunk_idx, i, list_filter(string_split_regex(sentence, '\\s+'), lambda x: x <> '') w from s)
select doc_id, chunk_idx, (row_number() over (partition by doc_id, chunk_idx order by i) - 1)::int elem_idx, w[1] subject, w[2] predicate, w[len(w)] object, 'Other' theme_association from t where len(w) >= 3"""
)
def registry_extract(spark, d):
    """Triples of chunks, each chunk asked about with the entities before it."""
    t = model_calls.extract_triples(chunk_documents(table(spark, d, "documents"), 200, 50), OfflineProvider())
    return t.select("ord.*", "subject", "predicate", "object", "theme_association")


@query(f"with {CHUNKS} select doc_id, chunk_idx, 0 elem_idx, regexp_extract(chunk, '[\\p{{L}}\\p{{N}}_]{{4,}}') title, length(chunk) characters, 'first long word' reasoning from chunks where regexp_matches(chunk, '[\\p{{L}}\\p{{N}}_]{{4,}}')")
def theme_discovery(spark, d):
    t = model_calls.discover_themes(chunk_documents(table(spark, d, "documents"), 200, 50), OfflineProvider())
    return t.select("ord.*", "title", F.length("description").alias("characters"), "reasoning")


class Shouting(OfflineProvider):
    """Normalizes strings of an even length to upper case and says nothing of others."""

    def normalize(self, tokens: list[str], domain: str) -> dict:
        return {"tokens": [{"original": t, "normalized": t.upper()} for t in tokens if len(t) % 2 == 0]}


@query(f"with {PART}, items as (select 'subject' role, subject item from part_t union select 'predicate', predicate from part_t union select 'object', object from part_t) select role, item original, case when length(item) % 2 = 0 then upper(item) else item end normalized from items")
def token_normalization(spark, d):
    return model_calls.normalize_tokens(triples.role_items(part(spark, d)), Shouting(), "parts").select("role", "original", "normalized")


@query(
    f"""with {PART}, c as (select ord, {CLEAN.format('subject')} s, {CLEAN.format('predicate')} p, {CLEAN.format('object')} o, subject raw_subject, object raw_object from part_t)
select ord, case when length(s) % 2 = 0 then upper(s) else s end subject, case when length(p) % 2 = 0 then upper(p) else p end predicate, case when length(o) % 2 = 0 then upper(o) else o end object, raw_subject, raw_object from c"""
)
def normalize_with_mapping(spark, d):
    """Preprocessed strings, then the model's mapping of them."""
    t = part(spark, d)
    mapping = model_calls.normalize_tokens(triples.role_items(normalize.normalize_triples(t)), Shouting(), "parts")
    return normalize.normalize_triples(t, mapping).select("ord", "subject", "predicate", "object", "raw_subject", "raw_object")


class Odd(OfflineProvider):
    """Won't have one name for an odd number of members, and names even ones by their number."""

    def validate(self, members: list[str], domain: str) -> dict:
        return {"accuracy_destroyed": len(members) % 2 == 1, "condition_detected": "odd"}

    def lift(self, members: list[str], domain: str, center: str) -> dict:
        return {"members_verified": len(members) % 2 == 0, "formal_hypernym": f"one of {len(members)}"}


@query(
    """with i as (select distinct p_brand role, p_size, p_type item from part), c as (select role, dense_rank() over (partition by role order by p_size) c, row_number() over (partition by role, p_size order by item) - 1 i, count(*) over (partition by role, p_size) n, item from i),
s as (select *, case when n > 1 and n % 2 = 1 then i else 0 end h from c)
select role, (dense_rank() over (partition by role order by c, h) - 1)::int cluster_id, (row_number() over (partition by role, c, h order by i) - 1)::int item_idx, item from s"""
)
def cluster_validation(spark, d):
    """Each brand's types clustered by size, odd clusters refused."""
    items = table(spark, d, "part").select(F.col("p_brand").alias("role"), "p_size", F.col("p_type").alias("item")).distinct()
    by = Window.partitionBy("role")
    c = items.select("role", (F.dense_rank().over(by.orderBy("p_size")) - 1).alias("cluster_id"), (F.row_number().over(Window.partitionBy("role", "p_size").orderBy("item")) - 1).alias("item_idx"), "item")
    return model_calls.validate_clusters(c, Odd(), "parts")


@query(
    """with x as (select label, vec_id, unnest(embedding::double[]) v, generate_subscripts(embedding, 1) i from embeddings), m as (select label, i, avg(v) m from x group by 1, 2),
s as (select x.label, vec_id, round(1 - sum(v * m) / (sqrt(sum(v * v)) * sqrt(sum(m * m))), 12) dist from x join m using (label, i) group by 1, 2),
c as (select label, count(*) n, arg_min(vec_id, (dist, vec_id)) center from s group by 1)
select 'vector' as role, e.vec_id::varchar member, case when n > 1 and n % 2 = 0 then 'one of ' || n else c.center::varchar end label from embeddings e join c using (label)"""
)
def hypernym_mapping(spark, d):
    """Vectors clustered by label: the model's term where it verifies the members, else the central one."""
    e = table(spark, d, "embeddings").select(F.lit("vector").alias("role"), F.col("label").cast("int").alias("cluster_id"), F.col("vec_id").cast("int").alias("item_idx"), F.col("vec_id").cast("string").alias("item"), F.col("embedding").cast("array<double>").alias("v"))
    return model_calls.taxonomic_lift(e.drop("v"), e, Odd(), "vectors")


TREE = f"{REL}, {EDGES}, {GIVEN}, n as (select community, count(*) n, string_agg(node, '|' order by node) nodes, min(node) first from given group by 1 having count(*) >= 4), f as (select subject src, object dst, min(ord) o, arg_min(predicate, ord) p from rel group by 1, 2), l as (select a.community, count(*) m, string_agg(e.src || ' ' || f.p || ' ' || e.dst || ' ' || e.weight::bigint, '|' order by f.o) edges from edges e join f using (src, dst) join given a on a.node = e.src join given b on b.node = e.dst where a.community = b.community group by 1)"


@query(f"with {TREE} select community, nodes, edges from n left join l using (community)")
def community_hierarchy(spark, d):
    tree = graph.hierarchy(graph.edges(rel(spark, d)), _given(spark, d), 4)
    line = lambda e: F.concat_ws(" ", e["source"], e["predicate"], e["target"], e["weight"].cast("long").cast("string"))
    return tree.select("community", F.array_join("nodes", "|").alias("nodes"), F.array_join(F.transform("edges", line), "|").alias("edges"))


@query(f"with {TREE} select community, 'Schema of ' || first title, n || ' entities, ' || coalesce(m, 0) || ' relations in trade' summary, 'trade' core_theme, coalesce(m, 0)::int learnings from n left join l using (community)")
def schema_synthesis(spark, d):
    e = graph.edges(rel(spark, d))
    s = model_calls.synthesize_schemas(graph.hierarchy(e, _given(spark, d), 4), OfflineProvider(), "trade")
    return s.select("community", "title", "summary", "core_theme", F.size("key_learnings").alias("learnings"))


@query(f"with {PART}, {MEMBERS}, g as (select distinct subject, object from part_t where subject <> '' and object <> '') select (select count(*) from (select subject from g union select object from g)) nodes, (select count(*) from g) edges, count(distinct entity) entities, count(distinct theme) themes, count(*) memberships from members")
def graph_counts(spark, d):
    t = part(spark, d)
    return hypergraph.counts(t, hypergraph.memberships(t))


COLORS = "[" + ", ".join(f"'{c}'" for c in sinks.PALETTE) + "]"


@query(f"with {REL}, {EDGES}, {GIVEN}, g as (select node, count(*) k from (select src node from edges union all select dst from edges) group by 1) select node, community, {COLORS}[community % {len(sinks.PALETTE)} + 1] color, least(greatest(5 * coalesce(k, 0), 15), 50)::bigint size from given left join g using (node)")
def community_drawing(spark, d):
    nodes = sinks.community_nodes(graph.node_degree(graph.edges(rel(spark, d))), _given(spark, d))
    return nodes.withColumn("size", F.col("size").cast("long"))


@query(f"with {REL}, {EDGES}, g as (select node, count(*) k from (select src node from edges union all select dst from edges) group by 1), f as (select node, arg_min(role, (ord, pos)) as role from (select ord, 0 pos, 'subject' role, subject node from rel union all select ord, 1, 'object', object from rel) group by 1) select node, role, case when role = 'subject' then '{sinks.PALETTE[0]}' else '{sinks.PALETTE[1]}' end color, least(greatest(5 * k, 15), 50)::bigint size from f join g using (node)")
def triple_drawing(spark, d):
    t = rel(spark, d)
    nodes = sinks.role_nodes(t, graph.node_degree(graph.edges(t)))
    return nodes.withColumn("size", F.col("size").cast("long"))


@query(f"with {REL} select subject src, object dst, count(*)::double weight, string_agg(distinct predicate, ' | ' order by predicate) label from rel where subject <> '' and object <> '' group by 1, 2")
def edge_drawing(spark, d):
    return sinks.edge_labels(graph.edges(rel(spark, d)))


@query()
def hypergraph_communities(spark, d):
    return hypergraph.bipartite_communities(hypergraph.memberships(part(spark, d)))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the graph that the rules find in the documents, with weights and predicates."""
    return edges_weighted_doc(spark, sf_dir)
