"""The registered queries of the training-data operators, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import encode_decode, read_ranks
from .chat_format import format_turns, read_back, text_turns
from .common import read_table
from .filter_audit import audit
from .itemsets import closed_itemsets
from .learned_ann import nearest_neighbours
from .mixing import mix
from .ngram_join import ngram_classes
from .packing import pack, read_vocabulary
from .pii import find_spans
from .quality_qda import quality_scores
from .quality_rules import quality_rules
from .toxicity import toxicity_scores
from .warc import round_trip


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), threshold=0.3)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(read_table(spark, sf_dir, "documents"), width=4, percent=85)


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), is_query="vec_id % 100 = 0", k=10)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"), weights=(1, 2, 3)).select("doc_id", "size", "source_size", "target", "taken")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), threshold=0.5)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return encode_decode(read_table(spark, sf_dir, "documents"), tokens, public_tokenizers.PATTERN)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_spans(read_table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(rows.schema["turn"].dataType).alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return read_back(format_turns(text_turns(rows.unionByName(extra))))


def op11_basket_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "sale_lines").where("flag is distinct from 'returned'")
    return closed_itemsets(lines.select(F.col("sale_id").alias("basket"), F.col("item_id").alias("item")), least=12, share=10_000, confidence=30)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return pack(read_table(spark, sf_dir, "documents"), tokens, public_tokenizers.PATTERN, width=2048, end=1)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_ngram_join": op2_ngram_join,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_source_mixing": op4_source_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_warc": op7_warc,
    "op8_quality_rules": op8_quality_rules,
    "op9_personal_data": op9_personal_data,
    "op10_chat_format": op10_chat_format,
    "op11_basket_itemsets": op11_basket_itemsets,
    "op12_packing": op12_packing,
    "op13_filter_audit": op13_filter_audit,
}

#: The other queries come from models, tokenizers or roundings that SQL can't express; tests hold them against plain versions.
ORACLE_SQL: dict[str, str] = {
    "op2_ngram_join": r"""with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
s as (select distinct doc_id, array_to_string(w[i : i + 3], ' ') g from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) i from d where len(w) > 0)),
n as (select doc_id, count(*) n from s group by 1),
p as (select a.doc_id x, b.doc_id y, count(*) k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * k >= 85 * (nx.n + ny.n - k)),
e as (select x a, y b from l union all select y, x from l),
r as (select a node, a comp from e union select e.b, r.comp from r join e on e.a = r.node),
c as (select node, min(comp) comp from r group by 1)
select d.doc_id, coalesce(n.n, 0) n_shingles, coalesce(c.comp, d.doc_id) component_id from d left join n on n.doc_id = d.doc_id left join c on c.node = d.doc_id""",
    "op7_warc": """with p as (select page_id, coalesce(html, '') h from pages), q as (select page_id, strlen(h) payload_bytes, sha256(h) payload_digest from p),
f as (select payload_digest, min(page_id) first from q where payload_bytes >= 100 group by 1)
select page_id, payload_bytes, q.payload_digest, case when first is not null and page_id <> first then 'revisit' else 'response' end record_type, case when page_id <> first then first end refers_to
from q left join f on f.payload_digest = q.payload_digest and payload_bytes >= 100""",
    "op10_chat_format": r"""with c as (select conv_id, turn, role, coalesce(text, '') t from conversations union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f as (select *, length(regexp_replace(t, '([<\[])(\\*)(\|[A-Za-z_]+(?::[0-9]+)?\|>|/?s>|/?INST\]|/?SYS>>)', '\1\\\2\3', 'g')) + length(role) + 8 + 1 + 7 + 1 n from c)
select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' order by turn)) turns_sha256,
coalesce(sum(length(t)) filter (role = 'assistant'), 0)::bigint loss_chars, sha256(coalesce(string_agg(t, '' order by turn) filter (role = 'assistant'), '')) loss_sha256, sum(n)::bigint formatted_chars from f group by 1""",
    "op11_basket_itemsets": """with recursive l as (select distinct sale_id, item_id from sale_lines where flag is distinct from 'returned' and sale_id is not null and item_id is not null),
b as (select count(distinct sale_id)::bigint b from l), m as (select b, greatest(12, (b + 9999) // 10000) m from b),
one as (select item_id i, list(sale_id) t, count(*) s from l group by 1 having count(*) >= (select m from m)),
grown as (select [i] x, t, s from one union all
  select x, t, len(t) from (select list_append(g.x, one.i) x, list_intersect(g.t, one.t) t from grown g join one on one.i > g.x[-1]) where len(t) >= (select m from m)),
f as (select x, s::bigint s from grown),
wider as (select list_filter(f.x, lambda y: y <> f.x[j]) x, f.s from (select x, s, unnest(generate_series(1, len(x))) j from f where len(x) > 1) f),
closed as (select x, s from f where not exists (select 1 from wider w where w.x = f.x and w.s = f.s)),
parts as (select x, s, x[j] c, list_filter(x, lambda y: y <> x[j]) rest from (select x, s, unnest(generate_series(1, len(x))) j from closed where len(x) > 1)),
rules as (select p.x, p.c, f.s a, one.s::bigint sc from parts p join f on f.x = p.rest join one on one.i = p.c, b where 100 * p.s >= 30 * f.s and p.s * b.b > f.s * one.s),
told as (select x, count(*) n_rules, arg_min(c, (a, c)) best_item, string_agg(c || ':' || a || ':' || sc, ';' order by c) r from rules group by 1)
select array_to_string(closed.x, ',') items, len(closed.x)::bigint n_items, closed.s support, coalesce(n_rules, 0)::bigint n_rules, best_item, sha256(coalesce(r, '')) rules_sha256 from closed left join told on told.x = closed.x""",
    "op13_filter_audit": r"""with t as (select doc_id, coalesce(text, '') t, coalesce(lang, '') part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
g as (select doc_id, max(case when quality = 1 then 1 else 0 end) good, max(case when toxic = 1 then 1 else 0 end) toxic from labels group by 1),
x as (select part, coalesce(good, 0) good, coalesce(toxic, 0) toxic, len(w) < 100 a, 100 * len(list_distinct(w)) < 80 * len(w) b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) c,
  regexp_matches(t, '[#$%&*|]') d, doc_id > min(doc_id) over (partition by t) e from t left join g using (doc_id)),
k as (select part, good, toxic, case when a then 'A' else '' end || case when b then 'B' else '' end || case when c then 'C' else '' end || case when d then 'D' else '' end || case when coalesce(e, false) then 'E' else '' end fails from x),
s as (select part, fails, count(*) n, sum(good) good, sum(toxic) toxic from k group by 1, 2),
o as (select p.f || q.f || r.f || u.f || v.f o from (values ('A'), ('B'), ('C'), ('D'), ('E')) p(f), (values ('A'), ('B'), ('C'), ('D'), ('E')) q(f), (values ('A'), ('B'), ('C'), ('D'), ('E')) r(f), (values ('A'), ('B'), ('C'), ('D'), ('E')) u(f), (values ('A'), ('B'), ('C'), ('D'), ('E')) v(f)
  where q.f <> p.f and r.f not in (p.f, q.f) and u.f not in (p.f, q.f, r.f) and v.f not in (p.f, q.f, r.f, u.f)),
h as (select part, o, step, o[step] f, n, good, toxic, fails, contains(fails, o[step]) hit, length(translate(fails, o[1 : step - 1], '')) < length(fails) gone from s, o, generate_series(1, 5) z(step)),
r as (select part, o, step, f, coalesce(sum(n) filter (not hit and not gone), 0)::bigint kept, coalesce(sum(n) filter (hit and not gone), 0)::bigint removed, coalesce(sum(n) filter (hit and gone), 0)::bigint redundant, coalesce(sum(n) filter (fails = f), 0)::bigint unique_fails,
  coalesce(sum(good) filter (hit and not gone), 0)::bigint good_lost, coalesce(sum(toxic) filter (hit and not gone), 0)::bigint toxic_lost from h group by 1, 2, 3, 4)
select part, o filter_order, step::int step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) over (partition by part, f))::bigint shapley from r""",
}
