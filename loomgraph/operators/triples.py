"""Triples: validation of model output, the rule extractor, and the roles' long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, words

ROLES = ("subject", "predicate", "object")
#: Where a triple stands. Any type that sorts will do as ord; this one never collides, whatever the ids and the lengths of documents.
ORD = "struct<doc_id:bigint,chunk_idx:int,elem_idx:int>"


def place(doc: Column, chunk: Column, elem: Column) -> Column:
    return F.struct(doc.cast("long").alias("doc_id"), chunk.cast("int").alias("chunk_idx"), elem.cast("int").alias("elem_idx"))


def parse_triples(answers: DataFrame, column: str = "payload") -> DataFrame:
    """answers(..., payload) -> the other columns, elem_idx and the fields of each valid element of the payload's `triples` list.

    Each element is parsed on its own, so a bad one costs no other. Subject, predicate
    and object must be strings that are not blank, and come out trimmed; the quote must
    be a string; the certainty a number, a numeric string or a boolean in [0, 1]. A
    missing theme is Other; an explicit null stays null.
    """
    rest = [c for c in answers.columns if c != column]
    raw = answers.select(*rest, F.from_json(F.col(column), "triples array<string>").alias("p"))
    # What an explode gives is there once; conditions on a plain column would go below it and parse again wherever they name it.
    parsed = F.transform("p.triples", lambda e: F.struct(e.alias("e"), F.try_parse_json(e).alias("v")))
    items = raw.select(*rest, F.posexplode(parsed).alias("elem_idx", "x")).select(*rest, "elem_idx", "x.e", "x.v")

    def text(name: str):
        kind = F.expr(f"schema_of_variant(try_variant_get(v, '$.{name}', 'variant'))")
        return F.when(kind == "STRING", F.expr(f"try_variant_get(v, '$.{name}', 'string')"))

    kind = F.expr("schema_of_variant(try_variant_get(v, '$.certainty_score', 'variant'))")
    as_text = F.expr("try_variant_get(v, '$.certainty_score', 'string')")
    score = F.when(kind == "BOOLEAN", F.when(as_text == "true", 1.0).otherwise(0.0)).otherwise(strip(as_text).try_cast("double"))
    given = text("theme_association")
    theme = F.when(given.isNull() & ~F.coalesce(F.array_contains(F.json_object_keys("e"), "theme_association"), F.lit(False)), F.lit("Other")).otherwise(given)
    fields = F.struct(*(strip(text(r)).alias(r) for r in ROLES), text("source_quote").alias("source_quote"), score.alias("certainty_score"), theme.alias("theme_association"))
    out = items.where("schema_of_variant(v) like 'OBJECT%'").select(*rest, "elem_idx", F.explode(F.array(fields)).alias("f")).select(*rest, "elem_idx", "f.*")
    good = F.col("certainty_score").between(0, 1) & ~F.isnan("certainty_score") & F.col("source_quote").isNotNull()
    for r in ROLES:
        good &= F.length(r) > 0
    return out.where(good)


def rule_triples(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, source) -> triples by rule, the offline stand-in for a model: in each sentence of three words or more, the first, second and last word. The sentence is the quote, the document's source the theme."""
    s = docs.select("doc_id", "source", F.posexplode(F.split("text", r"[.\n]")).alias("sent_idx", "sentence"))
    s = s.withColumn("w", words(F.col("sentence"))).where(F.size("w") >= 3)
    return s.select(
        place(F.col("doc_id"), F.lit(0), F.col("sent_idx")).alias("ord"),
        F.col("w")[0].alias("subject"),
        F.col("w")[1].alias("predicate"),
        F.element_at("w", -1).alias("object"),
        F.col("sentence").alias("source_quote"),
        F.lit(1.0).alias("certainty_score"),
        F.col("source").alias("theme_association"),
    )


def role_items(triples: DataFrame, roles: tuple[str, ...] = ROLES) -> DataFrame:
    """(ord, role_pos, role, item) of the chosen roles; empty items are left out."""
    cells = F.array(*(F.struct(F.lit(i).alias("role_pos"), F.lit(r).alias("role"), F.col(r).alias("item")) for i, r in enumerate(ROLES) if r in roles))
    return triples.select("ord", F.explode(cells).alias("c")).select("ord", "c.*").where("item <> ''")


def item_counts(items: DataFrame) -> DataFrame:
    """(role, item) with multiplicity and first appearance."""
    return items.groupBy("role", "item").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))


def distinct_counts(triples: DataFrame) -> DataFrame:
    return triples.agg(*(F.countDistinct(r).alias(f"{r}s") for r in ROLES))
