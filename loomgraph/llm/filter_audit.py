"""Interaction audit of document filters: what each removes in every order of applying them.

Method: each document's failures are a mask of five bits; all orders follow from counts
by mask. The fifth filter, exact copies, comes first by partition refinement: documents
are split by length in code points, then by the hashes of successive blocks, each
sixteen times as long as the one before, and classes of one document are dropped in
between. Documents whose class is left at the end are compared by their full texts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, durable

FILTERS = "ABCDE"
FIRST_BLOCK, GROWTH = 256, 16


#: A class's documents are dealt to so many tasks before their texts meet, so that a large class of copies is summed up first.
DEALT = 32
#: How joins run whose sides grow with the documents: both are shuffled. A broadcast goes through the driver, and a small file may hold a large table.
SPREAD = "merge"
#: Bits of the sieve of classes, 64 a row.
SIEVE = 1 << 22


def with_mask(rows: DataFrame) -> DataFrame:
    """rows(text, ...) and `mask`, the bits of the filters that look at one text: A 1, B 2, C 4, D 8."""
    text = F.col("text")
    rows = rows.withColumn("words", F.regexp_extract_all(text, F.lit(f"({WORD}+)"), F.lit(1)))
    rows = rows.withColumns({"n": F.size("words"), "different": F.size(F.array_distinct("words")), "large": F.regexp_count(text, F.lit("[A-Z]"))}).drop("words")
    fails = (F.col("n") < 100, 100 * F.col("different") < 80 * F.col("n"), 100 * F.col("large") > 10 * F.length(text), text.rlike(r"[#$%&*|]"))
    return rows.withColumn("mask", sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))).drop("n", "different", "large")


def block_hashes(text: Column, first: int = FIRST_BLOCK) -> Column:
    """A hash for each block of the text, however long it is; an empty text has one too."""
    bounds = [0]
    while bounds[-1] < 1 << 31:
        bounds.append(min((bounds[-1] or first // GROWTH) * GROWTH, 1 << 31))
    blocks = F.array(*(F.struct(F.lit(a).alias("at"), F.lit(min(b - a, (1 << 31) - 1)).alias("n")) for a, b in zip(bounds, bounds[1:])))
    reached = F.filter(blocks, lambda b: (b["at"] == 0) | (b["at"] < F.length(text)))
    return F.transform(reached, lambda b: F.xxhash64(F.substring(text, b["at"].cast("int") + 1, b["n"].cast("int"))))


def _base(docs: DataFrame, hashes) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.coalesce("lang", F.lit("")).alias("part"))
    # Exploded, as Spark computes a plain column again for each use of it.
    return rows.select("doc_id", "text", "part", F.length("text").alias("length"), F.explode(F.array(hashes(F.col("text")))).alias("blocks"))


def refine(rows: DataFrame) -> DataFrame:
    """(length, blocks) of the classes of several documents that length and block hashes leave."""
    members = rows.select("length", "blocks", F.lit(0).cast("long").alias("class"))
    at = 0
    while True:
        # A class is its length and a digest of the blocks so far; a text without a block here keeps its digest.
        n = members.groupBy("length", "class").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("blocks")).alias("most")).where("n > 1")
        n = durable(n)
        deep = n.agg(F.max("most")).head()[0]
        if deep is None or at >= deep:
            return durable(members.join(n.select("length", "class").hint(SPREAD), ["length", "class"], "left_semi").select("length", "blocks").distinct())
        members = members.join(n.select("length", "class").hint(SPREAD), ["length", "class"], "left_semi")
        members = durable(members.withColumn("class", F.xxhash64("class", F.get("blocks", F.lit(at)))))
        at += 1


def sieved(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of these classes, and a few of others, without a shuffle: what is broadcast are the bits that classes set in a field of SIEVE, however many there are."""
    spot = F.pmod(F.xxhash64("length", "blocks"), F.lit(SIEVE))
    bit = F.expr("shiftleft(1L, cast(pmod(spot, 64) as int))")
    word = F.shiftright("spot", 6).alias("word")
    field = durable(classes.select(spot.alias("spot")).select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")))
    near = rows.withColumn("spot", spot).withColumn("word", word).join(F.broadcast(field), "word")
    return near.where(F.col("bits").bitwiseAND(bit) != 0).drop("spot", "word", "bits")


def failure_masks(docs: DataFrame, hashes=block_hashes) -> DataFrame:
    """docs(doc_id, text, lang) -> doc_id, part, mask, one row a document; bit 16 says that a smaller doc_id has the same text.

    Rows of one doc_id are no copies of each other; without a doc_id a row is a copy of
    none and makes none. Null texts are empty, and copies of other empty ones.
    hashes(text) tells blocks apart; it may confuse different texts, which are then
    compared in full.
    """
    rows = _base(docs, hashes)
    flat = durable(with_mask(rows).drop("text"))
    key = ["length", "blocks"]
    # A document of another class that gets through the sieve is a class of one text here, its own.
    texts = sieved(rows.where("doc_id is not null"), refine(flat.where("doc_id is not null")))
    texts = texts.withColumn("deal", F.pmod(F.xxhash64("doc_id"), F.lit(DEALT)).cast("int"))
    texts = texts.groupBy(*key, "text", "deal").agg(F.min("doc_id").alias("first")).groupBy(*key, "text").agg(F.min("first").alias("first"))
    firsts = durable(texts.groupBy(*key).agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first")))
    copy = lambda r: r.select("doc_id", "part", (F.col("mask") + F.when(F.col("doc_id") > F.col("first"), 16).otherwise(0)).alias("mask"))
    sure = copy(flat.join(firsts.hint(SPREAD), key, "left").where("coalesce(texts, 1) = 1"))
    mixed = firsts.where("texts > 1").select(*key)
    if not mixed.head(1):
        return sure
    # Classes of different texts: hardly any with hashes of 64 bits a block. Their documents are told apart by text.
    among = with_mask(sieved(rows, mixed).join(mixed.hint(SPREAD), key, "left_semi"))
    first = among.groupBy(*key, "text").agg(F.min("doc_id").alias("first"))
    return sure.unionByName(copy(among.join(first.hint(SPREAD), [*key, "text"])))


def audit(docs: DataFrame, labels: DataFrame, hashes=block_hashes) -> DataFrame:
    """docs(doc_id, text, lang), labels(doc_id, quality, toxic) -> part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A part for each lang, null as an empty one; 600 rows a part. A document counts as
    good, or toxic, if any of its labels says so; other columns are not read. Repeated
    rows count each; no documents give no parts.
    """
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    masks = failure_masks(docs, hashes).join(marks.hint(SPREAD), "doc_id", "left")
    # 32 rows a part from here on.
    counts = masks.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    rows = durable(counts).withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letter, earlier = F.substring("filter_order", F.col("step"), F.lit(1)), F.substring("filter_order", F.lit(1), F.col("step") - 1)
    bits = lambda s: sum((F.when(F.contains(s, F.lit(f)), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))
    rows = rows.withColumns({"letter": letter, "bit": bits(letter), "before": bits(earlier)})
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda value, when: F.sum(F.when(when, F.col(value)).otherwise(0).cast("long"))
    out = rows.groupBy("part", "filter_order", "step", "letter").agg(
        total("n", ~fails & ~gone).alias("kept"),
        total("n", fails & ~gone).alias("removed"),
        total("n", fails & gone).alias("redundant"),
        total("n", F.col("mask") == F.col("bit")).alias("unique_fails"),
        total("good", fails & ~gone).alias("good_lost"),
        total("toxic", fails & ~gone).alias("toxic_lost"),
    )
    out = durable(out)
    whole = out.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return out.join(whole, ["part", "letter"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
