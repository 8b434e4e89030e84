"""Column functions over text. Whitespace is Python's: Java's Unicode class and U+001C to U+001F."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"(?U)[\s\x1c-\x1f]"


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def chunk_documents(docs: DataFrame, max_words: int, overlap_words: int = 50) -> DataFrame:
    """docs(doc_id, text) -> doc_id, chunk_idx, chunk. Chunks overlap where max_words is larger than the overlap; the last one ends with the last word. Null and blank texts have none."""
    if max_words <= 0:
        raise ValueError("max_words must be positive")
    stride = max_words - overlap_words if max_words > overlap_words else max_words
    w = docs.select("doc_id", words(F.col("text")).alias("w"))
    last = F.greatest(F.lit(0), F.ceil((F.size("w") - max_words) / F.lit(stride))).cast("int")
    # Chunks are made where they are exploded: no row carries all words, and no condition splits them again.
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("w", i * stride + 1, F.lit(max_words)), " "))
    return w.select("doc_id", F.posexplode(F.when(F.size("w") > 0, cut)).alias("chunk_idx", "chunk"))


def preprocess(text: Column) -> Column:
    """Underscores to spaces, brackets and slashes away, lower case, single spaces, trimmed."""
    plain = F.regexp_replace(F.translate(text, "_", " "), r"[<>/\\|\[\]{}]", "")
    return strip(F.regexp_replace(F.lower(plain), SPACE + "+", " "))


def title_key(title: Column) -> Column:
    return F.lower(strip(title))


def theme_or_other(theme: Column) -> Column:
    return F.coalesce(F.nullif(theme, F.lit("")), F.lit("Other"))


def edge_text(source: Column, predicate: Column, target: Column) -> Column:
    return F.format_string("%s -[%s]-> %s", source, F.coalesce(predicate, F.lit("links")), target)


def json_in_answer(answer: Column) -> Column:
    """The JSON text in a model's answer. Only what follows the last output mark counts, where there is one; of that a fenced block, tagged or not; else from the first to the last brace; else all of it."""
    rest = F.substring_index(answer, "Output:\n", -1)
    fenced = F.regexp_extract(rest, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    braces = F.regexp_extract(rest, r"(?s)(\{.*\})", 1)
    return F.when(fenced != "", fenced).when(braces != "", braces).otherwise(rest)


def node_size(degree: Column) -> Column:
    return F.least(F.greatest(5 * degree, F.lit(15)), F.lit(50))


def context_bound(free_mb: float, default: int) -> int:
    """Little free memory bounds a model's context."""
    return min(default, 2000) if 0 < free_mb < 4000 else default


def order_key(value: Column, kind) -> Column:
    """A string that sorts as the value does: a whole number, or a struct of whole numbers."""
    number = lambda x: F.lpad(F.hex(F.coalesce(x.cast("long"), F.lit(-(2**63))).bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    return F.concat(*(number(value[f.name]) for f in kind.fields)) if hasattr(kind, "fields") else number(value)
