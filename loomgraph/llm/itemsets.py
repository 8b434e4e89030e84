"""Closed frequent itemsets of baskets, with the rules that hold in them.

Method: level-wise minimal generators. An itemset is a generator if each proper part of
it has more support; a level's candidates come from baskets that hold all the parts, and
one whose support equals a part's is pruned. Afterwards the closure of each generator is
the intersection of its baskets, as sums: an item stays if it is in all of them.

Baskets of equal content are one row with a count. Fewer than half as many baskets as
the least support are large; they are never paired up. A frequent itemset is in at least
(least support - large baskets) small ones, so candidates come from those alone, and
large baskets are only asked about candidates. Items are numbered from the rarest on, so
sets that share a beginning share their rare items, and a hot item begins few sets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.hypergraph import indexed
from .common import durable

#: Basket sizes up to this are counted one by one, larger ones by powers of two, so that the counts on the driver are at most 64 + 63 rows.
FINE = 64


def large_size(sizes: DataFrame, least: int) -> tuple[int, int]:
    """(size, n): the smallest counted size such that the n baskets with more items are at most half of the least support."""
    power = F.pow(F.lit(2), F.ceil(F.log2("n_items"))).cast("long")
    up_to = F.when(F.col("n_items") <= FINE, F.col("n_items")).otherwise(power)
    found = sizes.groupBy(up_to.alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("size")).collect()
    larger = 0
    for r in found:
        if 2 * (larger + r["n"]) > least:
            return r["size"], larger
        larger += r["n"]
    return 0, larger


def _candidates(k: int) -> Column:
    """Sets of k items from `sets`, a basket's sorted generators of k - 1: pairs of those with the same first k - 2 items, if all their parts are there too."""
    pairs = F.expr(f"flatten(transform(sets, (x, i) -> transform(filter(slice(sets, i + 2, size(sets)), y -> slice(x, 1, {k - 2}) = slice(y, 1, {k - 2})), y -> concat(x, slice(y, {k - 1}, 1)))))")
    if k == 2:
        return pairs
    part = lambda c: lambda j: F.array_contains("sets", F.filter(c, lambda _, at: at != j))
    return F.filter(pairs, lambda c: F.forall(F.sequence(F.lit(0), F.lit(k - 1)), part(c)))


def _closures(holds: DataFrame, generators: DataFrame, large_holds: DataFrame, large: DataFrame) -> DataFrame:
    """(set, extra): the items outside a generator that all its baskets hold."""
    shared = holds.select("set", "n", F.explode(F.array_except("items", "set")).alias("extra")).groupBy("set", "extra").agg(F.sum("n").alias("both"))
    shared = durable(shared.join(generators.select("set", "small").hint("merge"), "set").where("both = small").select("set", "extra"))
    absent = large_holds.join(shared.hint("merge"), "set").join(large.select("basket", F.col("item").alias("extra")).hint("merge"), ["basket", "extra"], "left_anti")
    return shared.join(absent.select("set", "extra").distinct().hint("merge"), ["set", "extra"], "left_anti")


def generators_and_closures(small: DataFrame, large: DataFrame, singles: DataFrame, support: int, n_large: int) -> tuple[DataFrame, DataFrame]:
    """(set, support) of the frequent generators, and (set, extra) of what their closures add.

    small(id, items, n): the contents of small baskets, items sorted; large(basket, item);
    singles(item, support).
    """
    fewest = max(1, support - n_large)
    inside = small.select(F.explode("items").alias("item"), "n").groupBy("item").agg(F.sum("n").alias("small"))
    level = durable(singles.join(inside.hint("merge"), "item").select(F.array("item").alias("set"), "support", "small"))
    holds = small.select("id", "n", "items", F.explode(F.transform("items", lambda v: F.array(v))).alias("set"))
    groups = small.select("id", "n", "items", F.transform("items", lambda v: F.array(v)).alias("sets"))
    large_holds = large.select("basket", F.array("item").alias("set"))
    all_sets, added, k = [level.select("set", "support")], [_closures(holds, level, large_holds, large)], 2
    while True:
        rows = groups.where(F.size("sets") >= k).select("id", "n", "items", F.explode(_candidates(k)).alias("set"))
        counted = durable(rows.groupBy("set").agg(F.sum("n").alias("small")).where(F.col("small") >= fewest))
        if not counted.head(1):
            break
        begin = counted.select("set", F.slice("set", 1, k - 1).alias("begin"), F.element_at("set", k).alias("item"))
        asked = large_holds.withColumnRenamed("set", "begin").join(begin.hint("merge"), "begin")
        large_holds = durable(asked.join(large.hint("merge"), ["basket", "item"]).select("basket", "set"))
        more = large_holds.groupBy("set").agg(F.count(F.lit(1)).alias("more"))
        counted = counted.join(more.hint("merge"), "set", "left").select("set", "small", (F.col("small") + F.coalesce("more", F.lit(0))).alias("support")).where(F.col("support") >= support)
        parts = F.explode(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.filter("set", lambda _, at: at != j))).alias("part")
        below = counted.select("set", "small", "support", parts).join(level.select(F.col("set").alias("part"), F.col("support").alias("above")).hint("merge"), "part")
        level = below.groupBy("set").agg(F.max("support").alias("support"), F.max("small").alias("small"), F.min("above").alias("above"), F.count(F.lit(1)).alias("parts"))
        level = durable(level.where((F.col("parts") == k) & (F.col("support") < F.col("above"))).select("set", "support", "small"))
        if not level.head(1):
            break
        names = level.select("set").hint("merge")
        large_holds = durable(large_holds.join(names, "set", "left_semi"))
        holds = durable(rows.join(names, "set", "left_semi"))
        all_sets.append(level.select("set", "support"))
        added.append(_closures(holds, level, large_holds, large))
        # A small basket's generators are one row; its size bounds them.
        groups = holds.groupBy("id").agg(F.any_value("n").alias("n"), F.any_value("items").alias("items"), F.sort_array(F.collect_list("set")).alias("sets"))
        k += 1
    return durable(reduce(DataFrame.union, all_sets)), durable(reduce(DataFrame.union, added))


def closed_itemsets(rows: DataFrame, least: int = 12, share: int = 10_000, confidence: int = 30) -> DataFrame:
    """rows(basket, item) -> items, n_items, support, n_rules, best_item, rules_sha256.

    Closed itemsets with support >= least and support * share >= baskets. A rule takes one
    item c from a closed set of two or more; it holds if 100 * support >= confidence * a
    and support * baskets > a * s, where a is the support of the rest and s that of c.
    Rows with a null basket or item are left out, repeated rows count once, other columns
    are not read; no rows give no itemsets. Items must be integers. Baskets may be of any
    size: of a large one no task holds more than its frequent items, as rows. Two queries
    of fixed size go to the driver: the number of baskets and the counts of sizes.
    """
    pairs = durable(rows.select(F.col("basket"), F.col("item").cast("long").alias("item")).where("basket is not null and item is not null").distinct())
    baskets = pairs.select("basket").distinct().count()
    support = max(least, -(-baskets // share))
    frequent = durable(pairs.groupBy("item").agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= support))
    items = durable(indexed(frequent.select("support", "item"), ("support", "item"), "rank"))
    ranked = durable(pairs.join(items.select("item", "rank").hint("merge"), "item").select("basket", F.col("rank").alias("item")))
    sizes = durable(ranked.groupBy("basket").agg(F.count(F.lit(1)).alias("n_items")))
    most, n_large = large_size(sizes, support)
    names = sizes.where(F.col("n_items") > most).select("basket").hint("merge")
    large = durable(ranked.join(names, "basket", "left_semi"))
    contents = ranked.join(names, "basket", "left_anti").groupBy("basket").agg(F.sort_array(F.collect_list("item")).alias("items"))
    small = durable(contents.groupBy("items").agg(F.count(F.lit(1)).alias("n")).select(F.monotonically_increasing_id().alias("id"), "items", "n"))
    singles = items.select(F.col("rank").alias("item"), "support")
    generators, added = generators_and_closures(small, large, singles, support, n_large)
    extra = added.groupBy("set").agg(F.collect_list("extra").alias("extra"))
    closed = generators.join(extra.hint("merge"), "set", "left")
    closed = closed.select(F.sort_array(F.concat("set", F.coalesce("extra", F.array().cast("array<bigint>")))).alias("set"), "support").distinct()
    return _with_rules(durable(closed), generators, items, baskets, confidence)


def _with_rules(closed: DataFrame, generators: DataFrame, items: DataFrame, baskets: int, confidence: int) -> DataFrame:
    """The support of any itemset is the least of its generators', so that of a set without c is the least of the set's generators that lack c."""
    begins = generators.select(F.element_at("set", 1).alias("item"), F.col("set").alias("generator"), F.col("support").alias("a"))
    inside = closed.where(F.size("set") > 1).select("set", "support", F.explode("set").alias("item")).join(begins.hint("merge"), "item").where(F.size(F.array_except("generator", "set")) == 0)
    lacking = inside.select("set", "support", "a", F.explode(F.array_except("set", "generator")).alias("rank")).groupBy("set", "support", "rank").agg(F.min("a").alias("a"))
    named = lacking.join(items.select("rank", F.col("item").alias("c"), F.col("support").alias("s")).hint("merge"), "rank")
    rules = named.where((100 * F.col("support") >= confidence * F.col("a")) & (F.col("support") * F.lit(baskets).cast("long") > F.col("a") * F.col("s")))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c", "a", "s"))), lambda r: F.concat_ws(":", r["c"].cast("string"), r["a"].cast("string"), r["s"].cast("string"))), ";")
    rules = rules.groupBy("set").agg(F.count(F.lit(1)).alias("n_rules"), F.min(F.struct("a", "c"))["c"].alias("best_item"), text.alias("rules"))
    # A closed set's items are one value; they fit in a small basket.
    told = closed.select("set", "support", F.explode("set").alias("rank")).join(items.select("rank", "item").hint("merge"), "rank")
    told = told.groupBy("set", "support").agg(F.sort_array(F.collect_list("item")).alias("items")).join(rules.hint("merge"), "set", "left")
    joined = F.array_join(F.transform("items", lambda i: i.cast("string")), ",").alias("items")
    return told.select(joined, F.size("items").cast("long").alias("n_items"), "support", F.coalesce("n_rules", F.lit(0).cast("long")).alias("n_rules"), "best_item", F.sha2(F.coalesce("rules", F.lit("")).cast("binary"), 256).alias("rules_sha256"))
