"""Mixing sources to target weights, by DataFrame operations only.

Method: entropy balancing. A document of size z in source s is taken at a rate between
0 and 3 that departs as little as possible, in entropy, from rate 1 while the tokens of
each source meet the source's target. The dual has one variable a source and the
optimal rate is exponentially tilted: odds rate / (3 - rate) = 1/2 * exp(t_s * z / mean
z of s). Newton steps, kept inside a bracket, solve the dual; each step is one
aggregation over the distinct (source, size) classes, which lose nothing as a rate
depends on nothing else. Rates are then rounded into copies: in each source, in runs of
bounded length ordered by size, a document gets one more copy where the running sum of
the fractions passes an integer. At last the few documents that bring a source's words
closest to its target change by one copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, durable, whole_row

CAP = 3
NANO = 1_000_000_000
RUN = 5_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, docs) -> the same with target: the sources by code point, null last, weigh by the cycle of weights; a target stops at CAP times its source's size and the excess goes to the others by weight.

    Filling to a common level: sources in the order of capacity by weight; the level is
    that of the first source which the level doesn't fill, all before it being full.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("weight", w).withColumn("room", CAP * F.col("source_size"))
    rows = rows.withColumn("ratio", F.col("room") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"total": F.sum("source_size").over(everything), "full": F.coalesce(F.sum("room").over(before), F.lit(0)), "share": F.sum("weight").over(onward)})
    rows = rows.withColumn("level", (F.col("total") - F.col("full")) / F.col("share"))
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", F.col("level").alias("at"))))
    rows = rows.withColumn("fill", level.over(everything)["at"])
    target = F.when(F.col("fill").isNull() | (F.col("ratio") <= F.col("fill")), F.col("room").cast("double")).otherwise(F.col("fill") * F.col("weight"))
    return rows.select("source", "source_size", "docs", target.alias("target"))


def _rate(tilt: Column, size: Column, mean: Column) -> Column:
    return CAP / (1 + (CAP - 1) * F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -tilt * size / mean))))


def dual(classes: DataFrame, targets: DataFrame, steps: int = 60, tolerance: float = 1e-9) -> DataFrame:
    """(source, size, n) and targets -> targets with mean and tilt."""
    state = targets.withColumn("mean", F.greatest(F.lit(1e-9), F.col("source_size") / F.col("docs")))
    open_ = (F.col("target") > 0) & (F.col("target") < CAP * F.col("source_size"))
    state = durable(state.withColumns({"open": open_, "tilt": F.lit(0.0), "lo": F.lit(-1e6), "hi": F.lit(1e6)}))
    # Sums of doubles depend on the order of their terms in the last digits; those of decimals don't, so reruns agree.
    exact = lambda term: F.sum(term.cast("decimal(38,9)")).cast("double")
    for _ in range(steps):
        s = state.where("open").alias("s")
        c = classes.where("size > 0").alias("c").join(s, F.col("c.source").eqNullSafe(F.col("s.source")))
        rate = _rate(F.col("s.tilt"), F.col("c.size"), F.col("s.mean"))
        tokens = F.col("c.n") * F.col("c.size")
        sums = c.groupBy(F.col("s.source").alias("source")).agg(exact(tokens * rate).alias("got"), exact(tokens * rate * (1 - rate / CAP) * F.col("c.size") / F.col("s.mean")).alias("slope"))
        j = state.alias("s").join(sums.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source")), "left")
        over = F.col("got") > F.col("target")
        lo, hi = F.when(over, F.col("lo")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("hi"))
        newton = F.col("tilt") - (F.col("got") - F.col("target")) / F.nullif(F.col("slope"), F.lit(0.0))
        # Outside the bracket: its middle, or twice the tilt where one end is still far.
        middle = F.when(over & (lo <= -1e6), F.least(F.lit(-1.0), 2 * F.col("tilt"))).when(~over & (hi >= 1e6), F.greatest(F.lit(1.0), 2 * F.col("tilt"))).otherwise((lo + hi) / 2)
        inside = newton.isNotNull() & (newton > lo) & (newton < hi) & (F.abs(newton - F.col("tilt")) <= 4 + 4 * F.abs(F.col("tilt")))
        done = F.col("got").isNull() | (F.abs(F.col("got") - F.col("target")) <= tolerance * F.col("target")) | (hi - lo < 1e-12)
        state = durable(j.select("s.source", "source_size", "docs", "target", "mean", (F.col("open") & ~done).alias("open"), F.when(done, F.col("tilt")).when(inside, newton).otherwise(middle).alias("tilt"), F.when(done, F.col("lo")).otherwise(lo).alias("lo"), F.when(done, F.col("hi")).otherwise(hi).alias("hi")))
        if not state.where("open").head(1):
            break
    return state.select("source", "source_size", "docs", "target", "mean", "tilt")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """docs(doc_id, text, source, ...) -> doc_id, source, size, source_size, target, rate, copies, taken; one row per row.

    Null texts have size 0, null sources are a source of their own. Rows that agree in
    doc_id, source and size get the same copies. Documents without words get none.
    Copies run from 0 to 3. Other columns are not read. No rows give no rows.
    """
    base = durable(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    keys = base.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    classes = durable(base.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sizes = classes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs"))
    state = durable(dual(classes, source_targets(sizes, weights)))
    k = keys.alias("k").join(state.alias("s"), F.col("k.source").eqNullSafe(F.col("s.source")))
    rate = F.when((F.col("size") == 0) | (F.col("target") <= 0), F.lit(0.0)).when(F.col("target") >= CAP * F.col("source_size"), F.lit(float(CAP))).otherwise(_rate(F.col("tilt"), F.col("size"), F.col("mean")))
    k = k.select("doc_id", F.col("k.source").alias("source"), "size", "n", "source_size", "docs", "target", (F.round(rate, 6) * NANO).cast("long").alias("nano"), F.xxhash64(F.col("doc_id").cast("string")).alias("dice"))
    k = k.withColumns({"whole": F.floor(F.col("nano") / NANO), "run": F.pmod("dice", F.ceil(F.col("docs") / RUN))})
    order = Window.partitionBy("source", "run").orderBy("size", "dice", "doc_id")
    part = F.col("nano") - F.col("whole") * NANO
    upto = F.sum(part).over(order.rowsBetween(Window.unboundedPreceding, 0))
    k = k.withColumn("part", part).withColumn("upto", upto + NANO // 2)
    extra = F.floor(F.col("upto") / NANO) - F.floor((F.col("upto") - F.col("part")) / NANO)
    k = k.withColumn("copies", F.least(F.lit(CAP), F.col("whole") + extra).cast("long"))
    k = durable(k.select("doc_id", "source", "size", "n", "source_size", "target", (F.col("nano") / NANO).alias("rate"), "copies", "dice"))
    k = _settle(k)
    b, k = base.alias("b"), k.alias("k")
    same = F.col("b.doc_id").eqNullSafe(F.col("k.doc_id")) & F.col("b.source").eqNullSafe(F.col("k.source")) & (F.col("b.size") == F.col("k.size"))
    return b.join(k, same).select("b.doc_id", "b.source", "b.size", "source_size", "target", "rate", "copies", (F.col("b.size") * F.col("copies")).alias("taken"))


def _settle(k: DataFrame, rounds: int = 3) -> DataFrame:
    """Each round changes one document a source by one copy, where that brings the source's words closer to its target."""
    for _ in range(rounds):
        got = k.groupBy("source").agg((F.max("target") - F.sum(F.col("copies") * F.col("size") * F.col("n"))).alias("gap"))
        j = k.alias("k").join(got.alias("g"), F.col("k.source").eqNullSafe(F.col("g.source")))
        step = F.signum("gap").cast("long")
        weight = F.col("size") * F.col("n")
        can = (weight > 0) & (F.col("copies") + step).between(0, CAP) & (F.abs(F.abs("gap") - weight) < F.abs("gap"))
        best = j.where(can).groupBy("k.source").agg(F.min(F.struct(F.abs(F.abs("gap") - weight).alias("left"), "dice", "doc_id", "size")).alias("best"), F.max(step).alias("step"))
        p = best.select("source", "step", F.col("best.doc_id").alias("doc_id"), F.col("best.size").alias("size"))
        on = F.col("k.source").eqNullSafe(F.col("p.source")) & F.col("k.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("k.size") == F.col("p.size"))
        k = durable(k.alias("k").join(p.alias("p"), on, "left").select("k.doc_id", "k.source", "k.size", "n", "source_size", "target", "rate", (F.col("copies") + F.coalesce("step", F.lit(0))).alias("copies"), "dice"))
    return k


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """The rows of docs, each repeated by its copies, with all their columns, whatever their names.

    Rows without words have no copies and go; null sources are a source of their own;
    rows without doc_id, and repeated rows, are repeated like others.
    """
    copies = durable(mix(docs, weights).select("doc_id", "source", "size", "copies").distinct()).where("copies > 0").alias("k")
    sized = docs.select(whole_row(docs), word_count(F.col("text")).alias("size")).alias("d")
    same = F.col("d.row.doc_id").eqNullSafe(F.col("k.doc_id")) & F.col("d.row.source").eqNullSafe(F.col("k.source")) & (F.col("d.size") == F.col("k.size"))
    rows = sized.join(copies, same).select("row", F.explode(F.sequence(F.lit(1), F.col("k.copies").cast("int"))))
    return rows.select("row.*")
