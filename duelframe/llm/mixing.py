"""Mixing sources to target weights by Pareto order sampling.

DataFrame operations only.  Each source's target is split into whole copies
of every document, which are certain, and a remainder that is sampled.  In
the remainder a document's inclusion probability is in proportion to its
size class (the power of two at or below its size), cut at 1; the constant
of proportion solves "expected words = remainder".  Documents are ranked by
random odds over inclusion odds, u/(1-u) : p/(1-p), and taken in that order
up to the fixed size, which is counted in words as the targets are.  The
first document that does not fit ends a pass; further passes go on in the
same order with the documents that fit what is left, until none does.

The rank's running sums are built in two levels: sums by bucket of the rank
first (combined map-side), then rows of the one bucket in which the fixed
size falls.  No window holds a whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.common import core, join_on, save

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
BUCKETS = 1 << 16


def word_count(text: Column) -> Column:
    """Number of runs of other than ASCII white space; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0,
            most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code-point order, null last, weigh ``weights`` in turn and
    share ``share`` of all sizes.  A source whose part is above ``most`` times
    its size stops there and the excess goes to the others by weight: with
    the sources sorted by cap per weight, those that stop are a prefix of it,
    so one running sum finds the final level.  Without any words every
    target is 0.  The table has one row a source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = sources.withColumn("w", w).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source").cast("binary"))
    everything = Window.partitionBy(F.lit(0))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    w_left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    # level if every earlier source stopped; the first source whose cap it does not pass settles it
    t = t.withColumn("level", left / w_left)
    open_ = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"),
                         F.struct(F.col("cap") / F.col("w"), "level"))).over(everything)
    level = open_["level"]
    return t.select("source", "source_size",
                    F.when(level.isNull(), F.col("cap")).otherwise(F.least(level * F.col("w"), "cap")).alias("target"))


def unit(*keys: Column) -> Column:
    """A number in (0, 1) from the keys: the first 13 hex digits of their MD5."""
    text = F.concat_ws(":", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def _prefix(pool: DataFrame) -> DataFrame:
    """(source, id, size, copy) of the documents, in order of rank, whose running words stay within ``rest``."""
    sums = pool.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("most"))
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(
        Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sums = sums.where("before < most").withColumn("fits", F.col("before") + F.col("words") <= F.col("most"))
    inside = join_on(pool, sums, ["source", "bucket"])
    run = Window.partitionBy("source", "bucket").orderBy("q", "id", "copy").rowsBetween(Window.unboundedPreceding, 0)
    cut = inside.where("not fits").withColumn("upto", F.col("before") + F.sum("size").over(run)).where("upto <= most")
    cols = ["source", "id", "size", "copy"]
    return inside.where("fits").select(*cols).union(cut.select(*cols))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = 1.0, most: int = MOST_COPIES, seed: int = 42,
        buckets: int = BUCKETS) -> DataFrame:
    """Per document: id, source, size, source_size, target, copies and taken (= copies * size).

    A null text has size 0; a null source is a source of its own, sorted
    last.  Documents without words are never taken.  Ties in rank go by id,
    then by a count over equal rows, so reruns agree and repeated rows are
    sampled one by one.  An empty table gives no rows; other columns are ignored.
    """
    src = core(docs, id_col, text_col, source_col)
    sized = save(src.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                            word_count(F.col(text_col)).alias("size")), "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = save(targets(sources, weights, share, most), "mix-targets")
    goal = goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    goal = goal.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))

    # inclusion probabilities: c * size class, with sum(p * size) = rest; the largest classes reach 1
    classed = sized.where("size > 0").withColumn("class", F.floor(F.log2("size")).cast("int"))
    classes = classed.groupBy("source", "class").agg(F.sum("size").alias("words"))
    larger = Window.partitionBy("source").orderBy(F.col("class").desc()).rowsBetween(Window.unboundedPreceding, -1)
    smaller = Window.partitionBy("source").orderBy(F.col("class").desc()).rowsBetween(0, Window.unboundedFollowing)
    step = F.pow(F.lit(2.0), "class")
    c = join_on(classes, goal.select("source", "rest"), ["source"])
    c = c.withColumn("c", (F.col("rest") - F.coalesce(F.sum("words").over(larger), F.lit(0))) / F.sum(F.col("words") * step).over(smaller))
    # the first class, from the largest, whose own p stays below 1 settles the constant
    fits = F.when(F.col("c") * step <= 1, F.struct(-F.col("class"), "c"))
    c = c.withColumn("c", F.min(fits).over(Window.partitionBy("source"))["c"])
    c = c.select("source", "class", "rest", F.least(F.lit(1.0), F.col("c") * step).alias("p"))

    # rank by random odds over inclusion odds; equal rows are told apart by their number
    several = classed.groupBy("source", "class", "id", "size").agg(F.count("*").alias("times"))
    ranked = join_on(several, c, ["source", "class"]).where("p > 0 and rest > 0")
    ranked = ranked.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    u = unit(F.lit(seed), F.col("id"), F.col("copy"))
    q = F.when(F.col("p") >= 1, F.lit(0.0)).otherwise((u / (1 - u)) / (F.col("p") / (1 - F.col("p"))))
    ranked = ranked.select("source", "id", "size", "copy", "rest", q.alias("q"))
    ranked = ranked.withColumn("bucket", F.floor(F.col("q") / (1 + F.col("q")) * buckets))
    ranked = save(ranked, "mix-ranked")
    left = save(goal.select("source", "rest"), "mix-left")
    pool, chosen = ranked.drop("rest"), None
    while True:
        pool = save(join_on(pool, left, ["source"]).where(F.col("size") <= F.col("rest")), "mix-pool")
        if chosen is not None and pool.isEmpty():
            break
        part = save(_prefix(pool), "mix-chosen")
        chosen = part if chosen is None else chosen.unionByName(part)
        used = part.groupBy("source").agg(F.sum("size").alias("used"))
        left = save(join_on(left, used, ["source"], "left").select(
            "source", (F.col("rest") - F.coalesce("used", F.lit(0))).alias("rest")), "mix-left")
        pool = join_on(pool.drop("rest"), part, ["source", "id", "size", "copy"], "left_anti")

    # whole copies for every row, one more for the chosen ones
    n = chosen.groupBy("source", "id", "size").agg(F.collect_set("copy").alias("picked"))
    rows = sized.groupBy("source", "id", "size").agg(F.count("*").alias("times"))
    out = join_on(rows, n, ["source", "id", "size"], "left")
    out = out.select("source", "id", "size", "picked",
                     F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"))
    out = join_on(out, goal, ["source"])
    extra = F.coalesce(F.array_contains("picked", F.col("copy")), F.lit(False)).cast("int")
    copies = F.when(F.col("size") > 0, F.col("whole") + extra).otherwise(0)
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
                      copies.cast("int").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))
